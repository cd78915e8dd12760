"""SparkSession defaults for the engine, the folder that its steps share, and what its queries need of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "quarrymill", **conf: str) -> SparkSession:
    """A session with adaptive execution, Arrow transfer and UTC; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, from spark.checkpoint.dir.

    Where it is unset and all runs in one JVM, as in tests, it is a temporary one. On a cluster that is an error: a
    machine's own folder would be read back incomplete.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="quarrymill-")
        context.setCheckpointDir(found)
    return found.rstrip("/")


#: Bytes of rows that go to a Python worker at once: a bound of what workers and their executors hold of texts.
BATCH_BYTES = 4 << 20
#: Bytes up to which each dealt part of a join's smaller side is hashed in place of sorting both sides.
HASHED_BYTES = 64 << 20


def prepare(spark: SparkSession) -> None:
    """Bounds what goes to Python workers at once, lets adaptive execution hash small parts of joins, and sends this
    package's modules to the executors, once for an application, so that they need no copy of it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", str(HASHED_BYTES))
    context, root = spark.sparkContext, Path(__file__).parent
    if getattr(context, "_quarrymill_shipped", False) or not root.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="quarrymill-")) / "quarrymill.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for module in sorted(root.rglob("*.py")):
            archive.write(module, module.relative_to(root.parent))
    context.addPyFile(str(path))
    context._quarrymill_shipped = True
