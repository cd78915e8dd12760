"""Retrieval: exact vector top-k, and graph modes over tables of chunks, entities and relations.

The graph modes are this engine's own design, after the published idea of retrieval by entities (local), by relations
(global), by both (hybrid), and with plain chunk search besides (mix).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MODES = ("naive", "local", "global", "hybrid", "mix", "bypass")
TOP_K = 5
#: Questions of one pass; more are taken in further passes, so what is sent to the tasks is bounded.
QUESTIONS = 1000


def score(vector: Column, query: list[float]) -> Column:
    """The inner product with a literal vector: the cosine, for unit vectors."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return F.aggregate(F.zip_with(vector, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)


def top_k(rows: DataFrame, query: list[float], k: int = TOP_K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k best rows for one question, ties by key: a top-k in each task, then of those."""
    return rows.withColumn("score", score(F.col(vector), query)).orderBy(F.desc("score"), key).limit(k)


def top_k_each(rows: DataFrame, questions: DataFrame, k: int = TOP_K, key: str = "vec_id", vector: str = "embedding", q_key: str = "q_id", q_vector: str = "q_vector") -> DataFrame:
    """(q_id, key, score, rank): the k best rows for each question. Each task keeps k rows a question of its batches, so
    only those are shuffled; questions go out in passes of QUESTIONS."""
    out = None
    block: list[tuple] = []
    for row in [*questions.select(q_key, q_vector).toLocalIterator(), None]:
        if row is not None:
            block.append((row[0], [float(x) for x in row[1]]))
        if block and (row is None or len(block) == QUESTIONS):
            part = rows.select(key, vector).mapInArrow(_best(rows.sparkSession.sparkContext.broadcast(block), k, q_key, key), f"{q_key} long, {key} long, score double")
            out = part if out is None else out.unionByName(part)
            block = []
    if out is None:
        return rows.sparkSession.createDataFrame([], f"{q_key} long, {key} long, score double, rank long")
    rank = F.row_number().over(Window.partitionBy(q_key).orderBy(F.desc("score"), key))
    return out.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k)


def _best(shared, k, q_key, key):
    """For each question the k best rows of a task's batches; ties go to the smaller key."""

    def rows(found):
        q_ids = np.array([q for q, _ in shared.value], np.int64)
        q = np.array([v for _, v in shared.value], float)
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(q_ids)
        for batch in found:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(ids), -1)
            scores = q @ vectors.T
            at_least = np.partition(scores, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(q_ids), -np.inf)
            for n, least in enumerate(at_least):
                some = np.flatnonzero(scores[n] >= least)
                all_ids, all_scores = np.concatenate((best[n][0], ids[some])), np.concatenate((best[n][1], scores[n, some]))
                order = np.lexsort((all_ids, -all_scores))[:k]
                best[n] = (all_ids[order], all_scores[order])
        sizes = [len(b[0]) for b in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(q_ids, sizes)), pa.array(np.concatenate([b[0] for b in best]).astype(np.int64)), pa.array(np.concatenate([b[1] for b in best]).astype(float))],
            names=[q_key, key, "score"],
        )

    return rows


def local(entities: DataFrame, relations: DataFrame, query: list[float], k: int = TOP_K) -> DataFrame:
    """(chunk_id): chunks of the relations that touch the k best entities."""
    best = top_k(entities, query, k, "entity").select("entity")
    out = relations.join(best.withColumnRenamed("entity", "src"), "src", "left_semi").select("chunk_id")
    into = relations.join(best.withColumnRenamed("entity", "dst"), "dst", "left_semi").select("chunk_id")
    return out.union(into).distinct()


def global_(relations: DataFrame, query: list[float], k: int = TOP_K) -> DataFrame:
    """(chunk_id): chunks of the k best relations, and of all relations between their ends."""
    best = top_k(relations, query, k, "relation").select("src", "dst").distinct()
    return relations.join(best, ["src", "dst"], "left_semi").select("chunk_id").distinct()


def retrieve(mode: str, query: list[float], chunks: DataFrame, entities: DataFrame, relations: DataFrame, k: int = TOP_K) -> DataFrame:
    """(chunk_id) by one of MODES; none for bypass."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    naive = top_k(chunks, query, k, "chunk_id").select("chunk_id")
    if mode == "naive":
        return naive
    if mode == "local":
        return local(entities, relations, query, k)
    if mode == "global":
        return global_(relations, query, k)
    both = local(entities, relations, query, k).union(global_(relations, query, k)).distinct()
    if mode == "hybrid":
        return both
    if mode == "mix":
        return both.union(naive).distinct()
    return chunks.select("chunk_id").limit(0)


def context_lines(found: DataFrame, order: str) -> DataFrame:
    """Numbered context: ``[i] title | url`` and the first 150 characters. ``found`` is a retrieved list, k rows."""
    n = F.row_number().over(Window.orderBy(order))
    return found.withColumn("line", F.concat(F.lit("["), n.cast("string"), F.lit("] "), "title", F.lit(" | "), "url", F.lit("\n"), F.substring("content", 1, 150)))


def embedded(rows: DataFrame, text: str, model: Callable[[list[str]], np.ndarray], out: str = "embedding", batch: int = 128) -> DataFrame:
    """Adds L2-normalised vectors of a column. The model gets lists of up to ``batch`` texts and gives a matrix; a null
    text is embedded as an empty one; a zero vector stays zero."""
    columns = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", `{out}` array<float>"

    def call(found):
        for b in found:
            texts = [t or "" for t in b.column(columns.index(text)).to_pylist()]
            vectors = [np.asarray(model(texts[k : k + batch]), float) for k in range(0, len(texts), batch)]
            matrix = np.concatenate(vectors) if vectors else np.zeros((0, 1))
            norms = np.linalg.norm(matrix, axis=1, keepdims=True)
            matrix = matrix / np.where(norms == 0, 1, norms)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(matrix.astype(np.float32).tolist(), pa.list_(pa.float32()))], names=[*columns, out])

    return rows.mapInArrow(call, schema)


def embedding_response(vectors: DataFrame, text: str, vector: str, index: str, model: str) -> DataFrame:
    """Rows as an embedding service answers: object, embedding, index, model, and an estimate of the text's tokens."""
    return vectors.select(
        F.lit("embedding").alias("object"), F.col(vector).alias("embedding"), F.col(index).alias("index"), F.lit(model).alias("model"), F.floor(F.length(text) / 4).alias("prompt_tokens")
    )


def answered(question: str, mode: str, answer: str, context: DataFrame) -> dict:
    """The result of a query as the API gives it; the context is a retrieved list of k rows at most."""
    return {"query": question, "mode": mode, "answer": answer, "context": [r.asDict() for r in context.collect()]}
