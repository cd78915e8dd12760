"""Study-scheme operators as queries. Scheme texts are made from parts, so that each field's right value is a column;
the SQL gives those values without any pattern of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.operators import schemes

def _k() -> Column:
    return F.col("p_partkey")


def _digits(number: Column, without: str) -> Column:
    """A number with the digits that a section's pattern may not contain changed to 8 and 9."""
    return F.translate(number.cast("string"), without, "89"[: len(without)])


def _text() -> Column:
    """Four kinds: a major with sections, streams and notes; a minor with units; a double major in Chinese; nothing."""
    code = lambda head, number, without="": F.concat(F.lit(head), _digits(number, without))
    major = F.concat(
        F.lit("Programme Title:  "), "p_name", F.lit("\nApplicable to students admitted in "), (2010 + _k() % 15).cast("string"), F.lit(" and  after\nTotal: "), (120 + _k() % 30).cast("string"),
        F.lit("\n1. School Package:\n"), code("CSC", 1000 + _k() % 900, "23"), F.lit(" "), code("MAT", 4000 + _k() % 700, "23"), F.lit("\n2. Required Courses:\n"), code("PHY", 1000 + _k() % 7, "3"), F.lit("A, "),
        code("CSC", 4000 + _k() % 800, "3"), F.lit("; "), code("CSC", 4000 + _k() % 800, "3"), F.lit("\n3. Elective Courses:\n"), code("ECO", 5000 + _k() % 600), F.lit("\ni) "),
        F.element_at(F.array(*map(F.lit, ("Data Mill Stream", "Web  Craft Stream", "Deep Sky Quest Stream"))), (_k() % 3 + 1).cast("int")),
        F.lit("\nii) Medical Core Stream\nNotes:\n[a] see "), "p_name", F.lit("\n[b] few\n[C] "), "p_brand", F.lit(" rules hold\n"),
    )
    minor = F.concat(
        F.lit("Minor Programme Title: "), "p_name", F.lit("\nSchool Package: "), (10 + _k() % 9).cast("string"), F.lit("\n"), (20 + _k() % 8).cast("string"), F.lit(" units of Required work\nElective Courses: "),
        (30 + _k() % 7).cast("string"), F.lit("\n共: "), (100 + _k() % 50).cast("string"), F.lit("\nUnits: "), (1 + _k() % 4).cast("string"), F.lit(" for "), code("GED", 2000 + _k() % 99), F.lit("\n"),
    )
    double = F.concat(F.lit("双主修\n课程名称: 名"), "p_name", F.lit("\n适用于"), (2000 + _k() % 20).cast("string"), F.lit("年度入学学生\n"), (60 + _k() % 40).cast("string"), F.lit(" 學分\n"))
    return F.when(_k() % 4 == 0, major).when(_k() % 4 == 1, minor).when(_k() % 4 == 2, double).otherwise(F.concat(F.lit("about "), "p_name"))


def texts(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_name", "p_brand", _text().alias("text"))


def scheme_codes(spark, sf):
    rows = texts(spark, sf).select("p_partkey", F.explode(schemes.codes(F.col("text"))).alias("code"))
    return rows.select("p_partkey", "code", schemes.level(F.col("code")).alias("level"))


def scheme_units(spark, sf):
    return texts(spark, sf).select("p_partkey", schemes.units(F.col("text")).alias("units"))


def scheme_requirements(spark, sf):
    return texts(spark, sf).select("p_partkey", schemes.requirements(F.col("text")).alias("r")).select("p_partkey", "r.*")


def scheme_programme(spark, sf):
    return texts(spark, sf).select("p_partkey", schemes.programme(F.col("text")).alias("r")).select("p_partkey", "r.*")


def scheme_sections(spark, sf):
    lists = F.concat(*(schemes.section_courses(F.col("text"), name) for name in schemes.SECTIONS))
    return texts(spark, sf).select("p_partkey", F.explode(lists).alias("c")).select("p_partkey", "c.*")


def scheme_streams(spark, sf):
    return texts(spark, sf).select("p_partkey", F.explode(schemes.streams(F.col("text"))).alias("s")).select("p_partkey", "s.*")


def scheme_stream_fallback(spark, sf):
    """Streams out of the text, or out of a table where the text has none."""
    cell = F.when(_k() % 8 == 3, "（1） 数据科学；").otherwise("none")
    tables = F.array(F.array(F.array(F.lit("x"), cell)))
    rows = texts(spark, sf).where("p_partkey % 4 <> 2").select("p_partkey", F.explode(schemes.streams_of(F.col("text"), tables)).alias("s"))
    return rows.select("p_partkey", "s.*")


def scheme_notes(spark, sf):
    return texts(spark, sf).select("p_partkey", F.posexplode(schemes.notes(F.col("text"))).alias("nth", "note"))


def scheme_table_courses(spark, sf):
    """A table for each part: a header, a row of the part's, one whose code is in its first cell alone, and one without."""
    head = F.array(*map(F.lit, ("Course Code", "Course Title (English)", "Chinese title", "Units")))
    units = F.concat((_k() % 6).cast("string"), F.lit(" units"))
    row = F.array(F.concat(F.lit(" CSC "), (1000 + _k() % 900).cast("string"), F.lit("\n")), F.concat(F.lit(" "), "p_name", F.lit(" ")), F.when(_k() % 2 == 0, F.concat(F.lit("名"), "p_name")), units)
    part = spark.read.parquet(f"{sf}/part.parquet")
    tables = part.select("p_partkey", F.array(head, row, F.array(F.lit("Total"), F.lit(""), F.lit(""), F.lit("9")), F.array(F.lit("MAT2001"))).alias("rows"))
    return schemes.table_courses(tables).select("p_partkey", F.col("row_no").cast("long").alias("row_no"), "code", "name_en", "name_zh", "units", "level")


def scheme_record(spark, sf):
    got = schemes.scheme_record(texts(spark, sf))
    sizes = (F.size(f"{k}_courses").cast("long").alias(f"n_{k}") for k in schemes.SECTIONS)
    return got.select("p_partkey", "programme_name_en", "programme_type", "total_units", *sizes, F.size("streams").cast("long").alias("n_streams"), F.size("notes").cast("long").alias("n_notes"), F.col("raw_elective_section").isNotNull().alias("raw"))


QUERIES = {f.__name__: f for f in (scheme_codes, scheme_units, scheme_requirements, scheme_programme, scheme_sections, scheme_streams, scheme_stream_fallback, scheme_notes, scheme_table_courses, scheme_record)}

A = "CASE WHEN k % 4 = 0 THEN {} END"
PARTS = """p AS (
  SELECT p_partkey AS k, p_name AS name, p_brand AS brand,
    'CSC' || translate((1000 + p_partkey % 900)::VARCHAR, '23', '89') AS s1, 'MAT' || translate((4000 + p_partkey % 700)::VARCHAR, '23', '89') AS s2,
    'PHY' || translate((1000 + p_partkey % 7)::VARCHAR, '3', '8') || 'A' AS r1, 'CSC' || translate((4000 + p_partkey % 800)::VARCHAR, '3', '8') AS r2,
    'ECO' || (5000 + p_partkey % 600) AS e1, 'GED' || (2000 + p_partkey % 99) AS g1 FROM part
), c AS (
  SELECT DISTINCT k, unnest([{'t': 'school_package', 'c': s1}, {'t': 'school_package', 'c': s2}, {'t': 'required', 'c': r1}, {'t': 'required', 'c': r2}, {'t': 'elective', 'c': e1}]) AS x FROM p WHERE k % 4 = 0
)"""
LEVEL = "substr({}, 4, 1)::INT * 1000"
STREAM = "CASE k % 3 WHEN 0 THEN 'Data Mill Stream' WHEN 1 THEN 'Web Craft Stream' ELSE 'Deep Sky Quest Stream' END"
ORACLES = {
    "scheme_codes": f"WITH {PARTS}, a AS (SELECT DISTINCT k, x.c AS code FROM c UNION ALL SELECT k, g1 FROM p WHERE k % 4 = 1) SELECT k AS p_partkey, code, {LEVEL.format('code')} AS level FROM a",
    "scheme_units": "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 120 + p_partkey % 30 WHEN 1 THEN 1 + p_partkey % 4 WHEN 2 THEN 60 + p_partkey % 40 END::INT AS units FROM part",
    "scheme_requirements": """
        SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 120 + p_partkey % 30 WHEN 1 THEN 100 + p_partkey % 50 END::INT AS total_units,
          CASE WHEN p_partkey % 4 = 1 THEN 10 + p_partkey % 9 END::INT AS school_package_units, CASE WHEN p_partkey % 4 = 1 THEN 20 + p_partkey % 8 END::INT AS required_units,
          CASE WHEN p_partkey % 4 = 1 THEN 30 + p_partkey % 7 END::INT AS elective_units FROM part""",
    "scheme_programme": """
        SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN p_name END AS programme_name_en, CASE WHEN p_partkey % 4 = 2 THEN '名' || p_name END AS programme_name_zh,
          CASE p_partkey % 4 WHEN 0 THEN (2010 + p_partkey % 15) || ' and after' WHEN 2 THEN (2000 + p_partkey % 20)::VARCHAR END AS applicable_years,
          CASE p_partkey % 4 WHEN 1 THEN 'minor' WHEN 2 THEN 'double_major' ELSE 'major' END AS programme_type FROM part""",
    "scheme_sections": f"WITH {PARTS} SELECT k AS p_partkey, x.c AS code, {LEVEL.format('x.c')} AS level, x.t AS course_type FROM c",
    "scheme_streams": f"WITH {PARTS} SELECT k AS p_partkey, {STREAM} AS name_en, NULL::VARCHAR AS name_zh FROM p WHERE k % 4 = 0",
    "scheme_stream_fallback": f"WITH {PARTS} SELECT k AS p_partkey, {STREAM} AS name_en, NULL::VARCHAR AS name_zh FROM p WHERE k % 4 = 0 UNION ALL SELECT k, NULL, '数据科学' FROM p WHERE k % 8 = 3",
    "scheme_notes": """
        SELECT p_partkey, 0 AS nth, '[a] see ' || p_name AS note FROM part WHERE p_partkey % 4 = 0
        UNION ALL SELECT p_partkey, 1, '[C] ' || p_brand || ' rules hold' FROM part WHERE p_partkey % 4 = 0""",
    "scheme_table_courses": """
        SELECT p_partkey, 0 AS row_no, 'CSC' || (1000 + p_partkey % 900) AS code, p_name AS name_en, CASE WHEN p_partkey % 2 = 0 THEN '名' || p_name END AS name_zh, (p_partkey % 6)::INT AS units, 1000 AS level FROM part
        UNION ALL SELECT p_partkey, 2, 'MAT2001', NULL, NULL, NULL, 2000 FROM part""",
    "scheme_record": """
        SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN p_name ELSE '' END AS programme_name_en, CASE p_partkey % 4 WHEN 1 THEN 'minor' WHEN 2 THEN 'double_major' ELSE 'major' END AS programme_type,
          CASE p_partkey % 4 WHEN 0 THEN 120 + p_partkey % 30 WHEN 1 THEN 100 + p_partkey % 50 END::INT AS total_units, CASE WHEN p_partkey % 4 = 0 THEN 2 ELSE 0 END AS n_school_package,
          CASE WHEN p_partkey % 4 = 0 THEN 2 ELSE 0 END AS n_required, CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END AS n_elective, CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END AS n_streams,
          CASE WHEN p_partkey % 4 = 0 THEN 2 ELSE 0 END AS n_notes, false AS raw FROM part""",
}
