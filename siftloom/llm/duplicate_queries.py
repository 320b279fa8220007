"""Registered queries on near-duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import table
from .history import History, accept_batch, known_rows
from .near_duplicates import classes_of, near_duplicates, pairs_of
from .text_queries import letters_sql, titles

TABLES = ("questions", "review")


def _rows(spark: SparkSession, d: str) -> DataFrame:
    part = F.when(F.col("tbl") == TABLES[0], 0).otherwise(1).cast("long").alias("part")
    return titles(spark, d, *TABLES).select(part, "id", "title")


def _table_name() -> Column:
    return F.when(F.col("part") == 0, TABLES[0]).otherwise(TABLES[1]).alias("tbl")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs_of(*near_duplicates(_rows(spark, d))).select(_table_name(), "id_lo", "id_hi")


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row per id: its class of equal forms, the ids in it, and the classes similar to it."""
    return classes_of(*near_duplicates(_rows(spark, d))).select(_table_name(), "id", "class_id", "members", "links")


def _new(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "review").select(F.col("review_id").alias("id"), "title", F.col("batch_no").alias("batch"), F.col("arrived_at").alias("at"))


def _old(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "questions").select("id", "title", F.col("added_at").alias("since"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return known_rows(_new(spark, d), _old(spark, d)).select(F.col("id").alias("review_id"))


def p5_last_batch(spark: SparkSession, d: str) -> DataFrame:
    """The known rows of the last batch alone, delivered to the kept history of all before it."""
    new, old = _new(spark, d), _old(spark, d)
    last = new.agg(F.max("batch")).first()[0]
    _, kept = accept_batch(History(), new.where(F.col("batch") < F.lit(last)), old)
    known, _ = accept_batch(kept, new.where(F.col("batch") == F.lit(last)), old.limit(0))
    return known.select(F.col("id").alias("review_id"))


QUERIES = {"p3_found": p3_found, "p3_classes": p3_classes, "p5_found": p5_found, "p5_last_batch": p5_last_batch}

_GRAMS = "list_distinct(list_transform(range(1, length(k)), lambda i: k[i:i+1]))"
#: Similar forms (x, y) of the distinct forms in the table ``forms`` (k), equal ones too, by counting the pieces that two have in common.
_ALIKE = f"""fg AS (SELECT k, {_GRAMS} g FROM forms), fu AS (SELECT k, len(g) n, unnest(g) p FROM fg), fp AS (SELECT a.k x, b.k y, a.n + b.n n, count(*) m FROM fu a JOIN fu b ON a.p = b.p AND a.k < b.k GROUP BY ALL),
  alike AS (SELECT x, y FROM fp WHERE m >= 0.7 * (n - m) - 1e-9), both_ways AS (SELECT x, y FROM alike UNION ALL SELECT y, x FROM alike UNION ALL SELECT k, k FROM forms)"""
_TITLES = f"t AS (SELECT 'questions' tbl, id, {letters_sql('title')} k FROM questions WHERE id IS NOT NULL AND title IS NOT NULL UNION SELECT 'review', review_id, {letters_sql('title')} FROM review WHERE review_id IS NOT NULL AND title IS NOT NULL)"
SQL = {
    "p3_found": f"""WITH {_TITLES}, forms AS (SELECT DISTINCT k FROM t), {_ALIKE} SELECT DISTINCT a.tbl, a.id id_lo, b.id id_hi FROM t a JOIN both_ways s ON s.x = a.k JOIN t b ON b.k = s.y AND b.tbl = a.tbl AND a.id < b.id""",
    "p3_classes": f"""WITH {_TITLES}, forms AS (SELECT DISTINCT k FROM t), {_ALIKE}, c AS (SELECT tbl, k, min(id) class_id, count(DISTINCT id) members FROM t GROUP BY ALL),
      l AS (SELECT c.tbl, c.k, count(*) links FROM c JOIN both_ways s ON s.x = c.k AND s.y <> c.k JOIN c d ON d.tbl = c.tbl AND d.k = s.y GROUP BY ALL)
      SELECT t.tbl, t.id, class_id, members, coalesce(links, 0) links FROM t JOIN c USING (tbl, k) LEFT JOIN l USING (tbl, k)""",
    "p5_found": (_KNOWN := f"""WITH r AS (SELECT DISTINCT review_id id, batch_no b, arrived_at tm, {letters_sql('title')} k FROM review WHERE review_id IS NOT NULL), o AS (SELECT id, min(added_at) s FROM questions WHERE id IS NOT NULL GROUP BY id), q AS (SELECT DISTINCT id, s, {letters_sql('title')} k FROM questions JOIN o USING (id)),
      forms AS (SELECT k FROM r WHERE k IS NOT NULL UNION SELECT k FROM q WHERE k IS NOT NULL), {_ALIKE}, f AS (SELECT k, min(b) b, NULL::TIMESTAMP s FROM r WHERE k IS NOT NULL GROUP BY k UNION ALL SELECT k, NULL, min(s) FROM q WHERE k IS NOT NULL GROUP BY k),
      h AS (SELECT x k, min(b) b, min(s) s FROM both_ways JOIN f ON f.k = y GROUP BY x), i AS (SELECT id, min(b) b, min(s) s FROM (SELECT id, b, NULL::TIMESTAMP s FROM r UNION ALL SELECT id, NULL, s FROM o) GROUP BY id)
      SELECT DISTINCT r.id review_id FROM r LEFT JOIN h ON h.k = r.k LEFT JOIN i ON i.id = r.id WHERE (h.b < r.b OR h.s < r.tm OR i.b < r.b OR i.s < r.tm)"""),
    "p5_last_batch": _KNOWN + " AND r.b = (SELECT max(b) FROM r)",
}
