"""Registered queries on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import table
from .leakage import leaks
from .mixing import mix
from .spans import shared_chars, sharing


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("doc"), "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sharing(_docs(spark, d))


def p9_shared(spark: SparkSession, d: str) -> DataFrame:
    return shared_chars(_docs(spark, d)).withColumnRenamed("doc", "doc_id")


def _items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchitems").select(F.col("item_id").alias("item"), "text")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks(_docs(spark, d), _items(spark, d)).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """For each item: the documents it leaked into, and its longest runs there."""
    found = leaks(_docs(spark, d), _items(spark, d))
    n = found.groupBy("item").agg(F.count(F.lit(1)).alias("n_docs"), F.max("exact").alias("longest"), F.max("wide").alias("longest_wide"))
    return _items(spark, d).select("item").distinct().join(n, "item", "left").fillna(0).withColumnRenamed("item", "item_id")


def _mix(spark: SparkSession, d: str, **how: object) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), "text", "source")
    return mix(docs, table(spark, d, "mixtargets"), **how)


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The chosen documents, each with its repeats and its source's target and actual share: as many tokens as all sources with a target have; a source that is too small falls short."""
    return _with_shares(*_mix(spark, d))


def p8_largest_mix(spark: SparkSession, d: str) -> DataFrame:
    """The same of the largest mix in which every source that has documents reaches its share."""
    return _with_shares(*_mix(spark, d, strict=True))


def _with_shares(chosen: DataFrame, report: DataFrame) -> DataFrame:
    shares = report.select("source", "target_share", "actual_share")
    return chosen.join(shares, "source").withColumnRenamed("doc", "doc_id")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The report of p8_mix: target and actual share of each source, and what it falls short of."""
    return _mix(spark, d)[1]


def p8_largest_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d, strict=True)[1]


QUERIES = {"p8_mix": p8_mix, "p8_shares": p8_shares, "p8_largest_mix": p8_largest_mix, "p8_largest_shares": p8_largest_shares, "p7_found": p7_found, "p7_items": p7_items, "p9_found": p9_found, "p9_shared": p9_shared}
_WINDOWS = """WITH w AS (SELECT doc_id, length(text) n, unnest(range(1, length(text) - 148)) i, text FROM documents WHERE length(text) >= 150),
  h AS (SELECT doc_id, i, md5(substring(text, i, 150)) h FROM w), d AS (SELECT DISTINCT doc_id, h FROM h), """
_WIDE = "".join(map(chr, [*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]))
_NARROW = "".join(chr(ord(c) - 0xFEE0) for c in _WIDE)
_PLAIN = lambda c: rf"regexp_replace(lower(translate(nfc_normalize({c}), '{_WIDE}', '{_NARROW}')), '[^\p{{L}}\p{{N}}]+', '', 'g')"
_LEAKS = f"""WITH d AS (SELECT doc_id, {_PLAIN('text')} t FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL), i AS (SELECT item_id, {_PLAIN('text')} t FROM benchitems WHERE item_id IS NOT NULL AND text IS NOT NULL),
  w AS (SELECT DISTINCT item_id, t[k:k + 39] w FROM (SELECT item_id, t, unnest(range(1, length(t) - 38)) k FROM i WHERE length(t) >= 40)), v AS (SELECT DISTINCT doc_id, t[k:k + 39] w FROM (SELECT doc_id, t, unnest(range(1, length(t) - 38)) k FROM d WHERE length(t) >= 40)), """
SQL = {
    "p7_found": _LEAKS + "p AS (SELECT DISTINCT doc_id, item_id FROM v JOIN w USING (w)) SELECT * FROM p",
    "p9_found": _WINDOWS + "p AS (SELECT DISTINCT a.doc_id doc_lo, b.doc_id doc_hi FROM d a JOIN d b ON a.h = b.h AND a.doc_id < b.doc_id) SELECT * FROM p",
    "p9_shared": _WINDOWS
    + """m AS (SELECT h FROM d GROUP BY h HAVING count(*) > 1), c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 150)) p FROM h JOIN m USING (h)), s AS (SELECT doc_id, count(*) n FROM c GROUP BY 1)
  SELECT t.doc_id, length(text) chars, coalesce(n, 0) shared, CASE WHEN length(text) > 0 THEN coalesce(n, 0) / length(text) ELSE 0.0 END fraction FROM documents t LEFT JOIN s USING (doc_id)""",
}
