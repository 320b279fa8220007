"""Registered queries on answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import table
from .pairs import broken_pairs
from .truncation import HABIT, NEVER, PLACEHOLDERS, SUPPORT, SURE, truncated


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """(tbl, rec_id, grp, text) for each answer, with the texts judged and the groups that have a habit of their own."""
    q = table(spark, d, "questions").select(F.lit("questions").alias("tbl"), F.col("id").alias("rec_id"), F.lit("questions").alias("grp"), F.col("answer_detail").alias("text"))
    r = table(spark, d, "review").select(F.lit("review").alias("tbl"), F.col("review_id").alias("rec_id"), F.col("candidate_provider").alias("grp"), F.col("source_answer").alias("text"))
    return q.unionByName(r).where("rec_id IS NOT NULL")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return truncated(_answers(spark, d), table(spark, d, "questions").select(F.col("title").alias("text")).distinct()).where("cut").select("tbl", "rec_id").distinct()


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    """(tbl, source, n, n_cut, rate): per candidate_provider for review, per kind of the sources named for questions."""
    judged = truncated(_answers(spark, d), table(spark, d, "questions").select(F.col("title").alias("text")).distinct())
    judged = judged.groupBy("tbl", "rec_id", "grp").agg(F.max("cut").alias("cut"))
    named = table(spark, d, "questions").select(F.col("id").alias("rec_id"), F.explode("source_ids").alias("source_id")).where("source_id IS NOT NULL").distinct()
    kinds = table(spark, d, "sources").select(F.col("id").alias("source_id"), "kind").distinct()
    by_kind = named.join(kinds, "source_id", "left").select("rec_id", F.coalesce("kind", F.lit("unknown")).alias("source")).distinct()
    q = judged.where("tbl = 'questions'").join(by_kind, "rec_id", "left").select("tbl", F.coalesce("source", F.lit("none")).alias("source"), "cut")
    r = judged.where("tbl = 'review'").select("tbl", F.coalesce("grp", F.lit("unknown")).alias("source"), "cut")
    counted = q.unionByName(r).groupBy("tbl", "source").agg(F.count(F.lit(1)).alias("n"), F.count_if("cut").alias("n_cut"))
    return counted.withColumn("rate", F.col("n_cut") / F.col("n"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return broken_pairs(table(spark, d, "questions"))


QUERIES = {"p6_found": p6_found, "p4_found": p4_found, "p4_rates": p4_rates}

_BLANK = "' ' || chr(9) || chr(13) || chr(10) || chr(12288) || chr(160) || chr(8203) || chr(8204) || chr(8205) || chr(8288) || chr(65279) || chr(8194) || chr(8195) || chr(8199) || chr(8201) || chr(8239)"
_MARKS = (
    r"(\s+|（(展开|余下|下略|未完|以下|全文|更多|阅读|查看|略)[^（）]{0,14}）|\((more|truncated|continued|to be|read)[^()]{0,24}\)"
    r"|\[(更多|截断|下略|more|truncated|cut|\.\.\.|…)[^\[\]]{0,12}\]|</?[A-Za-z][^<>]{0,40}>?|…+|\.{2,}|\x{FFFD}+)+$"
)
_NONE = "[" + ", ".join(f"'{x}'" for x in PLACEHOLDERS) + "]"
_TOKENS = lambda c: rf"regexp_extract_all(regexp_replace(lower({c}), '0x[0-9a-f]+|[0-9]+', '0', 'g'), '[a-z][a-z_0-9]*|0|\n|[^\s]')"
_MORE = lambda a, b, c="body": f"length(replace({c}, '{a}', '')) < length(replace({c}, '{b}', ''))"
_JUDGED = rf"""r AS (SELECT DISTINCT * FROM (SELECT 'questions' tbl, id rec_id, 'questions' grp, answer_detail AS text FROM questions UNION ALL SELECT 'review', review_id, candidate_provider, source_answer FROM review) WHERE rec_id IS NOT NULL AND text IS NOT NULL),
  w AS (SELECT *, rtrim(text, {_BLANK}) whole FROM r), b AS (SELECT *, regexp_replace(whole, '{_MARKS}', '') body FROM w), z AS (SELECT *, string_split(body, chr(10))[-1] AS last FROM b),
  k AS (SELECT *, body <> whole AS "after", regexp_matches(last, '^\s*([-*•·]|[0-9]+[.、)）])\s') item, CASE
    WHEN NOT regexp_matches(text, '[\p{{L}}\p{{N}}]([^\p{{L}}\p{{N}}]*[\p{{L}}\p{{N}}]){{2}}') THEN 'none'
    WHEN length(trim(text)) <= 40 AND list_contains({_NONE}, regexp_replace(lower(trim(text)), '[^\p{{L}}\p{{N}}]', '', 'g')) THEN 'none'
    WHEN ((length(body) - length(replace(body, '```', ''))) / 3) % 2 = 1 THEN 'cut' WHEN ends_with(body, '```') THEN 'whole' WHEN regexp_matches(last, '^\s*([-*•·]|[0-9]+[.、)）]?)\s*$') THEN 'cut'
    WHEN (length(last) - length(replace(last, '`', ''))) % 2 = 1 OR {_MORE('（', '）')} OR {_MORE('【', '】')} OR {_MORE('《', '》')} OR {_MORE('(', ')', 'last')} OR {_MORE('(', ')')} THEN 'cut'
    WHEN regexp_matches(right(body, 8), '[。！？!?.][”’"''」』）)\]】]*$') THEN 'stop' WHEN right(body, 1) IN ('：', ':', '，', ',', '、', '；', ';', '（', '(') THEN 'cut' ELSE 'doubt' END look FROM z),
  m AS (SELECT DISTINCT title FROM questions WHERE title IS NOT NULL), t AS (SELECT {_TOKENS('text')} t FROM r UNION ALL SELECT {_TOKENS("title || chr(10)")} FROM m),
  g AS (SELECT t[i] a, t[i + 1] b, t[i + 2] c, t[i + 3] d FROM (SELECT t, unnest(range(1, len(t) - 2)) i FROM t)),
  n3 AS (SELECT a, b, c, count(*) n3, count(*) FILTER (d IN ('。', '！', '？', '!', '?', '.', '…', chr(10))) e3 FROM g WHERE c <> chr(10) GROUP BY ALL),
  n2 AS (SELECT b, c, sum(n3) n2, sum(e3) e2 FROM n3 GROUP BY ALL), n1 AS (SELECT c, sum(n3) n1, sum(e3) e1 FROM n3 GROUP BY ALL),
  cl AS (SELECT DISTINCT t[-3] a, t[-2] b, t[-1] c, true closing FROM (SELECT {_TOKENS('title')} t FROM m)),
  d AS (SELECT *, t[-3] a, t[-2] b, t[-1] c, CASE WHEN "after" THEN 1 ELSE 0 END own FROM (SELECT *, {_TOKENS('body')} t FROM k WHERE look = 'doubt')),
  p AS (SELECT tbl, rec_id, grp, item, "after", d.c, coalesce(closing, false) closing, coalesce(CASE WHEN n3 - own >= {SUPPORT} THEN (e3 - own) / (n3 - own) END, CASE WHEN n2 - own >= {SUPPORT} THEN (e2 - own) / (n2 - own) END, CASE WHEN n1 - own >= {SUPPORT} THEN (e1 - own) / (n1 - own) END) part
    FROM d LEFT JOIN n3 ON n3.a = d.a AND n3.b = d.b AND n3.c = d.c LEFT JOIN n2 ON n2.b = d.b AND n2.c = d.c LEFT JOIN n1 ON n1.c = d.c LEFT JOIN cl ON cl.a = d.a AND cl.b = d.b AND cl.c = d.c),
  ba AS (SELECT grp, count(*) bare FROM p WHERE part >= {SURE} AND NOT item AND NOT "after" GROUP BY grp), fu AS (SELECT grp, count(*) n_full FROM k WHERE look = 'stop' GROUP BY grp),
  ha AS (SELECT ba.grp, bare >= {HABIT} * (bare + coalesce(n_full, 0)) habit FROM ba LEFT JOIN fu ON fu.grp IS NOT DISTINCT FROM ba.grp),
  j AS (SELECT tbl, rec_id, grp, look = 'cut' cut FROM k WHERE look <> 'doubt' UNION ALL
    SELECT tbl, rec_id, p.grp, CASE WHEN part IS NULL THEN regexp_matches(c, '^[a-z0-9_]+$') WHEN "after" THEN part < 0.5 WHEN item OR coalesce(habit, false) THEN part < {NEVER} ELSE part < {SURE} OR NOT closing END FROM p LEFT JOIN ha ON ha.grp IS NOT DISTINCT FROM p.grp)"""
SQL = {
    "p4_found": f"WITH {_JUDGED} SELECT DISTINCT tbl, rec_id FROM j WHERE cut",
    "p4_rates": f"""WITH {_JUDGED}, o AS (SELECT tbl, rec_id, grp, bool_or(cut) cut FROM j GROUP BY ALL), u AS (SELECT DISTINCT id rec_id, unnest(source_ids) source_id FROM questions),
      s AS (SELECT DISTINCT rec_id, coalesce(kind, 'unknown') kind FROM u LEFT JOIN (SELECT DISTINCT id, kind FROM sources) x ON x.id = u.source_id WHERE source_id IS NOT NULL),
      q AS (SELECT tbl, coalesce(kind, 'none') source, cut FROM o LEFT JOIN s USING (rec_id) WHERE tbl = 'questions' UNION ALL SELECT tbl, coalesce(grp, 'unknown'), cut FROM o WHERE tbl = 'review')
      SELECT tbl, source, count(*) n, count(*) FILTER (cut) n_cut, count(*) FILTER (cut) / count(*) rate FROM q GROUP BY ALL""",
}
