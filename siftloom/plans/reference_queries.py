"""Queries on references between questions, experiences and sources, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..operators.references import dangling, dangling_report, parents, references
from ..session import durable, table


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    q, e, s = (table(spark, d, n) for n in ("questions", "experiences", "sources"))
    refs = reduce(
        DataFrame.unionByName,
        (
            references(q, "questions", "source_ids", "sources"),
            references(e, "experiences", "question_ids", "questions"),
            references(e, "experiences", "source_id", "sources"),
        ),
    )
    return durable(refs, "references"), parents(s, "sources").unionByName(parents(q, "questions"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    refs, known = _inputs(spark, d)
    return dangling(refs, known).drop("arrival")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    refs, known = _inputs(spark, d)
    return dangling_report(refs, dangling(refs, known))


_REFS = """WITH r AS (
  SELECT 'questions' tbl, id rec_id, 'source_ids' field, 'sources' target, unnest(source_ids) ref_id FROM questions
  UNION SELECT 'experiences', id, 'question_ids', 'questions', unnest(question_ids) FROM experiences
  UNION SELECT 'experiences', id, 'source_id', 'sources', source_id FROM experiences),
a AS (SELECT 'questions' tbl, id rec_id, min(added_at) arrival FROM questions GROUP BY id
  UNION ALL SELECT 'experiences', id, min(added_at) FROM experiences GROUP BY id),
refs AS (SELECT DISTINCT r.*, arrival FROM r JOIN a USING (tbl, rec_id) WHERE ref_id IS NOT NULL),
known AS (SELECT 'sources' target, id ref_id, min(added_at) since, bool_or(deleted_at IS NOT NULL) gone FROM sources GROUP BY id
  UNION ALL SELECT 'questions', id, min(added_at), bool_or(deleted_at IS NOT NULL) FROM questions GROUP BY id),
f AS (SELECT tbl, rec_id, field, ref_id, arrival, CASE WHEN since IS NULL THEN 'missing' WHEN gone THEN 'deleted' WHEN since > arrival THEN 'late' END reason
  FROM refs LEFT JOIN known USING (target, ref_id))
"""

QUERIES = {"p1_found": p1_found, "p1_report": p1_report}
SQL = {
    "p1_found": _REFS + "SELECT tbl, rec_id, field, ref_id, reason FROM f WHERE reason IS NOT NULL",
    "p1_report": _REFS
    + """SELECT tbl, field, strftime(arrival, '%Y-%m') period, count(*) n_refs, count(*) FILTER (reason = 'missing') n_missing,
  count(*) FILTER (reason = 'deleted') n_deleted, count(*) FILTER (reason = 'late') n_late FROM f GROUP BY ALL""",
}
