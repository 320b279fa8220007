"""Search over records by facets and a keyword, and the catalogue that a browser loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import search_form


def haystack(texts: Sequence[str], lists: Sequence[str] = ()) -> Column:
    parts = [F.coalesce(F.col(c), F.lit("")) for c in texts] + [F.coalesce(F.array_join(c, " "), F.lit("")) for c in lists]
    return F.lower(F.concat_ws(" ", *parts))


def faceted(rows: DataFrame, facets: dict[str, str | None], keyword: str, texts: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """Rows that have the wanted value of each facet (None: any) and the keyword anywhere in their texts; facets are pushed to the scan."""
    for c, want in facets.items():
        if want is not None:
            rows = rows.where(F.col(c) == want)
    return rows.where((search_form(F.lit(keyword)) == "") | F.contains(haystack(texts, lists), search_form(F.lit(keyword))))


def catalogue(questions: DataFrame, experiences: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per domain and one for all: (domain, questions, experiences, sources); counts of records, not deliveries."""
    n = lambda df: df.agg(F.count_distinct("id")).first()[0]
    by = questions.groupBy("domain").agg(F.count_distinct("id").alias("questions"))
    return by.unionByName(questions.agg(F.count_distinct("id").alias("questions")).withColumn("domain", F.lit("*"))).withColumns({"experiences": F.lit(n(experiences)), "sources": F.lit(n(sources))})


def catalogue_lines(questions: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(line): one JSON object per question; written as text, a catalogue of any size in parallel."""
    return questions.select(F.to_json(F.struct(*fields)).alias("line"))
