"""Lists whose items are texts or objects, model output that should be JSON, and the checks on answers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import bounded, bounded_lines, string_list

# What a review may say.
VERDICTS = ("accepted", "expanded", "corrected", "generated")


def _text(v: Column, *paths: str) -> Column:
    """The first of the paths with a text that is not empty."""
    return F.coalesce(*(F.nullif(F.try_variant_get(v, p, "string"), F.lit("")) for p in paths))


def _items(json: Column) -> Column:
    """array<variant> of a JSON list; empty for anything else."""
    v = F.try_parse_json(json)
    return F.coalesce(F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")), F.array().cast("array<variant>"))


def _is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def follow_ups(json: Column, most: int = 6) -> Column:
    """array<struct<is_legacy, title, answer_short, answer_detail>> of a JSON list of texts and objects."""

    def one(v: Column) -> Column:
        title = F.when(_is_text(v), bounded(F.try_variant_get(v, "$", "string"), 240)).otherwise(bounded(_text(v, "$.title", "$.question"), 240))
        short = F.when(~_is_text(v), bounded(_text(v, "$.answer_short"), 800))
        return F.struct(_is_text(v).alias("is_legacy"), title.alias("title"), short.alias("answer_short"), F.when(~_is_text(v), bounded_lines(F.coalesce(_text(v, "$.answer_detail"), short), 3000)).alias("answer_detail"))

    return F.slice(F.filter(F.transform(_items(json), one), lambda x: (x["title"] != "") & (x["is_legacy"] | (x["answer_short"] != ""))), 1, most)


def pitfalls(json: Column, most: int = 6) -> Column:
    """array<struct<is_legacy, title, explanation, correction>>."""

    def one(v: Column) -> Column:
        title = F.when(_is_text(v), bounded(F.try_variant_get(v, "$", "string"), 280)).otherwise(bounded(_text(v, "$.title", "$.mistake"), 280))
        part = lambda *p: F.when(~_is_text(v), bounded_lines(_text(v, *p), 1800))
        return F.struct(_is_text(v).alias("is_legacy"), title.alias("title"), part("$.explanation", "$.why_wrong").alias("explanation"), part("$.correction", "$.correct_approach").alias("correction"))

    whole = lambda x: (x["title"] != "") & (x["is_legacy"] | ((x["explanation"] != "") & (x["correction"] != "")))
    return F.slice(F.filter(F.transform(_items(json), one), whole), 1, most)


def review_record(json: Column, slice_first: bool = False, most: int = 8) -> Column:
    """struct<verdict, issues, summary>, or null; slice_first cuts the issues before the empty ones leave, as audits do."""
    v = F.try_parse_json(json)
    verdict, summary = F.lower(bounded(_text(v, "$.verdict"), 30)), bounded(_text(v, "$.summary"), 500)
    raw = F.try_variant_get(v, "$.issues", "array<string>")
    issues = string_list(F.slice(raw, 1, most) if slice_first else raw, most, 240)
    return F.when(verdict.isin(*VERDICTS) & (summary != ""), F.struct(verdict.alias("verdict"), issues.alias("issues"), summary.alias("summary")))


def repaired_json(raw: Column) -> Column:
    """A variant of text that holds a JSON object: code fences and what stands around the object fall away, then trailing commas."""
    t = F.regexp_replace(F.trim(raw), r"(?s)^```[a-zA-Z]*\s*|\s*```$", "")
    t = F.regexp_replace(t, r"(?s)^[^{]*(\{.*\})[^}]*$", "$1")
    return F.coalesce(F.try_parse_json(t), F.try_parse_json(F.regexp_replace(t, r",\s*([}\]])", "$1")))


def issues_of(short: Column, detail: Column, version: Column, follow: Column, pitfall_count: Column, reviewed: Column) -> Column:
    """Codes of what an answer lacks, in a fixed order, each once; follow is array<struct<is_legacy, title, answer_short>>."""
    size = lambda c: F.length(F.trim(F.coalesce(c, F.lit(""))))
    when = lambda test, code: F.when(test, F.lit(code))
    own = F.coalesce(follow, F.array().cast("array<struct<is_legacy:boolean,title:string,answer_short:string>>"))
    each = F.flatten(F.transform(own, lambda x: F.array(when(x["is_legacy"], "legacy_follow_up"), when(~x["is_legacy"] & (size(x["answer_short"]) < 40), "follow_up_short_answer"))))
    codes = F.concat(
        F.array(
            when(~reviewed, "missing_ai_review"),
            when(F.coalesce(version, F.lit(0)) < 2, "legacy_answer_version"),
            when(size(short) < 60, "main_answer_short"),
            when(size(detail) < 400, "main_answer_detail"),
            when(F.size(own) < 3, "follow_up_breadth"),
        ),
        each,
        F.array(when(F.coalesce(pitfall_count, F.lit(0)) < 2, "pitfall_breadth")),
    )
    return F.array_distinct(F.array_compact(codes))


def priority_of(issues: Column, order: dict[str, int], default: int = 9) -> Column:
    """The smallest priority of the codes."""
    known = F.create_map(*(F.lit(x) for kv in order.items() for x in kv))
    return F.coalesce(F.array_min(F.transform(issues, lambda c: F.coalesce(F.try_element_at(known, c), F.lit(default)))), F.lit(default))
