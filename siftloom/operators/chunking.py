"""Long texts in pieces: greedy packing of paragraphs, and a balanced split. Column expressions, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.text import BLANKS, question_marks

CHARS, QUESTIONS = 8_000, 24


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{BLANKS}|{BLANKS}$", "")


def paragraphs(text: Column, separator: str = r"(?U)\n\s*\n") -> Column:
    return F.filter(F.transform(F.split(text, separator), _strip), lambda p: p != "")


def chunks(text: Column, limit: int = CHARS, questions: int = QUESTIONS, separator: str = r"(?U)\n\s*\n") -> Column:
    """array<string>: paragraphs, those over the limit cut hard, packed while a chunk stays within the limit and holds no more question marks than ``questions`` (0: any number)."""
    cut = lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.length(p) - 1) / limit).cast("int")), lambda i: F.substring(p, i * limit + 1, F.lit(limit)))
    pieces = F.flatten(F.transform(paragraphs(text, separator), cut))
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def pack(state: Column, piece: Column) -> Column:
        longer = _strip(F.concat(state["open"], F.lit("\n\n"), piece))
        over = (F.length(longer) > limit) | (F.lit(questions > 0) & (question_marks(longer) > questions))
        first = state["open"] == ""
        done = F.when(~first & over, F.concat(state["done"], F.array(state["open"]))).otherwise(state["done"])
        return F.struct(done.alias("done"), F.when(first | over, piece).otherwise(longer).alias("open"))

    return F.aggregate(pieces, empty, pack, lambda s: F.when(s["open"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))))


def halves(text: Column, least: int = 400) -> Column:
    """struct<left, right> at the paragraph end nearest to the middle, or in the middle itself where that would leave less than a fifth; null for short texts."""
    ps = paragraphs(text)
    middle = F.floor(F.length(text) / 2).cast("int")
    # The length of the first k paragraphs, two characters after each.
    upto = lambda k: F.aggregate(F.slice(ps, 1, k), F.lit(0), lambda n, p: n + F.length(p) + 2)
    ends = F.transform(F.sequence(F.lit(1), F.greatest(F.size(ps) - 1, F.lit(1))), lambda k: F.struct(F.abs(upto(k) - middle).alias("far"), k.alias("k")))
    k = F.array_min(ends)["k"]
    left, right = (F.array_join(x, "\n\n") for x in (F.slice(ps, F.lit(1), k), F.slice(ps, k + 1, F.greatest(F.size(ps) - k, F.lit(0)))))
    plain = (_strip(F.left(text, middle)), _strip(F.substring(text, middle + 1, F.length(text))))
    uneven = (F.size(ps) < 2) | (F.least(F.length(left), F.length(right)) < F.floor(F.length(text) / 5))
    a, b = F.when(uneven, plain[0]).otherwise(left), F.when(uneven, plain[1]).otherwise(right)
    return F.when((F.length(text) >= least) & (a != "") & (b != ""), F.struct(a.alias("left"), b.alias("right")))
