"""Texts cut off before their end, found by what the corpus says about their last words. Pure SQL.

A token is a Han character, a word, a number or a sign. Every trigram of tokens in every text counts as inside or, before a
sentence end or a line end, as terminal. A text that doesn't end with a sentence end is joined with the count of its last
trigram (of its last two tokens or its last one, where the longer ones are too rare): trigrams that are frequent inside
but almost never terminal are where no writer stops. What was put after a break (an ellipsis, a note that there is more,
half a tag, a broken character) is taken off first. Brackets, quoted code and code blocks that are open at the end are
cut whatever their words.

Writers differ: where the texts of a group that surely end (their last trigram is nearly always terminal) often do without
a full stop, an end in doubt is taken for an end; elsewhere a missing full stop is a cut, unless the last trigram is that of a whole
text (a title) that ends so too. List items end without a full stop everywhere.

Defined cases: null texts, blank texts, placeholders and texts of fewer than three letters or digits are no cases; a text that occurs under several
records is judged for each; repeated rows count once; an empty table gives no rows; texts of any length are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.web import let
from ..session import durable

#: A trigram decides from so many occurrences on.
SUPPORT = 10
#: Part of its occurrences at an end below which nobody stops there, and from which an end is sure.
NEVER, SURE = 0.1, 0.9
#: Part of the sure ends without a full stop from which a group has that habit.
HABIT = 0.02

_TOKEN = r"[a-z][a-z_0-9]*|0|\n|[^\s]"
_NUMBER = "0x[0-9a-f]+|[0-9]+"
_END = "('。', '！', '？', '!', '?', '.', '…', '\n')"
_SPACES = " \t\r\n\u3000\u00a0\u200b\u200c\u200d\u2060\ufeff\u2002\u2003\u2007\u2009\u202f"
#: Characters at a text's end that patterns look at first.
TAIL = 160
# What is put after a break. Whitespace is matched from its first character on only, so a long run costs one pass.
_AFTER = (
    r"(?:(?<!\s)\s++|（(?:展开|余下|下略|未完|以下|全文|更多|阅读|查看|略)[^（）]{0,14}）|\((?:more|truncated|continued|to be|read)[^()]{0,24}\)"
    r"|\[(?:更多|截断|下略|more|truncated|cut|\.\.\.|…)[^\[\]]{0,12}\]|</?[A-Za-z][^<>]{0,40}>?|(?<!…)…++|(?<!\.)\.{2,}+|\x{FFFD}++)++$"
)
_STOP = r"[。！？!?.][”’\"'」』）)\]】]*$"
_ITEM = r"^\s*([-*•·]|[0-9]+[.、)）])\s"
_BARE_ITEM = r"^\s*([-*•·]|[0-9]+[.、)）]?)\s*$"

# What stands where an answer should be, as letters and digits in lower case.
PLACEHOLDERS = (
    "na", "nan", "null", "none", "nil", "todo", "tbd", "undefined", "empty", "noanswer", "pending", "placeholder", "xxx",
    "无", "空", "略", "暂无", "暂缺", "待补", "待补充", "待填", "待填写", "待定", "待完善", "待更新", "待续", "没有", "未填", "未填写", "无内容", "无答案", "没有答案",
    "暂无答案", "暂无内容", "暂无解答", "答案略", "答案待补充", "同上", "见上", "如题",
)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.regexp_replace(F.lower(text), _NUMBER, "0"), F.lit(_TOKEN), 0)


def trigram_counts(texts: DataFrame) -> DataFrame:
    """(a, b, c, n, ends) of all trigrams in texts (text) that something follows."""
    t = texts.select(tokens(F.col("text")).alias("t"))
    after = lambda k: f"slice(t, {k}, greatest(size(t) - {k - 1}, 0))"
    rows = t.where("size(t) > 3").selectExpr(f"inline(arrays_zip(t, {after(2)}, {after(3)}, {after(4)})) AS (a, b, c, d)")
    return rows.where("d IS NOT NULL AND c <> '\n'").groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"), F.expr(f"count_if(d IN {_END})").alias("ends"))


def _body(whole: Column) -> Column:
    """The text, without blanks at its end, without what was put after its break. The pattern sees the last characters, and all of a text only if these fall away altogether.

    It is tried only where the text's end can be the end of such a mark: a bracket, dots, a broken character, or a tag begun shortly before.
    """
    end = F.right(whole, F.lit(1))
    may = end.isin("）", ")", "]", "…", "\ufffd") | whole.endswith("..") | F.contains(F.right(whole, F.lit(44)), F.lit("<")) | end.rlike(r"\s")
    tail = F.regexp_replace(F.right(whole, F.lit(TAIL)), _AFTER, "")
    bare = F.when(F.length(whole) <= TAIL, tail).when(tail != "", F.concat(F.left(whole, F.length(whole) - TAIL), tail)).otherwise(F.regexp_replace(whole, _AFTER, ""))
    return F.when(may, bare).otherwise(whole)


def _last_tokens(body: Column) -> Column:
    """The last three tokens; all of a text is taken apart only if its last characters hold no more than three."""
    enough = lambda near: F.when((F.size(near) > 3) | (F.length(body) <= TAIL), near).otherwise(tokens(body))
    return let(let(tokens(F.right(body, F.lit(TAIL))), enough), lambda t: F.slice(t, F.greatest(F.size(t) - 2, F.lit(1)), F.lit(3)))


def _first_look() -> Column:
    """cut, whole, none or doubt of (text, body, last) from the form of the end alone."""
    text, body, last = F.col("text"), F.col("body"), F.col("last")
    n = lambda c, t: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    more = lambda a, b: F.contains(body, F.lit(a)) & (n(a, body) > n(b, body))
    is_open = (n("`", last) % 2 == 1) | more("（", "）") | more("【", "】") | more("《", "》") | (n("(", last) > n(")", last)) | more("(", ")")
    fences = (F.length(body) - F.length(F.replace(body, F.lit("```"), F.lit("")))) / 3
    bare = F.regexp_replace(F.lower(F.trim(text)), r"[^\p{L}\p{N}]", "")
    return (
        F.when(~text.rlike(r"[\p{L}\p{N}](?:[^\p{L}\p{N}]*+[\p{L}\p{N}]){2}"), "none")
        .when((F.length(F.trim(text)) <= 40) & bare.isin(*PLACEHOLDERS), "none")
        .when(fences % 2 == 1, "cut")
        .when(body.endswith("```"), "whole")
        .when(last.rlike(_BARE_ITEM), "cut")
        .when(is_open, "cut")
        .when(F.right(body, F.lit(8)).rlike(_STOP), F.lit("stop"))
        .when(F.right(body, F.lit(1)).isin(*"：:，,、；;（("), "cut")
        .otherwise("doubt")
    )


def truncated(rows: DataFrame, more: DataFrame) -> DataFrame:
    """From rows (key..., grp, text) and further whole texts (text) to count: (key..., grp, cut BOOLEAN), one row per text."""
    keys = [c for c in rows.columns if c != "text"]
    rows = durable(rows.where("text IS NOT NULL").distinct(), "texts")
    ends = rows.withColumn("whole", F.rtrim("text", F.lit(_SPACES))).withColumn("body", _body(F.col("whole"))).withColumn("last", F.substring_index("body", "\n", -1)).withColumn("look", _first_look())
    looked = ends.select(
        *keys, "look", F.when(F.col("look") == "doubt", _last_tokens(F.col("body"))).alias("t"),
        F.col("last").rlike(_ITEM).alias("item"), (F.col("body") != F.col("whole")).alias("after"),
    )
    looked = durable(looked, "looked")
    last = lambda k: F.try_element_at("t", F.lit(-k))
    doubt = looked.where("look = 'doubt'").select(*keys, "item", "after", last(3).alias("a"), last(2).alias("b"), last(1).alias("c"))
    # Counted, so that a text is taken apart once however many records have it.
    more = more.where("text IS NOT NULL").groupBy("text").agg(F.count(F.lit(1)).alias("times")).where("times > 0").select("text")
    counts = durable(trigram_counts(rows.select("text").unionByName(more.select(F.concat("text", F.lit("\n")).alias("text")))), "trigrams")
    two = counts.groupBy("b", "c").agg(F.sum("n").alias("n2"), F.sum("ends").alias("ends2"))
    one = counts.groupBy("c").agg(F.sum("n").alias("n1"), F.sum("ends").alias("ends1"))
    three = counts.withColumnsRenamed({"n": "n3", "ends": "ends3"})
    # A text that something was put after has counted its own last trigram as an end.
    own = F.when(F.col("after"), 1).otherwise(0)
    part_of = lambda k: F.when(F.col(f"n{k}") - own >= SUPPORT, (F.col(f"ends{k}") - own) / (F.col(f"n{k}") - own))
    closed = more.select(_last_tokens(F.col("text")).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("times"))
    closings = closed.select(last(3).alias("a"), last(2).alias("b"), last(1).alias("c"), (F.col("times") > 0).alias("closing"))
    part = doubt.join(three, ["a", "b", "c"], "left").join(two, ["b", "c"], "left").join(one, "c", "left").join(closings, ["a", "b", "c"], "left")
    part = durable(part.select(*doubt.columns, F.coalesce(part_of(3), part_of(2), part_of(1)).alias("part"), F.coalesce("closing", F.lit(False)).alias("closing")), "ends")
    bare = part.where((F.col("part") >= SURE) & ~F.col("item") & ~F.col("after")).groupBy("grp").agg(F.count(F.lit(1)).alias("bare"))
    full = looked.where("look = 'stop'").groupBy("grp").agg(F.count(F.lit(1)).alias("full"))
    habit = bare.join(full, bare.grp.eqNullSafe(full.grp), "left").select(bare.grp.alias("of"), (F.col("bare") >= HABIT * (F.col("bare") + F.coalesce("full", F.lit(0)))).alias("habit"))
    judged = part.join(habit, part.grp.eqNullSafe(habit.of), "left").withColumn(
        "cut",
        F.when(F.col("part").isNull(), F.col("c").rlike("^[a-z0-9_]+$"))
        .when(F.col("after"), F.col("part") < 0.5)
        .when(F.col("item") | F.coalesce("habit", F.lit(False)), F.col("part") < NEVER)
        .otherwise((F.col("part") < SURE) | ~F.col("closing")),
    )
    plain = looked.where("look <> 'doubt'").withColumn("cut", F.col("look") == "cut")
    return plain.select(*keys, "cut").unionByName(judged.select(*keys, "cut"))
