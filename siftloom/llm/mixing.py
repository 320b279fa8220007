"""A training mix in which each source has its target share of all tokens, and no document is used more than max_repeats times.

The corpus is seen twice: once to count each text's tokens, once (the kept counts) to select. A source's documents are
taken in their seeded order, whatever their lengths, in whole rounds while the budget holds all of them and then one by one
until a small rest is left. A bounded knapsack over all lengths that are left, exact by token length however many documents
there are, fits that rest to the token. Where the least rest can't be fitted a larger one is tried, up to REST tokens, and
then a budget of up to WHOLE tokens as a whole, so such a budget is met if any subset meets it. A larger budget may be
missed that another choice of documents would meet: then the nearest of the tries holds, and the report gives its gap as not proved. Which
documents of a length are taken is by the seeded order too, so equal seeds give equal mixes on any cluster.

Budgets: ``total`` tokens times the share. A source that is too small gives each of its documents max_repeats times, and the shares
left open are reported. Without ``total``, the mix is the largest in which every source that has documents reaches its
share, the shares of sources without any counted out (``strict``), or as large as the tokens of all sources with a target.

Source names are compared in lower case, without blanks at their ends, underscores as hyphens.

Defined cases: null texts, null ids and null sources take no part; texts without tokens are never chosen; repeated rows of an id count once, the least of
its texts holds; targets that are null or not positive, and sources without a target, give nothing; an empty table gives no
rows; the report has a row for every target.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType

from ..session import durable

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
#: Tokens of a source's budget that are left to the dynamic program, and those of a budget that it fits as a whole where no rest was fitted to the token.
REST, WHOLE = 40_000, 2_000_000
#: Steps of the program from one stored state to the next.
STORED = 64
#: The rests that are tried, the least first: what the program chooses doesn't follow the seeded order, so it gets as little as it can.
RESTS = tuple(REST >> k for k in range(6, -1, -1))
#: Ranks within a length are found in so many slices at least, and in one more for so many documents.
SLICES, SLICE_DOCS = 64, 1_000_000


def token_count(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Tokens of a sentencepiece model; the model is read once per worker."""

    @F.pandas_udf(IntegerType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer)
        for texts in batches:
            # A batch's texts go in by slices, so their ids don't stand in memory all at once.
            values, out = texts.tolist(), []
            for k in range(0, len(values), 256):
                out += map(len, model.encode(values[k : k + 256], num_threads=1))
            yield pd.Series(out, dtype="int32")

    return count(text)


def source_name(c: str) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), "_", "-")


def counted(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """From (doc, text, source): (doc, source, tokens), kept in the shared folder."""
    rows = docs.where("doc IS NOT NULL AND text IS NOT NULL AND source IS NOT NULL")
    made = rows.select("doc", source_name("source").alias("source"), token_count(F.col("text"), tokenizer).alias("tokens"))
    one = made.groupBy("doc").agg(F.min(F.struct("source", "tokens")).alias("x")).select("doc", "x.source", "x.tokens")
    return durable(one.where("tokens > 0"), "tokens")


def fit(lengths: np.ndarray, copies: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: how many of each length come nearest to the budget from below, over all lengths, by dynamic programming over sums.

    The sums reached are the bits of one number; so many copies of a length are a few steps (1, 2, 4 .. copies at once). Every
    STORED-th state is kept, and the way back works out those between again.
    """
    budget = int(min(budget, int((lengths * copies).sum())))
    steps = []
    for k, (w, c) in enumerate(zip(lengths.tolist(), copies.tolist())):
        c, n = min(c, budget // w), 1
        while c > 0:
            steps.append((k, min(n, c), w * min(n, c)))
            c -= n
            n *= 2
    mask, reach, states = (1 << budget + 1) - 1, 1, []
    for i, (_, _, by) in enumerate(steps):
        if i % STORED == 0:
            states.append(reach)
        reach |= reach << by & mask
        if reach >> budget & 1:
            steps = steps[: i + 1]
            break
    at, out = reach.bit_length() - 1, np.zeros(len(lengths), np.int64)
    for j in range((len(steps) - 1) // STORED, -1, -1):
        part, before = steps[j * STORED : (j + 1) * STORED], [states[j]]
        for _, _, by in part[:-1]:
            before.append(before[-1] | before[-1] << by & mask)
        for (k, n, by), had in zip(reversed(part), reversed(before)):
            if not had >> at & 1:
                out[k] += n
                at -= by
    assert at == 0
    return out


def _filled(length: np.ndarray, uses: np.ndarray, most: np.ndarray, budget: int, limit: int) -> np.ndarray:
    """uses, and what fits the rest of the budget best: by the dynamic program over all lengths that have copies left."""
    uses = uses.copy()
    rest = budget - int((length * uses).sum())
    left = most - uses
    if rest > 2 * limit:
        # The next document in order is longer than the program takes: an even draw from those that it takes, a step of 1 / part.
        fits = np.where(length <= limit, left, 0)
        part = min(1.0, (rest - limit) / max(1.0, float((length * fits).sum())))
        drawn = np.diff(np.floor(np.cumsum(fits) * part + 0.5).astype(np.int64), prepend=0)
        for k in np.flatnonzero(drawn):
            m = min(int(drawn[k]), int(left[k]), rest // int(length[k]))
            uses[k] += m
            rest -= m * int(length[k])
        left = most - uses
    step = np.argsort(-np.minimum(left, rest // np.maximum(length, 1)), kind="stable")
    step = step[(left[step] > 0) & (length[step] <= rest)]
    uses[step] += fit(length[step], left[step], min(rest, 2 * limit))
    return uses


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    """One source's lengths (tokens, level, n, budget, max_repeats) to (source, tokens, uses): uses of all documents of a length together.

    A document of level v is in order before the last RESTS[v - 1] tokens of the budget. The least rest that is fitted to
    the token holds; where none is, the nearest.
    """
    r, budget = int(pdf["max_repeats"].iloc[0]), int(pdf["budget"].iloc[0])
    by_level = pdf.pivot_table(index="tokens", columns="level", values="n", aggfunc="sum", fill_value=0).reindex(columns=range(len(RESTS) + 1), fill_value=0)
    length, held = by_level.index.to_numpy(np.int64), by_level.to_numpy(np.int64)
    n = held.sum(axis=1)
    most = n * r
    if int((length * most).sum()) <= budget:
        uses = most
    else:
        rounds = n * (budget // int((length * n).sum()))
        starts = [(rounds + held[:, j + 1 :].sum(axis=1), REST) for j in range(len(RESTS))]
        if budget <= WHOLE:
            starts.append((np.zeros_like(n), budget))
        uses = None
        for start, limit in starts:
            got = _filled(length, start, most, budget, limit)
            if uses is None or int((length * got).sum()) > int((length * uses).sum()):
                uses = got
            if int((length * uses).sum()) == budget:
                break
    return pd.DataFrame({"source": pdf["source"].iloc[0], "tokens": length.astype("int32"), "uses": uses})


def budgets(tokens: DataFrame, targets: DataFrame, total: int | None, strict: bool) -> DataFrame:
    """(source, share, max_repeats, n_docs, available, budget) of each target."""
    own = tokens.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("tokens").cast("long")).alias("available"))
    t = targets.where("source IS NOT NULL AND target_share > 0 AND max_repeats > 0").groupBy(source_name("source").alias("source")).agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("max_repeats"))
    t = durable(t.join(own, "source", "left").fillna(0, ["n_docs", "available"]), "targets")
    if total is None:
        most = F.col("available") * F.col("max_repeats") / F.col("share")
        row = t.where("available > 0").agg(F.min(most).alias("strict"), F.sum("available").alias("all"), F.sum("share").alias("share")).first()
        total = int((row["strict"] * row["share"] if strict else row["all"]) or 0)
        if strict:
            return t.withColumn("budget", F.round(F.lit(float(total)) * F.col("share") / (row["share"] or 1.0)).cast("long"))
    return t.withColumn("budget", F.round(F.lit(float(total)) * F.col("share")).cast("long"))


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, strict: bool = False, seed: int = 42, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """The chosen documents (doc, source, tokens, repeats), and the report (source, target_share, budget, n_docs, available, chosen, used_tokens, actual_share, most_repeats, gap, gap_is_least)."""
    tokens = counted(docs, tokenizer)
    plan = budgets(tokens, targets, total, strict)
    tokens = tokens.join(plan.select("source"), "source", "left_semi")
    # The seeded order of a source: slices of the hash are numbered and summed apart and begin where the slices before them end.
    order = F.xxhash64("doc", F.lit(seed))
    slices = max(SLICES, (plan.agg(F.sum("n_docs")).first()[0] or 0) // SLICE_DOCS)
    keyed = tokens.select("doc", "source", "tokens", order.alias("h")).withColumn("slice", F.pmod("h", F.lit(slices)))
    cell = Window.partitionBy("source", "slice").orderBy("h", "doc")
    within = F.row_number().over(Window.partitionBy("source", "slice", "tokens").orderBy("h", "doc")) - 1
    keyed = durable(keyed.select("doc", "source", "tokens", "slice", F.sum(F.col("tokens").cast("long")).over(cell).alias("sum"), within.alias("k")), "order")
    ends = keyed.groupBy("source", "slice").agg(F.max("sum").alias("all"))
    ends = ends.select("source", "slice", (F.sum("all").over(Window.partitionBy("source").orderBy("slice")) - F.col("all")).alias("before"))
    own = plan.where("available > 0").select("source", "budget", "max_repeats", F.expr("budget % available").alias("last"))
    gap = F.col("last") - F.col("before") - F.col("sum")
    level = reduce(Column.__add__, ((gap >= x).cast("int") for x in RESTS))
    # A source's lengths are few: at most as many as its longest text has tokens.
    by_length = keyed.join(ends, ["source", "slice"]).join(own.select("source", "last"), "source").groupBy("source", "tokens", level.alias("level")).agg(F.count(F.lit(1)).alias("n"))
    by_length = by_length.join(own.drop("last"), "source")
    uses = durable(by_length.groupBy("source").applyInPandas(_plan, "source STRING, tokens INT, uses BIGINT").where("uses > 0"), "uses")
    sizes = keyed.groupBy("source", "tokens", "slice").agg(F.count(F.lit(1)).alias("size"))
    length = Window.partitionBy("source", "tokens")
    starts = sizes.select(
        "source", "tokens", "slice", (F.sum("size").over(length.orderBy("slice")) - F.col("size")).alias("start"), F.sum("size").over(length).alias("n")
    )
    ranked = keyed.join(starts, ["source", "tokens", "slice"]).join(uses, ["source", "tokens"])
    rank = F.col("start") + F.col("k")
    # Uses spread evenly: every document uses div n times, the first uses mod n once more.
    repeats = (F.expr("uses DIV n") + F.when(rank < F.col("uses") % F.col("n"), 1).otherwise(0)).cast("int")
    chosen = durable(ranked.select("doc", "source", "tokens", repeats.alias("repeats")).where("repeats > 0"), "mix")
    got = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("chosen"), F.sum(F.col("tokens").cast("long") * F.col("repeats")).alias("used_tokens"), F.max("repeats").alias("most_repeats"))
    report = plan.join(got, "source", "left").fillna(0)
    share = F.col("used_tokens") / F.sum("used_tokens").over(Window.partitionBy(F.lit(0)))  # one row per target
    gap = F.col("budget") - F.col("used_tokens")
    least = (gap == 0) | (F.col("budget") <= WHOLE) | (F.col("available") * F.col("max_repeats") <= F.col("budget"))
    return chosen, report.select(
        "source", F.col("share").alias("target_share"), "budget", "n_docs", "available", "chosen", "used_tokens", F.coalesce(share, F.lit(0.0)).alias("actual_share"), "most_repeats", gap.alias("gap"), least.alias("gap_is_least")
    )
