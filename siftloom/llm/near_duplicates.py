"""Near-duplicate texts by bottom-k sketches from one hash function.

Texts are brought to their letters form; equal forms are one representative from here on, so a group of exact copies is
one entry however large it is. A representative's sketch is the KEEP smallest hashes of its pieces, in ascending order.
The inverted lists are those of retained values: a list is keyed by a retained value and the ones next to it in the
sketch, as a language has few two-character pieces and a list of one value would hold a fixed part of all texts. Of two
texts of similarity 0.7, at most three of ten retained values are not shared, so shared ones stand next to each other:
how many at least follows from the number of pieces (``_width``). For 50 pieces four in a row are missing in 1 of
100 000 pairs at the threshold and in fewer above it.

All texts of a list meet, however long it is: a list is in the order of the numbers of pieces, so a text meets only those that
are not too large for it, and overlaps that can't reach the threshold by the pieces' parities are no candidates (bounds, no pair
is lost). Lists that a large part of all texts has are told from a sample and dealt to several tasks, each with two
of the list's blocks, so that each two blocks meet. The similarity of a candidate pair is estimated from the UNION smallest
values of its two sketches' union; what is within five standard deviations of the threshold is verified exactly.

Defined cases: null titles and null ids take no part; texts of fewer than two letters have no pieces and equal only
texts of the same form; an empty table gives no pairs; any length is processed whole; repeated rows count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StringType

from ..session import durable
from .looks import of_distinct
from .sketches import SIM, Batch, jaccard, letters_forms, may_be_similar, mix

KEEP, UNION = 32, 64
#: Steps along the lists after which the pairs found so far are made distinct.
LONG = 256
#: One text in so many tells which lists are heavy: those found so often among them. These are dealt to tasks by blocks of about so many texts.
SAMPLE, HEAVY, SPLIT = 64, 1_000, 32_768
#: What an estimate may fall short of SIM.
MARGIN = 5 * (SIM * (1 - SIM) / UNION) ** 0.5
POSTING = "key BIGINT, tail BIGINT, rep BIGINT, bits BIGINT"


@F.pandas_udf(StringType())
def form_of(titles: pd.Series) -> pd.Series:
    return of_distinct(titles, letters_forms)


@F.pandas_udf(BooleanType())
def similar_enough(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two forms reach SIM: by the estimate, then exactly."""
    a, b = a.to_numpy(), b.to_numpy()
    out = jaccard(a, b, UNION) >= SIM - MARGIN
    at = np.flatnonzero(out)
    out[at] = jaccard(a[at], b[at]) >= SIM - 1e-12
    return pd.Series(out)


def _width(pieces: np.ndarray) -> np.ndarray:
    """Retained values in a row that two similar texts have in common, the smaller of so many pieces."""
    return np.minimum(pieces, np.where(pieces <= 8, 2, np.where(pieces <= 22, 3, 4)))


def postings(forms: list[str], part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, tail, bits) of all lists that the forms stand in. The tail is the number of pieces."""
    b = Batch(forms)
    if not len(b.rows):
        return (np.empty(0, np.int64), *(np.empty(0, np.uint64),) * 3)
    kept = b.within() < KEEP
    h, text = b.h[kept], np.repeat(np.arange(len(b.rows)), np.minimum(b.sizes, KEEP))
    n = len(h)
    ends = np.cumsum(np.minimum(b.sizes, KEEP))[text]
    least = np.ceil(SIM * b.sizes - 1e-9).astype(np.int64)
    own, below = _width(b.sizes), _width(least)
    bits, count = b.parity(), b.sizes.astype(np.uint64)
    far = np.concatenate((h, np.zeros(8, np.uint64)))
    out = []
    for w in np.unique(np.concatenate((own, below))).tolist():
        at = np.flatnonzero((np.arange(n) + w <= ends) & ((own == w) | (below == w))[text])
        t = text[at]
        key = mix(part[b.rows[t]].astype(np.uint64) + np.uint64(w << 8))
        for k in range(w):
            key = mix(key ^ far[at + k])
        out.append((b.rows[t], key, count[t], bits[t]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, key, tail, bits = postings(batch.column("form").to_pylist(), batch.column("part").to_numpy())
        if len(text):
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(tail.view(np.int64)), batch.column("rep").take(pa.array(text)), pa.array(bits.view(np.int64))], ["key", "tail", "rep", "bits"])


def _distinct(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hi, lo))
    lo, hi = lo[order], hi[order]
    fresh = np.ones(len(lo), bool)
    fresh[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    return lo[fresh], hi[fresh]


def overlaps(key: np.ndarray, tail: np.ndarray, rep: np.ndarray, bits: np.ndarray, long: int = LONG) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (lo, hi) of whole lists, given in the order of key and tail; made distinct each ``long`` steps."""
    n = len(key)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if n else np.empty(0, np.int64)
    end = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
    count = tail.astype(np.int64)
    at = np.arange(n)
    out = [np.empty((2, 0), np.int64)]
    step = 0
    while True:
        step += 1
        at = at[at + step < end[at]]
        # All further ones of the list have as many pieces or more.
        at = at[count[at] >= SIM * count[at + step] - 1e-9]
        if not len(at):
            break
        to = at + step
        ok = (rep[at] != rep[to]) & may_be_similar(bits[at], bits[to], count[at], count[to])
        x, y = rep[at[ok]], rep[to[ok]]
        out.append(np.stack((np.minimum(x, y), np.maximum(x, y))))
        if step % long == 0:
            out = [np.stack(_distinct(*np.concatenate(out, axis=1)))]
    return _distinct(*np.concatenate(out, axis=1))


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pairs(cols: list[np.ndarray]) -> pa.RecordBatch:
        lo, hi = overlaps(cols[0], cols[1].view(np.uint64), cols[2], cols[3].view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi)], ["lo", "hi"])

    held: list[list[np.ndarray]] = []
    for batch in batches:
        cols = [batch.column(c).to_numpy() for c in ("key", "tail", "rep", "bits")]
        # The list at the batch's end may go on in the next batch.
        cut = int(np.searchsorted(cols[0], cols[0][-1], "left"))
        if cut:
            yield pairs([np.concatenate(c) for c in zip(*held, [x[:cut] for x in cols])])
            held = []
        elif held and held[-1][0][-1] != cols[0][0]:
            yield pairs([np.concatenate(c) for c in zip(*held)])
            held = []
        held.append([x[cut:] for x in cols])
    if held:
        yield pairs([np.concatenate(c) for c in zip(*held)])


def _parted(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Postings of heavy lists (key, blocks) under a key for each two of its blocks that a posting's block is one of; all others as they are."""
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    dealt = rows.join(heavy, "key", "left").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)).cast("long") - 1)))
    key = F.when(F.col("blocks").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.least(own, "other"), F.greatest(own, "other")))
    return dealt.select(key.alias("key"), "tail", "rep", "bits")


def candidates(reps: DataFrame) -> DataFrame:
    """From (part BIGINT, rep BIGINT, form), rep unique: the pairs (lo, hi) of representatives that stand in one list."""
    rows = reps.mapInArrow(_postings, POSTING)
    some = reps.where(F.pmod(F.xxhash64("rep"), F.lit(SAMPLE)) == 0).mapInArrow(_postings, POSTING)
    blocks = F.ceil(F.col("n") * F.lit(SAMPLE / SPLIT)).cast("long")
    heavy = durable(some.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HEAVY).select("key", blocks.alias("blocks")), "heavy")
    if not heavy.isEmpty():
        rows = _parted(rows, heavy)
    return rows.repartition("key").sortWithinPartitions("key", "tail").mapInArrow(_overlaps, "lo BIGINT, hi BIGINT").distinct()


def similar(reps: DataFrame) -> DataFrame:
    """From (part BIGINT, rep BIGINT, form), rep unique: (lo, hi, form_lo, form_hi) of one part with similarity SIM or more."""
    text = lambda side: reps.select(F.col("rep").alias(side), F.col("form").alias(f"form_{side}"))
    return candidates(reps).join(text("lo"), "lo").join(text("hi"), "hi").where(similar_enough("form_lo", "form_hi"))


def represented(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (part BIGINT, id, title): members (part, id, form), and representatives (part, rep, form) of the distinct forms."""
    members = durable(rows.where("id IS NOT NULL AND title IS NOT NULL").distinct().select("part", "id", form_of("title").alias("form")).distinct(), "members")
    reps = durable(members.select("part", "form").distinct().withColumn("rep", F.monotonically_increasing_id()), "forms")
    return members, reps


def near_duplicates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (part, id, title): members (part, rep, id), and the links (part, lo, hi) between different representatives."""
    members, reps = represented(rows)
    links = similar(reps).join(reps.select("part", F.col("rep").alias("lo")), "lo").select("part", "lo", "hi")
    return members.join(reps, ["part", "form"]).select("part", "rep", "id"), links


def pairs_of(members: DataFrame, links: DataFrame) -> DataFrame:
    """All pairs (part, id_lo, id_hi) of different ids: within a representative, and across each link."""
    a, b = members.select("part", "rep", F.col("id").alias("x")), members.select(F.col("rep").alias("rep_y"), F.col("id").alias("y"))
    within = a.join(b, F.col("rep") == F.col("rep_y"))
    across = links.join(a.drop("part"), F.col("lo") == F.col("rep")).join(b, F.col("hi") == F.col("rep_y"))
    both = within.select("part", "x", "y").where("x < y").unionByName(across.select("part", "x", "y").where("x <> y"))
    return both.select("part", F.least("x", "y").alias("id_lo"), F.greatest("x", "y").alias("id_hi")).distinct()


def classes_of(members: DataFrame, links: DataFrame) -> DataFrame:
    """One row per id (part, id, class_id, members, links): the class of its form by its least id, the ids in it, and the other classes it is similar to."""
    sizes = members.groupBy("part", "rep").agg(F.min("id").alias("class_id"), F.count_distinct("id").alias("members"))
    ends = links.select(F.explode(F.array("lo", "hi")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    per_class = sizes.join(ends, "rep", "left").fillna(0, ["links"])
    return members.distinct().join(per_class.drop("part"), "rep").select("part", "id", "class_id", "members", "links")
