"""Spans of at least LENGTH characters that stand word for word in more than one document.

Difference-cover anchors: COVER is a perfect difference set modulo PERIOD, so for any two positions some shift below
PERIOD brings both onto the cover. Windows of LENGTH - PERIOD + 1 characters are hashed at cover positions only (about an
eighth of all positions); two documents that share LENGTH characters share one such window, wherever the span stands in
either. Only anchors that occur more than once leave the first shuffle. They are paired and extended to both sides on
the texts, so every span reported is exact and maximal.

Anchors that a large part of all documents has are told beforehand from a sample, so none of them meets in one task.

Copies of a whole document are one class, found by a digest; the class's first document stands for it. An anchor in
more than HOT places (page furniture) is not paired: each of its places gives the hashes of the LENGTH-character windows
around it, and only those are paired, so furniture shorter than LENGTH makes no pairs at all. What is shared (``shared_chars``)
is told from windows alone, without pairs, so a passage that all documents have costs one row a window and document.

Defined cases: null texts and null ids take no part; texts shorter than LENGTH share nothing; repeated rows of one id
count once; a passage repeated inside one document only is no case; texts of any length are processed whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import durable
from .sketches import code_points, mix

LENGTH = 150
PERIOD, COVER = 73, (0, 1, 3, 7, 15, 31, 36, 54, 63)
HOT = 200
#: Code points worked on at once, but for a single longer text.
BLOCK = 1_000_000
#: Ids that are broadcast at most.
SMALL_IDS = 1_000_000
#: One document in so many tells which anchors are heavy: those found so often among them. This decides on which way an
#: anchor goes, never on the result.
SAMPLE, HEAVY = 64, 1_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Rolling:
    """Hashes of any substring of any text of a block."""

    def __init__(self, texts: list[str], seed: int = 1):
        cps, self.lens = code_points(texts)
        n = len(cps)
        self.starts = np.cumsum(self.lens) - self.lens
        up, down = np.full(n + 1, _BASE), np.full(n + 1, _BACK)
        up[0] = down[0] = 1
        self.back = np.cumprod(down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(cps.astype(np.uint64) + np.uint64(seed)) * np.cumprod(up)[:n], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.back[a] + (b - a).astype(np.uint64))


def blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about BLOCK code points."""
    at = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield at, k
            at, size = k, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def _anchors(length: int) -> object:
    w = length - PERIOD + 1
    on = np.zeros(PERIOD, bool)
    on[list(COVER)] = True

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, texts = batch.column("doc").to_numpy(), batch.column("text").to_pylist()
            for i, j in blocks(texts):
                r = Rolling(texts[i:j])
                row = np.repeat(np.arange(j - i), r.lens)
                pos = np.arange(len(row)) - r.starts[row]
                at = np.flatnonzero(on[pos % PERIOD] & (pos + w <= r.lens[row]))
                row, pos = row[at], pos[at]
                key = r.of(at, at + w)
                # Places of one document whose whole surroundings are the same say the same.
                first, end = np.maximum(at - (length - w), r.starts[row]), np.minimum(at + length, r.starts[row] + r.lens[row])
                keep = np.unique(mix(key + r.of(first, end) * np.uint64(3) + row.astype(np.uint64) * _BASE), return_index=True)[1]
                yield pa.RecordBatch.from_arrays([pa.array(key[keep].view(np.int64)), pa.array(docs[i:j][row[keep]]), pa.array(pos[keep].astype(np.int32))], ["key", "doc", "pos"])

    return f


_SECOND = 0x51ED270B
_WINDOW = "key BIGINT, more BIGINT, doc BIGINT, pos INT"


def _around(r: Rolling, places: list[int], length: int) -> np.ndarray:
    """Where windows of the full length begin that hold one of the anchors, wherever it stands in the text."""
    w = length - PERIOD + 1
    n = int(r.lens[0])
    every = np.arange(n - w + 1)
    h = r.of(every, every + w)
    at = np.flatnonzero(np.isin(h, h[np.asarray(places)]))
    # Each anchor opens the windows from length - w before it to itself.
    opened = np.zeros(n + 1, np.int64)
    np.add.at(opened, np.maximum(at - (length - w), 0), 1)
    np.add.at(opened, at + 1, -1)
    begin = np.flatnonzero(np.cumsum(opened)[:n] > 0)
    return begin[begin <= n - length]


def _windows(length: int) -> object:
    """Rows (doc, text, places) to (key, more, doc, pos): each window of the full length around an anchor's place, once, by two hashes."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, places in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), batch.column("places").to_pylist()):
                r = Rolling([text])
                at = _around(r, places, length)
                key, first = np.unique(r.of(at, at + length), return_index=True)
                at = at[first]
                more = Rolling([text], _SECOND).of(at, at + length)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(more.view(np.int64)), pa.array(np.full(len(key), doc)), pa.array(at.astype(np.int32))], ["key", "more", "doc", "pos"])

    return f


def _covered(length: int) -> object:
    """Rows (doc, text, keys) to (doc, covered): the characters within windows of these keys."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, out = batch.column("doc").to_pylist(), []
            for text, keys in zip(batch.column("text").to_pylist(), batch.column("keys").to_pylist()):
                r = Rolling([text])
                every = np.arange(len(text) - length + 1)
                at = every[np.isin(r.of(every, every + length).view(np.int64), np.asarray(keys, np.int64))]
                out.append(int(np.minimum(np.diff(at), length).sum()) + length if len(at) else 0)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(out, pa.int64())], ["doc", "covered"])

    return f


def _spans(length: int) -> object:
    def common(a: str, b: str, i: int, j: int, back: bool) -> int:
        """Equal characters from a[i], b[j] on, or before them."""
        most, n, step = (min(i, j) if back else min(len(a) - i, len(b) - j)), 0, 64
        while n < most and step:
            m = min(step, most - n)
            same = a[i - n - m : i - n] == b[j - n - m : j - n] if back else a[i + n : i + n + m] == b[j + n : j + n + m]
            if same:
                n, step = n + m, step * 2
            else:
                step = m // 2
        return n

    w = length - PERIOD + 1

    def repeats(t: str, i: int) -> bool:
        return t.find(t[i : i + w]) < i or t.find(t[i : i + w], i + 1) > 0

    def covered(a: str, b: str) -> list[tuple[int, int]]:
        """(start, length) of the runs of a's characters within windows that b has too."""
        x, y = Rolling([a]), Rolling([b])
        i, j = np.arange(len(a) - length + 1), np.arange(len(b) - length + 1)
        at = i[np.isin(x.of(i, i + length), y.of(j, j + length))]
        if not len(at):
            return []
        gap = np.flatnonzero(np.diff(at) > length)
        first, last = at[np.concatenate(([0], gap + 1))], at[np.concatenate((gap, [len(at) - 1]))]
        return list(zip(first.tolist(), (last - first + length).tolist()))

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lo, hi, a, b, places in zip(batch["lo"], batch["hi"], batch["text_lo"], batch["text_hi"], batch["places"]):
                ends: dict[int, int] = defaultdict(lambda: -1)
                for p in sorted((p["plo"], p["phi"]) for p in places):
                    i, j = int(p[0]), int(p[1])
                    if i < ends[j - i]:
                        continue
                    left, right = common(a, b, i, j, True), common(a, b, i, j, False)
                    ends[j - i] = i + right
                    if left + right >= length:
                        out.append((lo, hi, i - left, j - left, left + right))
                if out and out[-1][:2] == (lo, hi) and any(repeats(a, int(p["plo"])) or repeats(b, int(p["phi"])) for p in places):
                    # A text that repeats itself has anchors at some of its repeats only: what it shares goes by all windows.
                    out += [(lo, hi, i, -1, n) for i, n in covered(a, b)] + [(lo, hi, -1, j, n) for j, n in covered(b, a)]
            yield pd.DataFrame(out, columns=["lo", "hi", "at_lo", "at_hi", "len"])

    return f


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs of the ids (doc): the ids are broadcast behind a check of their number, shuffled beyond it."""
    ids = durable(ids.distinct(), "ids")
    return durable(docs.join(F.broadcast(ids) if ids.count() <= SMALL_IDS else ids, "doc", "left_semi"), "texts")


def copies(docs: DataFrame) -> DataFrame:
    """(doc, first): the documents whose text another has as well, with the smallest id of the class. Kept in the shared folder."""
    whole = docs.select("doc", F.unhex(F.sha2("text", 256)).alias("digest"))
    classes = whole.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first <> last")
    return durable(whole.join(classes, "digest").select("doc", "first"), "copies")


def _different(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The documents of different text, long enough to share anything, and copies (doc, first)."""
    docs = docs.where(F.col("doc").isNotNull() & (F.length("text") >= length)).select("doc", "text")
    same = copies(docs)
    extra = same.where("doc <> first").select("doc").distinct()
    return docs.join(F.broadcast(extra) if same.count() <= SMALL_IDS else extra, "doc", "left_anti"), same


def _anchors_met(docs: DataFrame, length: int) -> DataFrame:
    """(key, doc, pos, n) of the anchors that occur more than once, n times. Kept in the shared folder."""
    made = "key BIGINT, doc BIGINT, pos INT"
    anchors = docs.mapInArrow(_anchors(length), made)
    some = docs.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE)) == 0).mapInArrow(_anchors(length), made)
    heavy = durable(some.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HEAVY).select("key"), "heavy")
    n = F.count(F.lit(1)).over(Window.partitionBy("key")).alias("n")
    many = heavy.count()
    if not many:
        return durable(anchors.select("key", "doc", "pos", n).where("n > 1"), "anchors")
    heavy = F.broadcast(heavy) if many <= SMALL_IDS else heavy
    light = anchors.join(heavy, "key", "left_anti").select("key", "doc", "pos", n).where("n > 1")
    return durable(light.unionByName(anchors.join(heavy, "key", "left_semi").select("key", "doc", "pos", F.lit(HOT + 1).cast("long").alias("n"))), "anchors")


def _windows_of(docs: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(key, more, doc, pos) of the windows around places (doc, places)."""
    return _texts_of(docs, places.select("doc")).dropDuplicates(["doc"]).join(places, "doc").mapInArrow(_windows(length), _WINDOW)


def _pairs_met(cold: DataFrame) -> DataFrame:
    """(lo, hi, places) of the documents that anchors (key, doc, pos) bring together."""
    a, b = cold.alias("a"), cold.alias("b")
    return durable(
        a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.doc") < F.col("b.doc")))
        .groupBy(F.col("a.doc").alias("lo"), F.col("b.doc").alias("hi"))
        .agg(F.collect_set(F.struct(F.col("a.pos").alias("plo"), F.col("b.pos").alias("phi"))).alias("places")),
        "pairs",
    )


def _extended(docs: DataFrame, pairs: DataFrame, length: int) -> DataFrame:
    """The spans (lo, hi, at_lo, at_hi, len) of pairs (lo, hi, places), on the texts."""
    texts = _texts_of(docs, pairs.select(F.explode(F.array("lo", "hi")).alias("doc"))).dropDuplicates(["doc"])
    side = lambda s: texts.select(F.col("doc").alias(s), F.col("text").alias(f"text_{s}"))
    return pairs.join(side("lo"), "lo").join(side("hi"), "hi").mapInPandas(_spans(length), "lo BIGINT, hi BIGINT, at_lo INT, at_hi INT, len INT")


def _hot(anchors: DataFrame) -> DataFrame:
    return durable(anchors.where(F.col("n") > HOT).groupBy("doc").agg(F.collect_list("pos").alias("places")), "hot")


def shared_spans(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """From (doc BIGINT, text): the maximal spans (lo, hi, at_lo, at_hi, len) between documents of different text, and copies (doc, first).

    For a class of copies its first document has the spans. Texts that repeat themselves also give rows for one side alone
    (the other position is -1): the runs of characters that the other text has as well. A row for every pair is asked for here;
    ``sharing`` and ``shared_chars`` answer whether and how much without it.
    """
    docs, same = _different(docs, length)
    anchors = _anchors_met(docs, length)
    hot = _hot(anchors)
    cold = anchors.where(F.col("n") <= HOT).select("key", "doc", "pos")
    if not hot.isEmpty():
        cold = cold.unionByName(_windows_of(docs, hot, length).select("key", "doc", "pos"))
    return durable(_extended(docs, _pairs_met(cold), length), "spans"), same


def _hot_pairs(windows: DataFrame) -> DataFrame:
    """(lo, hi) of the documents that have a window in common. Windows that the same documents have are one, so a long passage of many documents gives each pair once."""
    sets = windows.groupBy("key", "more").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("doc")).alias("docs"), F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("n > 1")
    one = sets.groupBy("n", "docs", "lo", "hi").agg(F.min(F.struct("key", "more")).alias("x")).select("x.key", "x.more")
    own = durable(windows.join(one, ["key", "more"]).select("key", "more", "doc"), "windows")
    a, b = own.alias("a"), own.alias("b")
    return a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.more") == F.col("b.more")) & (F.col("a.doc") < F.col("b.doc"))).select(F.col("a.doc").alias("lo"), F.col("b.doc").alias("hi")).distinct()


def sharing(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_lo, doc_hi): every pair of documents with a span in common. Texts are held against each other for rare anchors only; passages that many documents have are told by two hashes of their windows."""
    docs, same = _different(docs, length)
    anchors = _anchors_met(docs, length)
    hot = _hot(anchors)
    found = _extended(docs, _pairs_met(anchors.where(F.col("n") <= HOT).select("key", "doc", "pos")), length).select("lo", "hi").distinct()
    if not hot.isEmpty():
        found = found.unionByName(_hot_pairs(durable(_windows_of(docs, hot, length), "around"))).distinct()
    return _with_copies(found, same)


def sharing_pairs(spans: DataFrame, same: DataFrame) -> DataFrame:
    """(doc_lo, doc_hi): every pair of documents with a span in common, copies expanded."""
    return _with_copies(spans.select("lo", "hi").distinct(), same)


def _with_copies(first: DataFrame, same: DataFrame) -> DataFrame:
    for side in ("lo", "hi"):
        own = same.distinct().select(F.col("first").alias(side), F.col("doc").alias(f"as_{side}"))
        first = first.join(own, side, "left").withColumn(side, F.coalesce(f"as_{side}", side)).drop(f"as_{side}")
    a, b = same.distinct().alias("a"), same.distinct().alias("b")
    within = a.join(b, (F.col("a.first") == F.col("b.first")) & (F.col("a.doc") < F.col("b.doc"))).select(F.col("a.doc").alias("lo"), F.col("b.doc").alias("hi"))
    both = first.unionByName(within)
    return both.select(F.least("lo", "hi").alias("doc_lo"), F.greatest("lo", "hi").alias("doc_hi")).distinct()


def shared_chars(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, chars, shared, fraction) of every document: how many of its characters stand in a span that another has too. No pairs are built.

    The windows around the anchors that occur more than once are told by two hashes; those of more than one document cover
    their characters.
    """
    different, same = _different(docs, length)
    anchors = _anchors_met(different, length)
    places = durable(anchors.groupBy("doc").agg(F.collect_list("pos").alias("places")), "places")
    windows = durable(_windows_of(different, places, length), "windows")
    shared = windows.groupBy("key", "more").agg(F.min("doc").alias("a"), F.max("doc").alias("z")).where("a <> z").select("key", "more")
    keys = windows.join(shared, ["key", "more"], "left_semi").groupBy("doc").agg(F.collect_list("key").alias("keys"))
    covered = keys.join(different.dropDuplicates(["doc"]), "doc").select("doc", "text", "keys").mapInArrow(_covered(length), "doc BIGINT, covered BIGINT")
    return _parts(docs, covered, same)


def shared_part(docs: DataFrame, spans: DataFrame, same: DataFrame) -> DataFrame:
    """(doc, chars, shared, fraction) of every document: how many of its characters stand in a span that another has too."""
    ends = F.col("at") + F.col("len")
    parts = spans.select(F.col("lo").alias("doc"), F.col("at_lo").alias("at"), "len").unionByName(spans.select(F.col("hi").alias("doc"), F.col("at_hi").alias("at"), "len")).where("at >= 0").distinct()
    before = Window.partitionBy("doc").orderBy("at", "len").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.coalesce(F.max(ends).over(before), F.lit(0)), F.col("at"))
    covered = parts.select("doc", F.greatest(ends - reached, F.lit(0)).alias("new")).groupBy("doc").agg(F.sum("new").alias("covered"))
    return _parts(docs, covered, same)


def _parts(docs: DataFrame, covered: DataFrame, same: DataFrame) -> DataFrame:
    sizes = docs.where("doc IS NOT NULL").groupBy("doc").agg(F.max(F.coalesce(F.length("text"), F.lit(0))).alias("chars"))
    whole = same.select("doc", F.lit(True).alias("copy")).distinct()
    shared = F.when(F.col("copy"), F.col("chars")).otherwise(F.coalesce("covered", F.lit(0))).cast("long").alias("shared")
    out = sizes.join(covered, "doc", "left").join(whole, "doc", "left").select("doc", F.col("chars").cast("long").alias("chars"), shared)
    return out.withColumn("fraction", F.when(F.col("chars") > 0, F.col("shared") / F.col("chars")).otherwise(0.0))
