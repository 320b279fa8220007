"""Held-out items inside a corpus, by spaced-seed hashing.

Texts become streams of letters and digits, in one width and case; everything else falls out. A mask is a set of token
positions that count, the rest of its span is ignored, so a changed token between its positions doesn't hinder a hit. Items are
hashed under each mask at every position, documents at every STRIDE-th position; a run of RUN equal tokens holds at least
one probe of each mask. Around each hit the two streams are compared token by token: the exact run through it, and the
overlap that goes on over single substitutions.

The items' hashes are looked up inside the scan of the documents while there are at most ITEMS_BOUND hashes (the held-out
set is bounded and the bound is checked), so the corpus isn't shuffled at all. A larger set is joined by hash instead.

Defined cases: null texts and null ids take no part; items with fewer than RUN letters and digits can't be found; empty
tables give no rows; repeated rows count once; documents of any length are processed whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import durable
from .sketches import code_points, mix, multipliers
from .spans import blocks

RUN = 40
# Two masks of span 24; 1 is a position that counts.
MASKS = ("110110011011010011011011", "101101110010110111010111")
SPAN = 24
STRIDE = 4
ITEMS_BOUND = 2_000_000
_BITS = 22
_ODD, _DROP = 0x7FFFFFFF, 0


class Streams:
    """Texts to letters and digits: NFKC, lower case. Code points that become several are worked on text by text."""

    def __init__(self) -> None:
        self.known = np.zeros(0x110000, bool)
        self.to = np.zeros(0x110000, np.uint32)

    @staticmethod
    def plain(s: str) -> str:
        s = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", s).lower())
        return "".join(c for c in s if unicodedata.category(c)[0] in "LN")

    def learn(self, cps: np.ndarray) -> None:
        seen = np.zeros(0x110000, bool)
        seen[cps] = True
        for c in np.flatnonzero(seen & ~self.known):
            ch = chr(c)
            to = self.plain(ch)
            mark = unicodedata.category(ch)[0] == "M"
            self.to[c] = _ODD if mark or len(to) > 1 else ord(to) if to else _DROP
        self.known |= seen

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens one after the other, and the number of each text's tokens."""
        cps, lens = code_points(texts)
        self.learn(cps)
        out = self.to[cps]
        ends = np.cumsum(lens)
        odd = np.flatnonzero(out == _ODD)
        if len(odd):
            texts = list(texts)
            for k in np.unique(np.searchsorted(ends, odd, side="right")):
                texts[k] = self.plain(texts[k])
            cps, lens = code_points(texts)
            self.learn(cps)
            out = self.to[cps]
            ends = np.cumsum(lens)
        keep = out != _DROP
        kept = np.concatenate(([0], np.cumsum(keep)))
        return out[keep], kept[ends] - kept[ends - lens]


def seeds(tokens: np.ndarray, at: np.ndarray, mask: int) -> np.ndarray:
    """Hashes of the mask's positions from each place in ``at``."""
    on = np.flatnonzero(np.frombuffer(MASKS[mask].encode(), np.uint8) == ord("1"))
    h = np.full(len(at), mask + 1, np.uint64)
    for k, m in zip(on, multipliers(len(on), 4000 + mask)):
        h += tokens[at + k].astype(np.uint64) * m
    return mix(h)


def _places(lens: np.ndarray, stride: int) -> np.ndarray:
    """Positions of all streams from which a whole span fits, every stride-th of each."""
    starts = np.cumsum(lens) - lens
    n = np.maximum(0, (lens - SPAN) // stride + 1)
    return np.repeat(starts, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * stride


class Items:
    """The held-out items, their streams, and their hashes in order."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = np.asarray(ids, np.int64)
        self.tokens, lens = Streams().of(texts)
        self.ends = np.cumsum(lens)
        self.starts = self.ends - lens
        at = _places(lens, 1)
        keys = np.concatenate([seeds(self.tokens, at, m) for m in range(len(MASKS))])
        at = np.tile(at, len(MASKS))
        order = np.argsort(keys, kind="stable")
        self.keys, self.at = keys[order], at[order]
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self.keys >> np.uint64(64 - _BITS)] = True

    def overlap(self, tokens: np.ndarray, lo: int, hi: int, p: int, q: int) -> tuple[int, int]:
        """(exact run, overlap with single substitutions) around document place p and item place q of one hit."""
        k = int(np.searchsorted(self.ends, q, side="right"))
        s, e = int(self.starts[k]), int(self.ends[k])
        return overlap(tokens[lo:hi], self.tokens[s:e], p - lo, q - s)


def overlap(x: np.ndarray, y: np.ndarray, p: int, q: int) -> tuple[int, int]:
    """(exact run, overlap with single substitutions) of two streams on the diagonal through x[p] and y[q]."""
    back, on = min(p, q), min(len(x) - p, len(y) - q)
    if on <= 0:
        return 0, 0
    same = x[p - back : p + on] == y[q - back : q + on]
    # Runs of equal tokens; two runs belong together if one token stands between them.
    edge = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    a, b = edge[::2], edge[1::2]
    if not len(a):
        return 0, 0
    first = np.flatnonzero(np.concatenate(([True], a[1:] - b[:-1] > 1)))
    wide = np.maximum.reduceat(b, first) - np.minimum.reduceat(a, first)
    return int((b - a).max()), int(wide.max())


def _scan(ids: list[int], texts: list[str]) -> object:
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, streams = Items(ids, texts), Streams()
        for batch in batches:
            docs, bodies = batch.column("doc").to_numpy(), batch.column("text").to_pylist()
            for i, j in blocks(bodies):
                tokens, lens = streams.of(bodies[i:j])
                ends = np.cumsum(lens)
                at = _places(lens, STRIDE)
                ps, qs = [], []
                for m in range(len(MASKS)):
                    key = seeds(tokens, at, m)
                    some = np.flatnonzero(items.maybe[key >> np.uint64(64 - _BITS)])
                    left, right = np.searchsorted(items.keys, key[some], "left"), np.searchsorted(items.keys, key[some], "right")
                    n = right - left
                    ps.append(np.repeat(at[some], n))
                    qs.append(items.at[np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)])
                p, q = np.concatenate(ps), np.concatenate(qs)
                row, item = np.searchsorted(ends, p, side="right"), np.searchsorted(items.ends, q, side="right")
                # One comparison for each document, item and diagonal.
                once = np.unique(np.stack([row, item, p - q]), axis=1, return_index=True)[1] if len(p) else []
                best: dict[tuple[int, int], tuple[int, int]] = {}
                for k in once:
                    r = int(row[k])
                    got = items.overlap(tokens, int(ends[r] - lens[r]), int(ends[r]), int(p[k]), int(q[k]))
                    to = (int(docs[i + r]), int(items.ids[item[k]]))
                    best[to] = max(best.get(to, (0, 0)), got)
                if best:
                    (d, t), (x, w) = zip(*best), zip(*best.values())
                    yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(t, pa.int64()), pa.array(x, pa.int32()), pa.array(w, pa.int32())], ["doc", "item", "exact", "wide"])

    return f


def _hashed(batches: Iterator[pa.RecordBatch], stride: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, doc, pos): the hashes of each mask and where they stand in the text's stream."""
    streams = Streams()
    for batch in batches:
        ids, bodies = batch.column("doc").to_numpy(), batch.column("text").to_pylist()
        for i, j in blocks(bodies):
            tokens, lens = streams.of(bodies[i:j])
            at = _places(lens, stride)
            ends = np.cumsum(lens)
            row = np.searchsorted(ends, at, side="right")
            pos = at - (ends - lens)[row]
            for m in range(len(MASKS)):
                yield pa.RecordBatch.from_arrays([pa.array(seeds(tokens, at, m).view(np.int64)), pa.array(ids[i:j][row]), pa.array(pos)], ["key", "doc", "pos"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, text, item, other, places) to (doc, item, exact, wide): one comparison for each diagonal with a hit; each text's stream is made once a batch."""
    streams = Streams()
    for batch in batches:
        if not batch.num_rows:
            continue
        docs, texts, items, others, places = (batch.column(c).to_pylist() for c in ("doc", "text", "item", "other", "places"))
        own = sorted({*texts, *others})
        tokens, lens = streams.of(own)
        ends = np.cumsum(lens)
        stream = {t: tokens[e - n : e] for t, e, n in zip(own, ends.tolist(), lens.tolist())}
        best = []
        for text, other, hits in zip(texts, others, places):
            got = [overlap(stream[text], stream[other], h["p"], h["q"]) for h in hits]
            best.append((max(g[0] for g in got), max(g[1] for g in got)))
        exact, wide = zip(*best)
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(items, pa.int64()), pa.array(exact, pa.int32()), pa.array(wide, pa.int32())], ["doc", "item", "exact", "wide"])


def leaks(docs: DataFrame, items: DataFrame, run: int = RUN, bound: int = ITEMS_BOUND) -> DataFrame:
    """From docs (doc, text) and items (item, text): (doc, item, exact, wide), the longest exact run of letters and digits (run or more) and the longest overlap over single substitutions."""
    docs, items = docs.select("doc", "text").dropna(), items.select("item", "text").dropna().dropDuplicates(["item", "text"])
    made = "doc BIGINT, item BIGINT, exact INT, wide INT"
    if (items.agg(F.sum(F.length("text"))).first()[0] or 0) * len(MASKS) <= bound:
        rows = items.collect()  # within the bound just checked
        found = docs.mapInArrow(_scan([r["item"] for r in rows], [r["text"] for r in rows]), made) if rows else docs.sparkSession.createDataFrame([], made)
    else:
        made_of = "key BIGINT, doc BIGINT, pos BIGINT"
        a = items.select(F.col("item").alias("doc"), "text").mapInArrow(lambda b: _hashed(b, 1), made_of).select("key", F.col("doc").alias("item"), F.col("pos").alias("q"))
        b = docs.mapInArrow(lambda b: _hashed(b, STRIDE), made_of).select("key", "doc", F.col("pos").alias("p"))
        # One place for each document, item and diagonal, then one row for each document and item.
        met = a.join(b, "key").groupBy("doc", "item", (F.col("p") - F.col("q")).alias("diagonal")).agg(F.min(F.struct("p", "q")).alias("at"))
        met = durable(met.groupBy("doc", "item").agg(F.collect_list("at").alias("places")), "met")
        found = met.join(docs, "doc").join(items.withColumnRenamed("text", "other"), "item").mapInArrow(_compare, made)
    return found.where(F.col("exact") >= run).groupBy("doc", "item").agg(F.max("exact").alias("exact"), F.max("wide").alias("wide"))
