"""The most similar earlier key of each key, exactly, without a row for a pair.

The keys that ask are dealt to groups and the known ones to parts, a task for each group and part; of a task's best matches the
best of all parts is kept. A set is held as bits that tell which places an odd number of its elements fall on; two sets differ in no
more bits than elements, so the bits of a pair bound its similarity from above. A few asking keys at a time are held against all
known of a class of sizes by these bits, and what is left is compared in the order of that bound, which ends where the bound falls
below the best found: none that could be the best or equal to it is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Known keys that a task holds at a time, and asking ones that it holds throughout.
BLOCK, ASKS = 1 << 15, 1 << 15
#: Known keys of a class of sizes at most, asking keys held against them at once, and pairs compared at once.
CLASS, TILE, PAIRS = 1 << 12, 1 << 6, 1 << 12
_ALWAYS = np.iinfo(np.int64).min
_EPS = 1e-9


def _jaccard_share(least: np.ndarray) -> np.ndarray:
    """What two sets of this Jaccard similarity differ by at most, as a share of both sizes."""
    return (1 - least) / (1 + least)


def _ratio_share(least: np.ndarray) -> np.ndarray:
    return 1 - least


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bits(n: int, full: np.ndarray, at: np.ndarray, h: np.ndarray, words: int) -> np.ndarray:
    """For each set the places of an odd number of its elements, in ``words`` words; a row for a word."""
    out = np.zeros((words, n), np.uint64)
    if len(full):
        bit, word = np.uint64(1) << (h & np.uint64(63)), (h >> np.uint64(6) & np.uint64(255)) % np.uint64(words)
        for w in range(words):
            out[w, full] = np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), at)
    return out


class Sets:
    """Sets of numbers of a block of keys: ``start`` and ``size`` of each in ``items``, and the bits of each, few (``near``) and 256 (``far``)."""

    def __init__(self, n: int, row: np.ndarray, items: np.ndarray, words: int):
        self.items, self.size = items, np.bincount(row, minlength=n)
        self.start = np.concatenate(([0], np.cumsum(self.size)[:-1])).astype(np.int64) if n else np.empty(0, np.int64)
        full = np.flatnonzero(self.size)
        h = _mix(items + np.uint64(0x9E3779B97F4A7C15))
        self.near = _bits(n, full, self.start[full], h >> np.uint64(40), words)
        self.far = np.ascontiguousarray(_bits(n, full, self.start[full], h, 4).T)

    def held(self, of: np.ndarray, known: Sets, group: np.ndarray, groups: int) -> np.ndarray:
        """How many elements of each of the sets ``of`` any known set of each group has."""
        if not hasattr(self, "numbers"):
            self.numbers, self.item = np.unique(self.items, return_inverse=True)
        at = np.minimum(np.searchsorted(self.numbers, known.items), len(self.numbers) - 1)
        ok = self.numbers[at] == known.items
        has = np.zeros((groups, len(self.numbers)), bool)
        has[np.repeat(group, known.size)[ok], at[ok]] = True
        full = np.flatnonzero(self.size)
        out = np.zeros((len(self.size), groups), np.int32)
        for g in range(groups):
            out[full, g] = np.add.reduceat(has[g][self.item], self.start[full], dtype=np.int32)
        return out[of]


def _first(x: np.ndarray) -> np.ndarray:
    """Where a sorted array's runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.empty(0, np.int64)


class Keys:
    """A block of keys, a million at most, with their code points, sets of bigrams and, if asked, of characters counted with repeats."""

    def __init__(self, keys: list[str], by_sequence: bool):
        n = len(keys)
        self.keys = keys
        self.cps = np.frombuffer("".join(keys).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        self.len = np.fromiter(map(len, keys), np.int64, n)
        self.start = np.cumsum(self.len) - self.len
        row = np.repeat(np.arange(n, dtype=np.uint64), self.len)
        pair = row[1:] == row[:-1]
        short = np.flatnonzero(self.len < 2)
        # A key of fewer than two characters is its own only bigram; no pair of characters has such a number.
        alone = np.uint64(1 << 42) + np.array([ord(keys[k]) + 1 if keys[k] else 0 for k in short.tolist()], np.uint64)
        grams = (row[1:] << np.uint64(43) | self.cps[:-1] << np.uint64(21) | self.cps[1:])[pair]
        x = np.sort(np.concatenate((grams, short.astype(np.uint64) << np.uint64(43) | alone)))
        x = x[_first(x)]
        self.grams = Sets(n, (x >> np.uint64(43)).astype(np.int64), x & np.uint64((1 << 43) - 1), 1)
        if by_sequence:
            x = np.sort(row << np.uint64(21) | self.cps)
            run = _first(x)
            nth = np.arange(len(x)) - np.repeat(run, np.diff(run, append=len(x)))
            self.chars = Sets(n, (x >> np.uint64(21)).astype(np.int64), (x & np.uint64((1 << 21) - 1)) << np.uint64(32) | nth.astype(np.uint64), 4)


class Places:
    """Where each character stands in each key of up to 63 characters, as bits."""

    def __init__(self, size: np.ndarray, cps: np.ndarray):
        row = np.repeat(np.arange(len(size), dtype=np.uint64), size)
        pos = (np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)).astype(np.uint64)
        held = np.repeat(size < 64, size)
        x = np.sort((row << np.uint64(27) | cps << np.uint64(6) | pos)[held])
        char = x >> np.uint64(6)
        first = _first(char)
        # The last is above all that is looked up.
        self.char = np.append(char[first], np.uint64((1 << 64) - 1))
        bits = np.uint64(1) << (x & np.uint64(63))
        self.bits = np.append(np.bitwise_or.reduceat(bits, first) if len(first) else bits, np.uint64(0))
        self.size = size

    def common(self, k: np.ndarray, cps: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of each of the keys ``k`` and the text beside it."""
        order = np.argsort(-size, kind="stable")
        k, start, size = k[order], start[order], size[order]
        n = int(size.max(initial=0))
        row = np.repeat(np.arange(len(size)), size)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        char = k.astype(np.uint64)[row] << np.uint64(21) | cps[start[row] + pos]
        at = np.searchsorted(self.char, char)
        masks = np.zeros((n, len(size)), np.uint64)
        masks[pos, row] = np.where(self.char[at] == char, self.bits[at], np.uint64(0))
        v = np.full(len(size), (1 << 64) - 1, np.uint64)
        for m, live in zip(masks, np.searchsorted(-size, -np.arange(n), "left").tolist()):
            w = v[:live]
            u = w & m[:live]
            v[:live] = (w + u) | (w - u)
        out = np.empty(len(size), np.int64)
        out[order] = np.bitwise_count(~v & ((np.uint64(1) << self.size[k].astype(np.uint64)) - np.uint64(1)))
        return out


def common_subsequence(a: str, cps: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``a``, of 63 characters at most, and each of the given texts."""
    own = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return Places(np.array([len(a)]), own).common(np.zeros(len(size), np.int64), cps, start, size)


class Search:
    """The best of the known for each asking key: its score, and the greatest record of those that have it."""

    def __init__(self, keys: list[str], ords: np.ndarray, least: float, by_sequence: bool):
        self.own, self.ords, self.by_sequence = Keys(keys, by_sequence), ords, by_sequence
        self.best = np.full(len(keys), least)
        self.found: list[tuple | None] = [None] * len(keys)
        if by_sequence:
            self.places = Places(self.own.len, self.own.cps)
        n = TILE * CLASS
        self.buffers = np.empty(n, np.uint64), np.empty(n, np.uint8), np.empty(n, np.uint8), np.empty(n + 8, bool)

    def meet(self, keys: list[str], ords: np.ndarray, records: list[tuple]) -> None:
        self.records, self.known = records, Keys(keys, self.by_sequence)
        self._scan(self.own.grams, self.known.grams, ords, _jaccard_share, self._by_bigrams)
        if self.by_sequence:
            self._scan(self.own.chars, self.known.chars, ords, _ratio_share, self._by_sequence)

    def _scan(self, own: Sets, known: Sets, ords: np.ndarray, share: Callable, compare: Callable) -> None:
        """Hand the pairs that may reach the best so far to ``compare``: asking keys by size, a tile at a time, against classes of known of about one size."""
        n = len(known.size)
        asks = np.flatnonzero(own.size)
        if not n or not len(asks):
            return
        asks = asks[np.lexsort((self.ords[asks], own.size[asks]))]
        width = min(CLASS, max(-(-n // 8), 256))
        place = np.empty(n, np.int64)
        place[np.argsort(known.size, kind="stable")] = np.arange(n)
        order = np.lexsort((ords, place // width))
        size, near, far, came = known.size[order], known.near[:, order], known.far[order], ords[order]
        cuts = np.arange(0, n, width)
        low, high = np.minimum.reduceat(size, cuts), np.maximum.reduceat(size, cuts)
        ends = np.stack([np.searchsorted(came[c : c + width], self.ords[asks], "left") for c in cuts.tolist()], axis=1)
        reach = own.held(asks, known, place // width, len(cuts))
        for t in range(0, len(asks), TILE):
            k = asks[t : t + TILE]
            s, part, end = own.size[k], share(self.best[k]), ends[t : t + TILE]
            most = part[:, None] * (s[:, None] + high) + _EPS
            apart = np.maximum(low - s[:, None], s[:, None] - high)
            # The least that a pair of this class has in common rises with the known one's size.
            may = (apart <= most) & ((1 - part[:, None]) * (s[:, None] + low) <= 2 * reach[t : t + TILE] + _EPS)
            end = np.where(may, end, 0)
            upto, most = end.max(axis=0), np.minimum(most, 255).astype(np.uint8)
            mine, pairs = own.near[:, k, None], []
            for c in np.flatnonzero(upto).tolist():
                rows = np.flatnonzero(end[:, c])
                i, j = self._near(mine[:, rows], near[:, c * width : c * width + upto[c]], most[rows, c, None])
                if len(i):
                    i = rows[i]
                    ok = j < end[i, c]
                    i, j = i[ok], j[ok] + c * width
                    both = s[i] + size[j]
                    differ = np.maximum(np.bitwise_count(far[j] ^ own.far[k[i]]).sum(axis=1, dtype=np.int64), np.abs(size[j] - s[i]))
                    ok = differ <= part[i] * both + _EPS
                    pairs.append((k[i[ok]], order[j[ok]], differ[ok], both[ok]))
            if pairs and sum(len(x[0]) for x in pairs):
                self._compared(*(np.concatenate(x) for x in zip(*pairs)), compare)

    def _near(self, mine: np.ndarray, near: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where bits differ in no more than ``most`` places."""
        a, b = mine.shape[1], near.shape[1]
        x, count, more, few = (y[: a * b].reshape(a, b) for y in self.buffers)
        np.bitwise_count(np.bitwise_xor(mine[0], near[0], out=x), out=count)
        for w in range(1, len(near)):
            np.bitwise_count(np.bitwise_xor(mine[w], near[w], out=x), out=more)
            np.add(count, more, out=count)
        np.less_equal(count, most, out=few)
        flat = self.buffers[3][: -(-a * b // 8) * 8]
        flat[a * b :] = False
        at = (np.flatnonzero(flat.view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
        return np.divmod(at[flat[at]], b)

    def _compared(self, k: np.ndarray, at: np.ndarray, differ: np.ndarray, both: np.ndarray, compare: Callable) -> None:
        """The pairs of each asking key by the bound on their similarity, more at a time the longer it goes on, as long as it is no less than the best."""
        bound = (both - differ) / (both + differ) if compare == self._by_bigrams else 1 - differ / both
        order = np.lexsort((-bound, k))
        k, at, bound, both = k[order], at[order], bound[order], both[order]
        first = _first(k)
        place = np.arange(len(k)) - np.repeat(first, np.diff(first, append=len(k)))
        upto, step = 64, 64
        while len(k):
            may, now = bound >= self.best[k] - _EPS, place < upto
            part = np.flatnonzero(may & now)
            for lo in range(0, len(part), PAIRS):
                x = part[lo : lo + PAIRS]
                compare(k[x], at[x], bound[x], both[x])
            left = may & ~now
            k, at, bound, both, place = k[left], at[left], bound[left], both[left], place[left]
            step *= 4
            upto += step

    def _take(self, k: int, at: np.ndarray, score: np.ndarray) -> None:
        top = score.max(initial=-1.0)
        if top < self.best[k]:
            return
        for i in at[score == top].tolist():
            r = self.records[i]
            if top > self.best[k] or self.found[k] is None or _after(r, self.found[k]):
                self.found[k] = r
            self.best[k] = top

    def _by_bigrams(self, k: np.ndarray, at: np.ndarray, bound: np.ndarray, both: np.ndarray) -> None:
        def items(sets: Sets, of: np.ndarray) -> np.ndarray:
            size = sets.size[of]
            row = np.repeat(np.arange(len(of)), size)
            return row.astype(np.uint64) << np.uint64(43) | sets.items[np.arange(len(row)) + np.repeat(sets.start[of] - np.cumsum(size) + size, size)]

        x = np.sort(np.concatenate((items(self.own.grams, k), items(self.known.grams, at))))
        shared = np.bincount((x[1:][x[1:] == x[:-1]] >> np.uint64(43)).astype(np.int64), minlength=len(k))
        score = shared / (both - shared)
        cuts = [*_first(k).tolist(), len(k)]
        for lo, hi in zip(cuts, cuts[1:]):
            self._take(int(k[lo]), at[lo:hi], score[lo:hi])

    def _by_sequence(self, k: np.ndarray, at: np.ndarray, bound: np.ndarray, both: np.ndarray) -> None:
        known, most = self.known, bound.copy()
        x = np.flatnonzero(self.own.len[k] < 64)
        # Matching blocks are a common subsequence.
        most[x] = 2 * self.places.common(k[x], known.cps, known.start[at[x]], known.len[at[x]]) / both[x]
        x = np.flatnonzero(most >= self.best[k] - _EPS)
        for i in x[np.lexsort((-most[x], k[x]))].tolist():
            if most[i] >= self.best[k[i]] - _EPS:
                score = SequenceMatcher(None, self.own.keys[k[i]], known.keys[at[i]]).ratio()
                self._take(int(k[i]), at[i : i + 1], np.array([score]))


def _after(a: tuple, b: tuple) -> bool:
    """Whether record a is greater, field by field, null least."""
    full = lambda r: tuple((False,) if x is None else (True, x) for x in r)
    return full(a) > full(b)


class _Records:
    """The rows of some columns, made when they are asked for."""

    def __init__(self, columns: list[pa.ChunkedArray]):
        self.columns = [c.combine_chunks() for c in columns]

    def __getitem__(self, i: int) -> tuple:
        return tuple(c[i].as_py() for c in self.columns)


def _searched(fields: list[str], least: float, by_sequence: bool, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, asks, search, held, n = None, [], None, [], 0

        def meet() -> None:
            nonlocal search, held, n
            if asks and search is None:
                t = pa.Table.from_batches(asks)
                search = Search(t.column("key").to_pylist(), t.column("ord").to_numpy(), least, by_sequence)
            if held and search is not None:
                t = pa.Table.from_batches(held)
                search.meet(t.column("key").to_pylist(), t.column("ord").fill_null(_ALWAYS).to_numpy(), _Records([t.column(f) for f in fields]))
            held, n = [], 0

        def result() -> Iterator[pa.RecordBatch]:
            meet()
            if search is not None:
                at = [k for k, r in enumerate(search.found) if r is not None]
                cols = [[search.own.keys[k] for k in at], [int(search.ords[k]) for k in at], [float(search.best[k]) for k in at], *([search.found[k][f] for k in at] for f in range(len(fields)))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            ids, kinds = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if ids[lo] != chunk:
                    yield from result()
                    chunk, asks, search = ids[lo], [], None
                part = batch.slice(lo, hi - lo)
                if kinds[lo] == 0:
                    asks.append(part)
                else:
                    held.append(part)
                    n += hi - lo
                    if n >= BLOCK:
                        meet()
        yield from result()

    return run


def nearest(asks: DataFrame, known: DataFrame, fields: list[str], least: float, by_sequence: bool) -> DataFrame:
    """(key, ord, score, *fields): for each of asks (key, ord BIGINT), distinct, the most similar of the known (key, ord, *fields) of a lesser ord, or of none.

    Similarity is the Jaccard similarity of bigrams or, ``by_sequence``, the greater of it and of the sequence ratio (the asking key first).
    Of known that are equally similar the one of the greatest fields counts. Asks without one of ``least`` or more are left out.
    """
    spark = asks.sparkSession
    n = asks.count()
    groups = max(-(-n // ASKS), 1)
    parts = max(min(-(-n // 256), -(-2 * spark.sparkContext.defaultParallelism // groups)), 1)
    fields_of = [known.schema[f] for f in fields]
    dealt = lambda n: F.pmod(F.xxhash64("key", "ord"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = asks.select("key", "ord", dealt(groups).alias("g"), each(parts).alias("p"), F.lit(0).alias("kind"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in fields_of)).unionByName(
        known.select("key", F.col("ord").cast("long").alias("ord"), each(groups).alias("g"), dealt(parts).alias("p"), F.lit(1).alias("kind"), *fields)
    )
    rows = rows.withColumn("chunk", F.col("g") * parts + F.col("p")).drop("g", "p")
    out = "key STRING, ord BIGINT, score DOUBLE, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields_of)
    schema = to_arrow_schema(StructType.fromDDL(out))
    found = rows.repartitionById(groups * parts, "chunk").sortWithinPartitions("chunk", "kind").mapInArrow(_searched(fields, least, by_sequence, schema), out)
    return found.groupBy("key", "ord").agg(F.max(F.struct("score", *fields)).alias("x")).select("key", "ord", "x.*")
