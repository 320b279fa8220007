"""New batches held against all accepted history, without working through that history again.

A prefix-tree hash forest. In each of TREES permutations of one hash a text has a signature: its smallest values in
ascending order, a byte of each, one after the other; so the texts that agree in their first values stand in one range of
the sorted signatures. A run keeps the sorted signatures of one delivery in every tree, as pages: a page is a sorted
array with its least and greatest signature, within one of the slots of its tree. A batch locates its entries in the
pages of earlier runs by binary search and looks at no posting outside the ranges it finds.

How long a prefix may be follows from the number of a text's pieces: the longest prefix that meets a text of similarity SIM
in at least one tree with probability RECALL (``depth_of``). A range of more than NEAR postings is not worked through at
first: the entries next to the asked one in the order, which have the longest prefixes in common with it, are looked at
and verified, and only what found no match there is asked again over the whole range. Postings that can't reach SIM, by their numbers
of pieces or their parities, are no candidates (a bound, nothing is lost); the rest is verified exactly.

``known_rows`` holds every batch of a table against the runs before it, in one pass: each slot meets its runs in their
order, asks with a run's pages and adds them, and makes one of more than MOST_RUNS. ``accept_batch`` does the same for one delivery against a
history that was kept: it signs the delivery's texts only, joins its pages with those of the runs kept, and adds a run. Slots of more than
CROWDED postings are kept in parts, each asked by all.

Defined cases: a first batch has no history and no match; null titles and null ids match nothing; rows without a batch see
only what came by time and are no history themselves; texts without pieces match texts of the same form only; repeated rows count once; an empty table gives
no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType

from ..session import durable, shared_dir
from .near_duplicates import form_of
from .sketches import SIM, Batch, jaccard, may_be_similar, mix, multipliers

TREES, PIECES = 25, 6
RECALL = 0.998
#: Postings of a range that are looked at first; entries of a slot from which it is kept in parts; postings of a page, and those for which a tree gets one slot more.
NEAR, CROWDED, PAGE, SLOT = 64, 4_000_000, 65_536, 16_384
#: Runs that stand side by side; one more, and they are made one.
MOST_RUNS = 8
_FIRST, _LAST = -(1 << 31), (1 << 31) - 1
PAGES = "run INT, ask BOOLEAN, keep BOOLEAN, tree TINYINT, slot INT, lo BIGINT, hi BIGINT, n INT, keys BINARY, reps BINARY, bits BINARY, sizes BINARY"
_NAMES = [c.split()[0] for c in PAGES.split(", ")]


def _recall(pieces: int, depth: int) -> float:
    """Least probability with which a text of so many pieces shares a prefix with a text that just reaches SIM, in one of the trees."""
    worst = 1.0
    for union in range(pieces, int(pieces / SIM) + 2):
        shared = int(np.ceil(SIM * union - 1e-9))
        if shared <= pieces:
            one = np.prod([max(0, shared - k) / (union - k) for k in range(min(depth, union))])
            worst = min(worst, 1 - (1 - one) ** TREES)
    return worst


def _depths(most: int = 256) -> np.ndarray:
    return np.array([1] + [max([d for d in range(1, PIECES + 1) if _recall(m, d) >= RECALL], default=1) for m in range(1, most)])


DEPTHS = _depths()


def depth_of(sizes: np.ndarray) -> np.ndarray:
    """Values in the prefix by which a text of so many pieces asks."""
    return DEPTHS[np.minimum(sizes, len(DEPTHS) - 1)]


class Page(NamedTuple):
    keys: np.ndarray
    reps: np.ndarray
    bits: np.ndarray
    sizes: np.ndarray

    def take(self, at: np.ndarray | slice) -> Page:
        return Page(*(x[at] for x in self))

    @staticmethod
    def one(pages: list[Page]) -> Page:
        """The postings of all pages, in order."""
        if len(pages) == 1:
            return pages[0]
        all_ = Page(*(np.concatenate(x) for x in zip(*pages)))
        return all_.take(np.argsort(all_.keys, kind="stable"))

    @staticmethod
    def read(row: dict) -> Page:
        return Page(*(np.frombuffer(row[c], t) for c, t in zip(("keys", "reps", "bits", "sizes"), ("<u8", "<i8", "<u8", "<i4"))))

    def row(self, run: int, ask: bool, keep: bool, tree: int, slot: int) -> tuple:
        return run, ask, keep, tree, slot, int(self.keys[0]), int(self.keys[-1]), len(self.keys), self.keys.astype("<u8").tobytes(), self.reps.astype("<i8").tobytes(), self.bits.astype("<u8").tobytes(), self.sizes.astype("<i4").tobytes()


_TYPES = [pa.int32(), pa.bool_(), pa.bool_(), pa.int8(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]


def _batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _TYPES)], _NAMES)


def _sign(slots: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Entries (rep, form, run, ask, keep) to pages; slots is a power of two, 256 at most."""
    shift = np.uint64(8 * PIECES - (slots.bit_length() - 1))

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = Batch(batch.column("form").to_pylist())
            if not len(b.rows):
                continue
            rep, run = (batch.column(c).to_numpy()[b.rows] for c in ("rep", "run"))
            ask, keep = (batch.column(c).to_numpy(zero_copy_only=False)[b.rows] for c in ("ask", "keep"))
            bits, sizes = b.parity(), b.sizes.astype(np.int32)
            for tree, m in enumerate(multipliers(TREES, 900)):
                byte = mix(b.view(m, PIECES)) >> np.uint64(56)
                key = reduce(lambda x, k: x << np.uint64(8) | byte[:, k], range(PIECES), np.zeros(len(rep), np.uint64))
                order = np.lexsort((key, keep, ask, run))
                key = key[order]
                slot = (key >> shift).astype(np.int64)
                page = Page(key, rep[order], bits[order], sizes[order])
                kind = np.stack((run[order], ask[order], keep[order], slot), axis=1)
                cut = np.concatenate(([0], np.flatnonzero((kind[1:] != kind[:-1]).any(axis=1)) + 1, [len(key)]))
                rows = []
                for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    rows.append(page.take(slice(i, j)).row(int(kind[i, 0]), bool(kind[i, 1]), bool(kind[i, 2]), tree, int(kind[i, 3])))
                yield _batch_of(rows)

    return f


def slots_for(n: int) -> int:
    """Slots of a tree of n entries."""
    return min(256, 1 << max(0, (n // SLOT).bit_length()))


def probe(q: Page, h: Page, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rep, with) of q's entries and the postings of h in their ranges that may be similar; and the reps whose range is not worked through."""
    shift = (8 * (PIECES - depth_of(q.sizes))).astype(np.uint64)
    low = q.keys >> shift << shift
    a, b = np.searchsorted(h.keys, low, "left"), np.searchsorted(h.keys, low | ((np.uint64(1) << shift) - np.uint64(1)), "right")
    more = np.empty(0, np.int64)
    if not whole:
        wide = np.flatnonzero(b - a > NEAR)
        if len(wide):
            more = q.reps[wide]
            here = np.searchsorted(h.keys, q.keys[wide])
            first = np.clip(here - NEAR // 2, a[wide], b[wide] - NEAR)
            a[wide], b[wide] = first, first + NEAR
    out = []
    some = np.flatnonzero(b > a)
    # A block of entries at a time, of some million postings in all.
    ends = np.cumsum((b - a)[some])
    for block in np.split(some, np.searchsorted(ends, np.arange(1, ends[-1] // 2_000_000 + 1) * 2_000_000)) if len(some) else ():
        n = (b - a)[block]
        x = np.repeat(block, n)
        y = np.repeat(a[block], n) + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        ok = may_be_similar(q.bits[x], h.bits[y], q.sizes[x], h.sizes[y]) & (q.reps[x] != h.reps[y])
        out.append((q.reps[x[ok]], h.reps[y[ok]]))
    rep, with_ = (np.concatenate(z) for z in zip(*out)) if out else (np.empty(0, np.int64),) * 2
    return rep, with_, more


def _met(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows (rep, with); with is null where a range is not worked through."""
    rep, with_, more = (np.concatenate(z) for z in zip(*found))
    order = np.lexsort((with_, rep))
    rep, with_ = rep[order], with_[order]
    fresh = np.ones(len(rep), bool)
    fresh[1:] = (rep[1:] != rep[:-1]) | (with_[1:] != with_[:-1])
    rep, with_, more = rep[fresh], with_[fresh], np.unique(more)
    none = np.arange(len(rep) + len(more)) >= len(rep)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate((rep, more))), pa.array(np.concatenate((with_, more)), mask=none)], ["rep", "with"])


def _in_order(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pages in the order of (tree, slot, part, run): each run asks the runs before it, then joins them."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = run = None
        runs: list[Page] = []
        new: list[Page] = []
        found = []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["tree"], row["slot"], row["part"]) != where:
                    where, run, runs, new = (row["tree"], row["slot"], row["part"]), row["run"], [], []
                if row["run"] != run:
                    if new:
                        runs.append(Page.one(new))
                    run, new = row["run"], []
                    if len(runs) > MOST_RUNS:
                        runs = [Page.one(runs)]
                page = Page.read(row)
                if row["ask"]:
                    found += [probe(page, h, whole) for h in runs]
                if row["keep"]:
                    new.append(page)
                if len(found) > 1000:
                    yield _met(found)
                    found = []
        if found:
            yield _met(found)

    return f


def _side_by_side(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of an asking page (q_...) and a page of the history."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [probe(Page.read({c: row[f"q_{c}"] for c in Page._fields}), Page.read(row), whole) for row in batch.to_pylist()]
            if found:
                yield _met(found)

    return f


def in_order(pages: DataFrame, whole: bool) -> DataFrame:
    """(rep, with) of the entries that ask and the entries of earlier runs that are kept."""
    crowded = durable(pages.where("keep").groupBy("tree", "slot").agg(F.ceil(F.sum(F.col("n").cast("long")) / CROWDED).cast("int").alias("parts")).where("parts > 1"), "crowded")
    if crowded.isEmpty():
        parted = pages.withColumn("part", F.lit(0))
    else:
        many = pages.join(crowded, ["tree", "slot"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        own = F.pmod(F.xxhash64("run", "lo", "hi", "n"), F.col("parts")).cast("int")
        parted = many.select("*", F.explode(F.when(F.col("ask"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))).alias("part"), own.alias("own"))
        parted = parted.withColumn("keep", F.col("keep") & (F.col("part") == F.col("own"))).drop("own", "parts")
    return parted.repartition("tree", "slot", "part").sortWithinPartitions("tree", "slot", "part", "run").mapInArrow(_in_order(whole), "rep BIGINT, with BIGINT")


def side_by_side(asked: DataFrame, held: DataFrame, whole: bool) -> DataFrame:
    """(rep, with) of asked pages and the pages held: only pages whose ranges touch come together; the history isn't moved where the asked pages are few."""
    q = asked.where("ask").select(*(F.col(c).alias(f"q_{c}") for c in ("tree", "slot", "lo", "hi", *Page._fields)))
    size = F.lit(256 ** (PIECES - 1))
    touch = (F.floor(F.col("q_lo") / size) <= F.floor(F.col("hi") / size)) & (F.floor(F.col("lo") / size) <= F.floor(F.col("q_hi") / size))
    both = held.where("keep").join(q, (F.col("tree") == F.col("q_tree")) & (F.col("slot") == F.col("q_slot")) & touch)
    return both.select(*Page._fields, *(f"q_{c}" for c in Page._fields)).mapInArrow(_side_by_side(whole), "rep BIGINT, with BIGINT")


@F.pandas_udf(BooleanType())
def exactly_similar(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(jaccard(a.to_numpy(), b.to_numpy()) >= SIM - 1e-12)


def verified(met: DataFrame, forms: DataFrame) -> DataFrame:
    """Of (rep, with): the distinct pairs of similarity SIM or more."""
    a, b = forms.select("rep", F.col("form").alias("a")), forms.select(F.col("rep").alias("with"), F.col("form").alias("b"))
    return met.where("with IS NOT NULL").distinct().join(a, "rep").join(b, "with").where(exactly_similar("a", "b")).select("rep", "with")


def search(find: Callable[[DataFrame | None, bool], DataFrame], forms: DataFrame, settled: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(rep, with): verified matches. find(entries to ask or None for all, over whole ranges or next to the entries first); settled: the reps that matches leave nothing to find for."""
    met = durable(find(None, False), "met")
    first = durable(verified(met, forms), "first")
    left = durable(met.where("with IS NULL").select("rep").distinct().join(settled(first), "rep", "left_anti"), "left")
    if left.isEmpty():
        return first
    return first.union(verified(find(left, True), forms))


def sign(entries: DataFrame, slots: int) -> DataFrame:
    """Pages of entries (rep, form, run, ask, keep)."""
    return entries.repartitionByRange("run", "rep").mapInArrow(_sign(slots), PAGES)


def before() -> Column:
    """Whether what came in batch b or at time s is earlier than the row."""
    return F.coalesce(F.col("b") < F.col("batch"), F.lit(False)) | F.coalesce(F.col("s") < F.col("at"), F.lit(False))


def _news(new: DataFrame) -> DataFrame:
    return durable(new.where("id IS NOT NULL").distinct().select("id", "batch", "at", form_of("title").alias("form")), "news")


def _olds(other: DataFrame) -> DataFrame:
    arrival = other.where("id IS NOT NULL").groupBy("id").agg(F.min("since").alias("since"))
    return durable(other.select("id", "title").distinct().join(arrival, "id").select("id", "since", form_of("title").alias("form")), "olds")


def _times(news: DataFrame, olds: DataFrame, key: str) -> DataFrame:
    """(key, b, s): the earliest batch and time of each form or id."""
    both = news.select(key, F.col("batch").alias("b"), F.lit(None).cast("timestamp_ntz").alias("s")).unionByName(olds.select(key, F.lit(None).cast("int").alias("b"), F.col("since").alias("s")))
    return _earliest(both.where(F.col(key).isNotNull()), key)


def _earliest(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min("b").alias("b"), F.min("s").alias("s"))


def _open(rows: DataFrame) -> DataFrame:
    """(rep, b0, s0) of rows (id, batch, at, rep, same) that no equal form answers: their earliest batch and time, which are the hardest to match."""
    return rows.where("NOT same AND rep IS NOT NULL").groupBy("rep").agg(F.min("batch").alias("b0"), F.min("at").alias("s0"))


def _answers(rows: DataFrame, ids: DataFrame, times: DataFrame, find: Callable[[Callable[[DataFrame], DataFrame]], DataFrame]) -> DataFrame:
    """The ids of rows that an earlier record matches: by its form, by its id (id, b, s), or by what find gives for their entries, whose times are (rep, b, s)."""
    by_id = rows.where("NOT same").join(ids, "id").where(before()).select("id")
    times = times.select(F.col("rep").alias("with"), "b", "s")

    def settled(matches: DataFrame) -> DataFrame:
        return matches.join(_open(rows), "rep").join(times, "with").where("b < b0 OR s < s0").select("rep").distinct()

    seen = find(settled).distinct().join(times, "with").groupBy("rep").agg(F.min("b").alias("b"), F.min("s").alias("s"))
    similar = rows.where("NOT same AND rep IS NOT NULL").join(seen, "rep").where(before()).select("id")
    return rows.where("same").select("id").union(by_id).union(similar).distinct()


def known_rows(new: DataFrame, other: DataFrame) -> DataFrame:
    """Ids of new (id, title, batch, at) that an earlier record matches: one of new with a smaller batch, or one of other (id, title, since) that arrived before ``at``.

    Each batch is a run and asks the runs before it. The entries of other are a run before all batches; their times decide afterwards.
    """
    news, olds = _news(new), _olds(other)
    forms = durable(_times(news, olds, "form").withColumn("rep", F.monotonically_increasing_id()), "forms")
    rows = news.join(forms, "form", "left").withColumn("same", before())
    rows = durable(rows.select("id", "batch", "at", "rep", "same"), "rows")
    asking = _open(rows).select("rep", F.coalesce("b0", F.lit(_LAST)).alias("run"), F.lit(True).alias("ask"))
    kept = forms.select("rep", "form", F.when(F.col("s").isNotNull(), _FIRST).otherwise(F.coalesce("b", F.lit(_LAST))).alias("kept"), (F.col("s").isNotNull() | F.col("b").isNotNull()).alias("keeps"))
    both = kept.join(asking, "rep", "left")
    one = F.col("run") == F.col("kept")
    as_asked = both.where(F.col("run").isNotNull()).select("rep", "form", "run", "ask", (one & F.col("keeps")).alias("keep"))
    as_kept = both.where(F.col("keeps") & ~F.coalesce(one, F.lit(False))).select("rep", "form", F.col("kept").alias("run"), F.lit(False).alias("ask"), F.lit(True).alias("keep"))
    entries_ = durable(as_asked.unionByName(as_kept), "entries")
    slots = slots_for(entries_.count())
    pages = durable(sign(entries_, slots), "pages")

    def find(asked: DataFrame | None, whole: bool) -> DataFrame:
        if asked is None:
            return in_order(pages, whole)
        again = sign(entries_.where("ask").join(asked, "rep", "left_semi").withColumn("keep", F.lit(False)), slots)
        return in_order(pages.where("keep").withColumn("ask", F.lit(False)).unionByName(again), whole)

    return _answers(rows, _times(news, olds, "id"), forms, lambda settled: search(find, forms, settled))


def entries(rows: DataFrame) -> DataFrame:
    """From (form, batch, since): one entry per form, with the earliest of either time. Kept in the shared folder."""
    own = rows.groupBy("form").agg(F.min("batch").alias("batch"), F.min("since").alias("since"))
    return durable(own.withColumn("rep", F.monotonically_increasing_id()).select("rep", "form", "batch", "since"), "entries")


def _kept(rows: DataFrame, kind: str) -> str:
    """Write rows to the shared folder; returns the path, which stays until ``forget``."""
    path = f"{shared_dir(rows.sparkSession)}/{kind}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return path


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete what was kept."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def add_run(held: DataFrame, slots: int = 1) -> str:
    """Persist the sorted signatures of entries (rep, form) as the pages of a run; returns the run's path."""
    return _kept(sign(held.select("rep", "form", F.lit(0).alias("run"), F.lit(False).alias("ask"), F.lit(True).alias("keep")), slots), "run")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    where, pages = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if pages and ((row["tree"], row["slot"]) != where or sum(len(p.keys) for p in pages) >= PAGE):
                yield _batch_of([Page.one(pages).row(0, False, True, *where)])
                pages = []
            where = row["tree"], row["slot"]
            pages.append(Page.read(row))
    if pages:
        yield _batch_of([Page.one(pages).row(0, False, True, *where)])


def merge_runs(spark: SparkSession, runs: list[str]) -> str:
    """One run of many: their pages merged into sorted pages of some PAGE postings."""
    rows = spark.read.parquet(*runs).repartition("tree", "slot").sortWithinPartitions("tree", "slot", "lo")
    return _kept(rows.mapInArrow(_merge, PAGES), "run")


@dataclass(frozen=True)
class History:
    """Paths of what has been accepted: runs, entries (rep, form), times (rep, b, s) and ids (id, b, s), one of each a delivery; and the slots of a tree.

    A history is a value: a delivery that fails leaves the one before it as it was.
    """

    runs: tuple[str, ...] = ()
    entries: tuple[str, ...] = ()
    times: tuple[str, ...] = ()
    ids: tuple[str, ...] = ()
    slots: int = 8


def _all(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    return spark.read.parquet(*paths)


def merged(spark: SparkSession, history: History) -> History:
    """The same history, one table of each kind. The tables merged stay, as an older value of the history may name them; ``forget`` deletes them."""
    if len(history.runs) < 2:
        return history
    one = [_kept(rows, kind) for rows, kind in ((_all(spark, history.entries), "entries"), (_earliest(_all(spark, history.times), "rep"), "times"), (_earliest(_all(spark, history.ids), "id"), "ids"))]
    return History((merge_runs(spark, list(history.runs)),), *((path,) for path in one), history.slots)


def accept_batch(history: History, new: DataFrame, other: DataFrame) -> tuple[DataFrame, History]:
    """One delivery, new (id, title, batch, at) and other (id, title, since), against the history and itself: the ids of new as known_rows has them, and the history with the delivery.

    Only the delivery's forms are signed. A form keeps the number of its first delivery; new ones are numbered after all
    that the history has, so numbers of different runs never mean different forms. Deliveries are accepted one after the other.
    """
    spark = new.sparkSession
    news, olds = _news(new), _olds(other)
    forms = _times(news, olds, "form")
    if history.runs:
        had = _all(spark, history.entries)
        after = (had.agg(F.max("rep")).first()[0] or 0) + 1
        forms = forms.join(had.join(forms.select("form"), "form", "left_semi").select("form", F.col("rep").alias("old")), "form", "left")
    else:
        after, forms = 0, forms.withColumn("old", F.lit(None).cast("long"))
    number = F.coalesce(F.col("old"), F.monotonically_increasing_id() + F.lit(after))
    forms = durable(forms.select("form", "b", "s", number.alias("rep"), F.col("old").isNull().alias("fresh")), "forms")
    grown = History(
        (*history.runs, add_run(forms.where("fresh"), history.slots)),
        (*history.entries, _kept(forms.where("fresh").select("rep", "form"), "entries")),
        (*history.times, _kept(forms.select("rep", "b", "s"), "times")),
        (*history.ids, _kept(_times(news, olds, "id"), "ids")),
        history.slots,
    )
    held, ids, times = _all(spark, grown.entries), _earliest(_all(spark, grown.ids), "id"), _earliest(_all(spark, grown.times), "rep")
    rows = news.join(forms.select("form", "rep"), "form", "left").join(times, "rep", "left").withColumn("same", before())
    rows = durable(rows.select("id", "batch", "at", "rep", "same"), "rows")
    asking = forms.join(_open(rows).select("rep"), "rep", "left_semi").select("rep", "form", F.lit(1).alias("run"), F.lit(True).alias("ask"), F.lit(False).alias("keep"))

    def find(asked: DataFrame | None, whole: bool) -> DataFrame:
        q = sign(asking if asked is None else asking.join(asked, "rep", "left_semi"), history.slots)
        return side_by_side(q, _all(spark, grown.runs), whole)

    known = durable(_answers(rows, ids, times, lambda settled: search(find, held, settled)), "known")
    return known, merged(spark, grown) if len(grown.runs) > MOST_RUNS else grown
