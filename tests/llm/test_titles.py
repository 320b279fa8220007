from __future__ import annotations

import random
from datetime import datetime as dt, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

import siftloom.llm.history as history
import siftloom.llm.near_duplicates as near_duplicates_module
from siftloom.llm.chars import Table
from siftloom.llm.history import History, Page, accept_batch, add_run, depth_of, entries, known_rows, merge_runs, probe
from siftloom.llm.looks import look_alike_pairs, unify, unify_all, unify_one
from siftloom.llm.near_duplicates import classes_of, near_duplicates, overlaps, pairs_of, postings
from siftloom.llm.sketches import Batch, jaccard, letters_form, letters_forms, may_be_similar, similarity


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("ＡＢＣ１", "ABC1"), ("é", "é"), ("e‍́x", "éx"), ("a　 b ", " a b"), ("РТС", "PTC"), ("ΜΟ", "MO"), ("⻅⻓⻔⼊", "见长门入"), ("а‐b‑c", "a-b-c"),
        ("10 kΩ", "10 kΩ"), ("µs", "μs"), ("ї", "ï"), ("﻿x­", "x"), ("ﬁ", "fi"), ("Ⅳ", "IV"), ("？", "?"), ("ſ", "s"),
    ],
)
def test_looks_the_same(a, b):
    assert unify_one(a, fold=False) == unify_one(b, fold=False)


@pytest.mark.parametrize(("a", "b"), [("a", "A"), ("m²", "m2"), ("①", "1"), ("㎡", "m2"), ("a b", "ab"), ("a—b", "a-b"), ("【a】", "(a)"), ("。", "."), ("½", "1/2"), ("！", "？")])
def test_looks_different(a, b):
    assert unify_one(a, fold=False) != unify_one(b, fold=False)


def test_form_of_odd_values(spark):
    rows = [(None,), ("",), ("​ 　",), ("Straße",), ("x" * 100_000 + "Ａ",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t STRING").select(unify(F.col("t"))).collect()]
    assert got == [None, "", "", "strasse", "x" * 100_000 + "a"]


def test_look_alike_pairs(spark):
    rows = [("t", "1", "AB"), ("t", "1", "AB"), ("t", "2", "ＡB"), ("t", "3", "AB"), ("t", "4", None), ("t", None, "АB"), ("u", "5", "АB"), ("t", "6", "ab")]
    df = spark.createDataFrame(rows, "tbl STRING, id STRING, title STRING").withColumn("form", F.lit("clash"))
    assert {tuple(r) for r in look_alike_pairs(df).collect()} == {("t", "1", "2"), ("t", "2", "3")}
    assert look_alike_pairs(df.limit(0)).count() == 0


def _noisy(rng, base):
    s = list(base)
    for _ in range(rng.randint(0, 5)):
        k = rng.randrange(len(s))
        s[k : k + rng.randint(0, 1)] = rng.choice("甲乙丙丁戊己庚辛ABC ，")
    return "".join(s)


def _titles(seed, n, alphabet="天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余成岁律吕调阳云腾致雨露结为霜"):
    rng = random.Random(seed)
    bases = ["".join(rng.choice(alphabet) for _ in range(rng.choice((3, 6, 12, 20, 30, 45)))) for _ in range(n)]
    return [_noisy(rng, rng.choice(bases)) for _ in range(4 * n)]


def brute_pairs(rows):
    f = [(p, i, letters_form(t)) for p, i, t in rows if i is not None and t is not None]
    return {(p, min(i, j), max(i, j)) for p, i, a in f for q, j, b in f if p == q and i != j and (a == b or similarity(a, b) >= 0.7)}


def test_near_duplicates_as_brute_force(spark):
    rows = [(k % 2, f"i{k:04}", t) for k, t in enumerate(_titles(1, 60))]
    rows += [(0, "i0000", rows[0][2]), (0, None, "x"), (0, "n", None), (0, "e1", "，"), (0, "e2", ""), (0, "s1", "字"), (0, "s2", "字！")]
    df = spark.createDataFrame(rows, "part LONG, id STRING, title STRING")
    got = {tuple(r) for r in pairs_of(*near_duplicates(df)).collect()}
    assert got == brute_pairs(rows)


def test_near_duplicates_empty_and_copies(spark):
    df = spark.createDataFrame([], "part LONG, id STRING, title STRING")
    assert pairs_of(*near_duplicates(df)).count() == 0
    copies = spark.createDataFrame([(0, f"c{k}", "同一个标题同一个标题") for k in range(30)], "part LONG, id STRING, title STRING")
    members, links = near_duplicates(copies)
    assert members.select("rep").distinct().count() == 1 and links.count() == 0
    assert pairs_of(members, links).count() == 30 * 29 // 2


def brute_known(new, old):
    born = {}
    for i, _, at in old:
        born[i] = min(born.get(i, at), at)
    out = set()
    for i, t, b, at in new:
        f = letters_form(t) if t is not None else None
        like = lambda u: f is not None and u is not None and similarity(f, letters_form(u)) >= 0.7  # noqa: B023, E731
        if any(c < b and (j == i or like(u)) for j, u, c, _ in new) or any(born[j] < at and (j == i or like(u)) for j, u, _ in old):
            out.add(i)
    return out


@pytest.mark.parametrize(("near", "crowded"), [(2, 40), (64, 4_000_000)])
def test_known_rows_as_brute_force(spark, monkeypatch, near, crowded):
    monkeypatch.setattr(history, "NEAR", near)
    monkeypatch.setattr(history, "CROWDED", crowded)
    rng, day = random.Random(7), dt(2025, 1, 1)
    ts = _titles(3, 30)
    new = [(f"r{k % 110}", ts[k % 110], rng.randint(1, 6), day + timedelta(days=rng.randint(0, 60))) for k in range(120)] + [("rn", None, 3, day), ("rn", None, 4, day)]
    old = [(f"q{k % 8}", ts[110 + k % 8], day + timedelta(days=rng.randint(0, 60))) for k in range(10)]
    a = spark.createDataFrame(new, "id STRING, title STRING, batch INT, at TIMESTAMP_NTZ")
    b = spark.createDataFrame(old, "id STRING, title STRING, since TIMESTAMP_NTZ")
    assert {r[0] for r in known_rows(a, b).collect()} == brute_known(new, old)


def test_known_rows_without_history(spark):
    a = spark.createDataFrame([("r", "一个标题", 1, dt(2025, 1, 1))], "id STRING, title STRING, batch INT, at TIMESTAMP_NTZ")
    b = spark.createDataFrame([], "id STRING, title STRING, since TIMESTAMP_NTZ")
    assert known_rows(a, b).count() == 0 and known_rows(a.limit(0), b).count() == 0


def test_runs_merge_to_the_same_entries(spark):
    rows = spark.createDataFrame([(t, k % 3, None) for k, t in enumerate(_titles(5, 10))], "form STRING, batch INT, since TIMESTAMP_NTZ")
    held = entries(rows)
    one = add_run(held)
    parts = [add_run(held.where(F.col("rep") % 2 == k)) for k in (0, 1)]

    def postings(path):
        rows = spark.read.parquet(path).collect()
        assert all(p["lo"] == k[0] and p["hi"] == k[-1] and (k[1:] >= k[:-1]).all() for p in rows for k in [Page.read(p.asDict()).keys])
        return sorted((p["tree"], *x) for p in rows for x in zip(*(c.tolist() for c in Page.read(p.asDict()))))

    assert postings(merge_runs(spark, parts)) == postings(one)


@pytest.mark.parametrize("most", [1, 8])
def test_batches_one_by_one_as_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(history, "MOST_RUNS", most)
    monkeypatch.setattr(history, "NEAR", 5)
    rng, day = random.Random(11), dt(2025, 1, 1)
    ts = _titles(4, 12)
    # A near-copy of each text comes first in a later batch, as a run's first entries, where numbers of one run alone would be equal.
    new = [(f"r{k % 40}", ts[k % 40] + ("，甲" if k % 3 else ""), 1 + k * 4 // 60, day + timedelta(days=rng.randint(0, 60))) for k in range(60)]
    new += [("rn", None, 1, day), ("rn", None, 3, day), ("s1", "字", 1, day), ("s2", "字！", 4, day), ("r0", ts[5], 4, day), ("late", ts[44], 4, day + timedelta(days=50)), ("q2", "别的", 2, day + timedelta(days=61))]
    old = [(f"q{k}", ts[40 + k % 8], day + timedelta(days=rng.randint(0, 60))) for k in range(8)] + [("q9", ts[44], day + timedelta(days=2))]
    a = spark.createDataFrame(new, "id STRING, title STRING, batch INT, at TIMESTAMP_NTZ")
    b = spark.createDataFrame(old, "id STRING, title STRING, since TIMESTAMP_NTZ")
    now, got = History(), set()
    for n in range(1, 5):
        known, now = accept_batch(now, a.where(F.col("batch") == n), b if n == 1 else b.limit(0))
        got |= {r[0] for r in known.collect()}
        assert len(now.runs) <= most
    assert got == brute_known(new, old) == {r[0] for r in known_rows(a, b).collect()}
    held = spark.read.parquet(*now.entries)
    assert held.select("rep").distinct().count() == held.count() == held.select("form").distinct().count()


def test_forms_of_many_texts_as_of_each():
    rng = random.Random(9)
    odd = "éΣς𝛴각각́²①ΐﬁ㎏ 　\t\u200bİßАⅣ゙か"
    texts = ["".join(rng.choice(odd) if rng.random() < 0.5 else rng.choice("ab题目 ") for _ in range(rng.randint(0, 9))) for _ in range(3000)] + [c for c in map(chr, range(0x3000))]
    for fold in (False, True):
        assert unify_all(texts, fold) == [unify_one(t, fold) for t in texts]
    assert letters_forms(texts) == [letters_form(t) for t in texts]
    assert Table(str.lower).texts([]) == []


def test_similarity_by_arrays_as_by_sets():
    ts = [letters_form(t) for t in _titles(8, 40)] + ["", "字", "字字", "字字字", "aa", "aaa"]
    rng = random.Random(3)
    a, b = [rng.choice(ts) for _ in range(2000)], [rng.choice(ts) for _ in range(2000)]
    want = np.array([similarity(x, y) for x, y in zip(a, b)])
    assert np.allclose(jaccard(a, b), want)
    x, y = Batch(ts), {}
    size, bits = dict(zip(x.rows.tolist(), x.sizes.tolist())), dict(zip(x.rows.tolist(), x.parity()))
    for i in size:
        for j in size:
            y[i, j] = may_be_similar(bits[i], bits[j], np.int64(size[i]), np.int64(size[j])) or similarity(ts[i], ts[j]) < 0.7
    assert all(y.values())


@pytest.mark.parametrize("long", [3, 32])
def test_lists_meet_all_similar_texts(long):
    forms = sorted({letters_form(t) for t in _titles(12, 150)} - {""})
    text, key, tail, bits = postings(forms, np.zeros(len(forms), np.int64))
    o = np.lexsort((tail, key))
    got = set(zip(*(x.tolist() for x in overlaps(key[o], tail[o], text[o], bits[o], long))))
    want = {(i, j) for j, b in enumerate(forms) for i, a in enumerate(forms[:j]) if similarity(a, b) >= 0.7}
    assert len(want - got) <= (0 if long > 3 else 0.01 * len(want))


def test_heavy_lists_are_parted(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates_module, "SAMPLE", 1)
    monkeypatch.setattr(near_duplicates_module, "HEAVY", 5)
    rows = [(0, f"i{k:04}", t) for k, t in enumerate(_titles(2, 40))]
    got = {tuple(r) for r in pairs_of(*near_duplicates(spark.createDataFrame(rows, "part LONG, id STRING, title STRING"))).collect()}
    want = brute_pairs(rows)
    assert got <= want and len(got) >= 0.99 * len(want)


def test_long_lists_lose_no_pair():
    # All of a list meet that are not too large for each other.
    n = 80
    key, rep, bits = np.full(n, 7, np.int64), np.arange(n), np.zeros(n, np.uint64)
    want = {(i, j) for j in range(n) for i in range(j)}
    assert set(zip(*(x.tolist() for x in overlaps(key, np.full(n, 50, np.uint64), rep, bits, 32)))) == want
    rng = random.Random(4)
    size = np.sort(np.array([rng.randint(5, 90) for _ in range(n)]))
    want = {(i, j) for j in range(n) for i in range(j) if size[i] >= 0.7 * size[j] - 1e-9}
    assert set(zip(*(x.tolist() for x in overlaps(key, size.astype(np.uint64), rep, bits)))) == want


def test_titles_of_one_long_list_meet():
    # 120 titles share all but their last words: every list that two of them share is longer than 32.
    rng = random.Random(8)
    stem = "如何估算以太网从机模式的余量并解释硬件原因再给出验证办法"
    forms = sorted({stem + "".join(chr(0x4E00 + rng.randrange(6000)) for _ in range(4)) for _ in range(120)})
    text, key, tail, bits = postings(forms, np.zeros(len(forms), np.int64))
    o = np.lexsort((tail, key))
    got = set(zip(*(x.tolist() for x in overlaps(key[o], tail[o], text[o], bits[o]))))
    assert got >= {(i, j) for j, b in enumerate(forms) for i, a in enumerate(forms[:j]) if similarity(a, b) >= 0.7}


@pytest.mark.parametrize("split", [3, 40])
def test_heavy_lists_in_blocks_lose_no_pair(spark, monkeypatch, split):
    monkeypatch.setattr(near_duplicates_module, "SAMPLE", 1)
    monkeypatch.setattr(near_duplicates_module, "HEAVY", 5)
    monkeypatch.setattr(near_duplicates_module, "SPLIT", split)
    rows = [(0, f"i{k:04}", t) for k, t in enumerate(_titles(2, 40))]
    got = {tuple(r) for r in pairs_of(*near_duplicates(spark.createDataFrame(rows, "part LONG, id STRING, title STRING"))).collect()}
    assert got == brute_pairs(rows)


def test_classes(spark):
    long = "如何估算以太网从机模式的余量并解释硬件原因"
    rows = [(0, "a", long), (0, "b", long + "？"), (0, "c", long + "呢"), (0, "d", "别的"), (1, "a", long), (0, "a", long)]
    got = classes_of(*near_duplicates(spark.createDataFrame(rows, "part LONG, id STRING, title STRING")))
    assert sorted(map(tuple, got.collect())) == [(0, "a", "a", 2, 1), (0, "b", "a", 2, 1), (0, "c", "c", 1, 1), (0, "d", "d", 1, 0), (1, "a", "a", 1, 0)]


def test_only_ranges_asked_are_looked_at(monkeypatch):
    """A probe looks at no posting outside the prefix ranges of the entries that ask."""
    rng = np.random.default_rng(1)
    page = lambda n, first: Page(np.sort(rng.integers(0, 1 << 48, n, dtype=np.uint64)), np.arange(first, first + n), np.zeros(n, np.uint64), np.full(n, 47, np.int32))
    q, h = page(50, 0), page(5000, 1000)
    shift = np.uint64(8 * (6 - int(depth_of(np.array([47]))[0])))
    looked = []
    monkeypatch.setattr(history, "may_be_similar", lambda a, b, c, d: looked.append(len(a)) or np.ones(len(a), bool))
    h = Page(np.sort(np.concatenate((h.keys, q.keys[:5], q.keys[:5] + np.uint64(1)))), np.arange(1000, 6010), np.zeros(5010, np.uint64), np.full(5010, 47, np.int32))
    rep, with_, more = probe(q, h, False)
    assert sum(looked) == sum(int((h.keys >> shift == k >> shift).sum()) for k in q.keys) and len(more) == 0
    assert set(zip(rep, with_)) == {(i, j) for i, k in zip(q.reps, q.keys) for j, u in zip(h.reps, h.keys) if u >> shift == k >> shift}
