from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import siftloom.llm.spans as spans
from siftloom.llm.leakage import Streams, leaks
from siftloom.llm.mixing import fit, mix
from siftloom.llm.spans import COVER, PERIOD, _windows_of, shared_chars, shared_part, shared_spans, sharing, sharing_pairs

DOCS = "doc LONG, text STRING"


def _text(rng, n, alphabet="abcdefgh 一二三四五六七八，。\n"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_cover_brings_any_two_positions_together():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def _passages(seed):
    rng = random.Random(seed)
    docs = [_text(rng, rng.randint(0, 700)) for _ in range(24)]
    for n in (149, 150, 151, 200, 260):
        for _ in range(4):
            p = _text(rng, n)
            for k in rng.sample(range(24), 2):
                at = rng.randint(0, len(docs[k]))
                docs[k] = docs[k][:at] + p + docs[k][at:]
    furniture = _text(rng, 120)
    docs = [d + furniture for d in docs]
    docs += [docs[0], docs[0], docs[3], "x" * 5000, "y" + "x" * 400, "ab" * 300, "", "z" * 149, "z" * 149]
    return [(k + 1, d) for k, d in enumerate(docs)]


def brute_spans(docs, n=150):
    pieces = {k: {d[i : i + n] for i in range(len(d) - n + 1)} for k, d in docs}
    pairs = {(a, b) for a in pieces for b in pieces if a < b and pieces[a] & pieces[b]}
    shared = {}
    for k, d in docs:
        on = np.zeros(len(d), bool)
        for i in range(len(d) - n + 1):
            if any(d[i : i + n] in pieces[o] for o in pieces if o != k):
                on[i : i + n] = True
        shared[k] = int(on.sum())
    return pairs, shared


@pytest.mark.parametrize(("hot", "sample", "heavy"), [(2, 64, 1000), (200, 64, 1000), (200, 1, 3)])
def test_spans_as_brute_force(spark, monkeypatch, hot, sample, heavy):
    for name, value in (("HOT", hot), ("SAMPLE", sample), ("HEAVY", heavy)):
        monkeypatch.setattr(spans, name, value)
    docs = _passages(3)
    df = spark.createDataFrame(docs + [(1, docs[0][1]), (None, "q" * 500), (99, None)], DOCS).withColumn("lo", F.lit(1))
    found = shared_spans(df)
    pairs, shared = brute_spans(docs)
    assert {tuple(r) for r in sharing_pairs(*found).collect()} == pairs
    got = {r["doc"]: (r["shared"], r["chars"]) for r in shared_part(df, *found).collect()}
    want = {k: (shared[k], len(d)) for k, d in docs} | {99: (0, 0)}
    assert got == want
    assert {tuple(r) for r in sharing(df).collect()} == pairs
    assert {r["doc"]: (r["shared"], r["chars"]) for r in shared_chars(df).collect()} == want


def test_spans_of_nothing(spark):
    found = shared_spans(spark.createDataFrame([], DOCS))
    assert sharing_pairs(*found).count() == 0


def brute_leaks(docs, items, run=40):
    p = Streams.plain
    return {(d, i) for d, t in docs for i, u in items if t and u for s in [p(u)] for k in range(len(s) - run + 1) if s[k : k + run] in p(t)}


@pytest.mark.parametrize("bound", [0, 10**6])
def test_leaks_as_brute_force(spark, bound):
    rng = random.Random(4)
    items = [(k, _text(rng, rng.randint(20, 90), "abcdef123甲乙丙丁戊己 ，")) for k in range(12)] + [(90, ""), (91, None)]
    docs = []
    for k in range(40):
        t = _text(rng, rng.randint(0, 300))
        u = rng.choice(items[:12])[1]
        i = rng.randint(0, 10)
        part = u[i : i + rng.randint(30, 80)]
        noisy = "".join((c.upper() if rng.random() < 0.3 else chr(ord(c) + 0xFEE0) if "a" <= c <= "z" and rng.random() < 0.3 else c) + rng.choice(["", "", " ", "​", "，\n"]) for c in part)
        at = rng.randint(0, len(t))
        docs.append((k, t[:at] + noisy + t[at:]))
    docs += [(50, None), (51, ""), (52, "é" + docs[0][1])]
    got = leaks(spark.createDataFrame([*docs, docs[0]], DOCS), spark.createDataFrame(items, "item LONG, text STRING"), bound=bound)
    assert {(r["doc"], r["item"]) for r in got.collect()} == brute_leaks(docs, items)
    assert leaks(spark.createDataFrame([], DOCS), spark.createDataFrame(items, "item LONG, text STRING"), bound=bound).count() == 0
    assert leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], "item LONG, text STRING"), bound=bound).count() == 0


@pytest.mark.parametrize("bound", [0, 10**6])
def test_leaks_with_nulls_in_other_columns(spark, bound):
    u = "".join(chr(0x4E00 + k) for k in range(60))
    docs = spark.createDataFrame([(1, "，" + u, None)], DOCS + ", site STRING")
    items = spark.createDataFrame([(7, u, None)], "item LONG, text STRING, lang STRING")
    assert [(r["doc"], r["item"]) for r in leaks(docs, items, bound=bound).collect()] == [(1, 7)]


def test_leak_over_a_substitution(spark):
    u = "".join(chr(0x4E00 + k) for k in range(90))
    t = u[:45] + "x" + u[46:]
    r = leaks(spark.createDataFrame([(1, t)], DOCS), spark.createDataFrame([(7, u)], "item LONG, text STRING")).first()
    assert (r["exact"], r["wide"]) == (45, 90)


def test_fit_as_brute_force():
    rng = random.Random(6)
    for _ in range(200):
        w = sorted(rng.sample(range(1, 30), rng.randint(1, 5)))
        c = [rng.randint(0, 4) for _ in w]
        budget = rng.randint(0, 120)
        sums = {0}
        for x, n in zip(w, c):
            sums = {s + x * k for s in sums for k in range(n + 1)}
        used = fit(np.array(w), np.array(c), budget)
        assert all(0 <= u <= n for u, n in zip(used, c)) and int((used * np.array(w)).sum()) == max(s for s in sums if s <= budget)


def _tokens(text, tokenizer):
    return F.length(text)


def test_mix(spark, monkeypatch):
    monkeypatch.setattr("siftloom.llm.mixing.token_count", _tokens)
    rng = random.Random(8)
    docs = [(k, "x" * rng.randint(1, 200), s) for k, s in enumerate(["big"] * 900 + ["Mid_dle "] * 60 + ["tiny"] * 5)] + [(2000, "x", None), (2001, None, "big"), (None, "x", "big"), (2002, "", "big"), (2003, "xxx", "untargeted"), (0, "x" * 200, "big")]
    df = spark.createDataFrame(docs, "doc LONG, text STRING, source STRING").withColumn("tokens", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.6, 1), ("mid-dle", 0.3, 2), ("tiny", 0.05, 4), ("absent", 0.05, 4), (None, 0.1, 1)], "source STRING, target_share DOUBLE, max_repeats INT")
    size = {}
    for k, t, _ in docs:
        if k is not None and t:
            size[k] = min(size.get(k, len(t)), len(t))
    for how in ({"total": 20_000}, {"strict": True}, {}):
        chosen, report = mix(df, targets, **how)
        rows = {r["source"]: r for r in report.collect()}
        picked = chosen.collect()
        assert len({r["doc"] for r in picked}) == len(picked)
        for r in picked:
            assert r["tokens"] == size[r["doc"]] and 1 <= r["repeats"] <= {"big": 1, "mid-dle": 2, "tiny": 4}[r["source"]]
        for s, r in rows.items():
            assert r["used_tokens"] == sum(x["tokens"] * x["repeats"] for x in picked if x["source"] == s)
            most = r["available"] * {"big": 1, "mid-dle": 2, "tiny": 4, "absent": 4}[s]
            assert r["used_tokens"] == min(r["budget"], most)
        if how == {"strict": True}:
            assert all(abs(rows[s]["actual_share"] - rows[s]["target_share"] / 0.95) < 0.002 for s in ("big", "mid-dle", "tiny"))
    again = {tuple(r) for r in mix(df, targets, 20_000)[0].collect()}
    assert again == {tuple(r) for r in mix(df, targets, 20_000)[0].collect()} != {tuple(r) for r in mix(df, targets, 20_000, seed=1)[0].collect()}
    assert mix(df.limit(0), targets)[0].count() == 0 and mix(df, targets.limit(0))[0].count() == 0


@pytest.mark.parametrize("n", [400, 4000])
def test_mix_takes_lengths_as_the_source_has_them(spark, monkeypatch, n):
    monkeypatch.setattr("siftloom.llm.mixing.token_count", _tokens)
    rng = random.Random(n)
    size = {k: int(40 * 2 ** rng.uniform(0, 7)) for k in range(n)}
    df = spark.createDataFrame([(k, "x" * v, "s") for k, v in size.items()], "doc LONG, text STRING, source STRING")
    targets = spark.createDataFrame([("s", 1.0, 4)], "source STRING, target_share DOUBLE, max_repeats INT")
    total = sum(size.values()) // 2
    chosen, report = mix(df, targets, total=total)
    picked, ordered = {r["doc"] for r in chosen.collect()}, sorted(size, key=size.get)
    for q in range(4):
        part = ordered[q * n // 4 : (q + 1) * n // 4]
        assert 0.35 < sum(k in picked for k in part) / len(part) < 0.65
    assert report.first()["used_tokens"] == total


def test_mix_by_rounds(spark, monkeypatch):
    monkeypatch.setattr("siftloom.llm.mixing.token_count", _tokens)
    rng = random.Random(2)
    docs = [(k, "x" * rng.randint(40, 4000), "s") for k in range(300)]
    df = spark.createDataFrame(docs, "doc LONG, text STRING, source STRING")
    targets = spark.createDataFrame([("s", 1.0, 4)], "source STRING, target_share DOUBLE, max_repeats INT")
    total = sum(len(t) for _, t, _ in docs) * 5 // 2
    chosen, report = mix(df, targets, total=total)
    repeats = [r["repeats"] for r in chosen.collect()]
    assert len(repeats) == 300 and sum(r in (2, 3) for r in repeats) > 290 and report.first()["used_tokens"] == total


def test_mix_gives_what_its_report_counts(spark, monkeypatch, tmp_path):
    from siftloom.llm.corpus_queries import QUERIES

    monkeypatch.setattr("siftloom.llm.mixing.token_count", _tokens)
    rng = random.Random(5)
    docs = [(k, "x" * rng.randint(1, 200), s) for k, s in enumerate(["big"] * 200 + ["tiny"] * 3)]
    spark.createDataFrame(docs, "doc_id LONG, text STRING, source STRING").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("big", 0.5, 1), ("tiny", 0.5, 4)], "source STRING, target_share DOUBLE, max_repeats INT").write.parquet(f"{tmp_path}/mixtargets.parquet")
    used = {}
    for r in QUERIES["p8_mix"](spark, str(tmp_path)).collect():
        used[r["source"]] = used.get(r["source"], 0) + r["tokens"] * r["repeats"]
    report = {r["source"]: r for r in QUERIES["p8_shares"](spark, str(tmp_path)).collect()}
    assert used == {s: r["used_tokens"] for s, r in report.items()}
    assert used["tiny"] == 4 * report["tiny"]["available"] and used["big"] == report["big"]["budget"]


def test_fit_over_all_lengths():
    """More lengths than a short list would hold, and a budget that only one odd length among many even ones meets."""
    from siftloom.llm.mixing import RESTS, _plan

    lengths = [*range(2, 1201, 2), 1201]
    rng = random.Random(4)
    for budget in (64_701, *(rng.randrange(40_001, 120_001, 2) for _ in range(10))):
        order = rng.sample(lengths, len(lengths))
        gap = budget - np.cumsum(order)
        rows = pd.DataFrame({"source": "s", "tokens": order, "level": (gap[:, None] >= np.array(RESTS)).sum(axis=1), "n": 1, "budget": budget, "max_repeats": 1})
        got = _plan(rows)
        assert int((got["tokens"] * got["uses"]).sum()) == budget and got["uses"].max() == 1


def test_fit_keeps_few_states(monkeypatch):
    monkeypatch.setattr("siftloom.llm.mixing.STORED", 3)
    test_fit_as_brute_force()


def test_a_footer_of_all_documents(spark, monkeypatch):
    """A passage of 300 characters that every document has gives a row a window and document, and one window stands for all of it in the pairs."""
    monkeypatch.setattr(spans, "HOT", 5)
    rng = random.Random(3)
    letters = "天地玄黄宇宙洪荒日月盈昃辰宿列张"
    footer = "".join(rng.choice(letters) for _ in range(300))
    docs = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(50, 400))) + footer) for k in range(40)]
    df = spark.createDataFrame(docs, DOCS)
    got = {r["doc"]: r["shared"] for r in shared_chars(df).collect()}
    assert all(300 <= n < 306 for n in got.values()) and len(got) == 40
    assert sharing(df).count() == 40 * 39 // 2
    places = spans._hot(spans._anchors_met(spans._different(df, 150)[0], 150))
    windows = _windows_of(df, places, 150)
    assert windows.count() < 40 * 300
    one = spans._hot_pairs(windows)
    assert one.count() == 40 * 39 // 2


def test_repeats_are_covered_whole(spark):
    """A passage that one text has twice and another once is shared at both places."""
    rng = random.Random(6)
    letters = "天地玄黄宇宙洪荒日月盈昃辰宿列张"
    part = "".join(rng.choice(letters) for _ in range(200))
    a, b = part + "一" * 31 + part + "二", "三" * 7 + part
    docs = [(1, a), (2, b), (3, "四" * 1000)]
    want = brute_spans(docs)[1]
    assert {r["doc"]: r["shared"] for r in shared_chars(spark.createDataFrame(docs, DOCS)).collect()} == want
