from __future__ import annotations

from datetime import datetime as dt

from siftloom.operators.references import dangling, dangling_report, parents, references

T1, T2, T3 = dt(2025, 1, 1), dt(2025, 2, 1), dt(2025, 3, 1)
CHILD = "id STRING, refs ARRAY<STRING>, added_at TIMESTAMP_NTZ, target STRING, reason INT"
PARENT = "id STRING, added_at TIMESTAMP_NTZ, deleted_at TIMESTAMP_NTZ, uses INT"


def found(spark, child, parent, **how):
    c, p = spark.createDataFrame(child, CHILD), spark.createDataFrame(parent, PARENT)
    refs, known = references(c, "c", "refs", "p"), parents(p, "p")
    got = dangling(refs, known, **how)
    return {(r.rec_id, r.ref_id, r.reason) for r in got.collect()}, {r.period: (r.n_refs, r.n_missing, r.n_deleted, r.n_late) for r in dangling_report(refs, got).collect()}


def test_reasons_and_precedence(spark):
    child = [("a", ["x", "y", None, "x", "gone", "late", ""], T2, "t", 1), ("a", ["x"], T1, "t", 1), ("b", None, T1, None, None), ("c", [], T1, None, None), (None, ["x"], T1, None, None)]
    parent = [("y", T1, None, 1), ("gone", T3, T2, 1), ("late", T2, None, 1), ("late", T3, None, 1), (None, T1, None, 1)]
    got, report = found(spark, child, parent)
    # The record's first delivery counts: it came before "late" did.
    assert got == {("a", "x", "missing"), ("a", "", "missing"), ("a", "gone", "deleted"), ("a", "late", "late")}
    assert report == {"2025-01": (5, 2, 1, 1)}


def test_late_is_strict_and_per_record(spark):
    got, _ = found(spark, [("a", ["k"], T1, "", 0), ("b", ["k"], T2, "", 0), ("c", ["k"], T3, "", 0)], [("k", T2, None, 0)])
    assert got == {("a", "k", "late")}


def test_empty_tables(spark):
    assert found(spark, [], [("k", T1, None, 0)]) == (set(), {})
    assert found(spark, [("a", ["k"], T1, "", 0)], [])[0] == {("a", "k", "missing")}


def test_hot_key_goes_by_broadcast_and_gives_the_same(spark):
    child = [(f"r{i}", ["hot" if i % 3 else f"k{i}"], T1, "", 0) for i in range(600)]
    parent = [("hot", T2, None, 0)]
    assert found(spark, child, parent, heavy=2)[0] == found(spark, child, parent, heavy=10**9)[0]
    assert len(found(spark, child, parent)[0]) == 600
