from __future__ import annotations

import io
import random
import re
import zipfile
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from siftloom.operators import records as R
from siftloom.operators.frontier import discovered
from siftloom.operators.matching import best_earlier, best_similar, similar_keys
from siftloom.operators.search import faceted
from siftloom.operators.state import due, stale, unchanged, upsert
from siftloom.sources.feeds import allowed_by_robots, feed_entries, paged_source, parsed_feeds, read_paged
from siftloom.sources.files import decoded, local_documents
from siftloom.sources.tables import changelog, commit_if, enriched, read_json, replace_table
from siftloom.streaming.increments import run_now, upsert_stream

T = [dt(2025, 1, d) for d in range(1, 10)]


def test_upsert_is_sticky_and_idempotent(spark):
    empty = spark.createDataFrame([], "k STRING, s STRING, first_seen TIMESTAMP_NTZ, last_seen TIMESTAMP_NTZ")
    rows = lambda *r: spark.createDataFrame(r, "k STRING, s STRING, o INT, t TIMESTAMP_NTZ")
    how = dict(key="k", order=["o"], payload=["s"], seen="t", sticky=("s", ("done",)))
    one = upsert(empty, rows(("a", "new", 1, T[0]), ("a", "done", 2, T[1]), ("b", "new", 1, T[0]), (None, "x", 1, T[0]), ("", "x", 1, T[0])), **how)
    new = rows(("a", "new", 3, T[4]), ("c", None, 1, T[4]))
    two = upsert(one, new, **how)
    want = {("a", "done", T[0], T[4]), ("b", "new", T[0], T[0]), ("c", None, T[4], T[4])}
    assert {tuple(r) for r in two.collect()} == want == {tuple(r) for r in upsert(two, new, **how).collect()}


def test_due_and_stale(spark):
    now = F.lit(dt(2025, 2, 1, 12))
    df = spark.createDataFrame([(0, None), (1, dt(2025, 1, 2, 12)), (2, dt(2025, 1, 2, 13)), (3, dt(2025, 2, 1, 13))], "i INT, t TIMESTAMP")
    assert [r[0] for r in df.orderBy("i").select(due(F.col("t"), now, 30)).collect()] == [True, True, False, False]
    assert [r[0] for r in df.orderBy("i").select(due(F.col("t"), now, 0)).collect()] == [True] * 4
    no = F.lit(False)
    assert [r[0] for r in df.orderBy("i").select(stale(F.lit(True), no, F.col("t"), no, now, refresh=0)).collect()] == [True, False, False, False]
    assert [r[0] for r in df.orderBy("i").select(stale(F.lit(True), no, F.col("t"), F.lit(True), now, refresh=0)).collect()] == [True, True, True, False]
    assert unchanged(df, df.where("i > 1"), ["i"]).count() == 2


def walk_staged(rows, taken, limit):
    seen, n, out = set(taken), 0, {}
    for i, k, fits in rows:
        if n >= limit or not fits:
            out[i] = "open"
        elif k in seen:
            out[i] = "duplicate"
        else:
            seen.add(k)
            n += 1
            out[i] = "staged"
    return out


def test_staged_as_the_walk(spark):
    rng = random.Random(3)
    for limit in (0, 5, 100):
        rows = [(i, rng.choice("abcdefghijklm"), rng.random() < 0.7) for i in range(80)]
        df = spark.createDataFrame(rows, "i LONG, title STRING, ok BOOLEAN")
        got = R.staged(df, F.col("title"), F.col("ok"), "i", spark.createDataFrame([("a",), ("b",)], "x STRING"), limit)
        assert {r["i"]: r["outcome"] for r in got.collect()} == walk_staged(rows, "ab", limit)


def test_running_count_over_ranges(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 3 == 0)
    assert all(r["n"] == r["id"] // 3 + 1 for r in R.running_count(df, "id", F.col("x"), "n").collect())


def test_merge_by_title(spark):
    rows = [(1, "Ab", "x", ["a", "b"]), (2, "a-B", "xyz", ["b", "c"]), (3, "AB", "abc", None), (4, "？", "z", ["q"]), (5, "solo", None, list("123456789"))]
    got = {r["key"]: r for r in R.merged_by_title(spark.createDataFrame(rows, "o LONG, t STRING, d STRING, tags ARRAY<STRING>"), "t", "o", ["d"], "tags", 2).collect()}
    assert set(got) == {"ab", "solo"} and (got["ab"]["t"], got["ab"]["d"], got["ab"]["tags"]) == ("Ab", "xyz", ["a", "b"]) and len(got["solo"]["tags"]) == 9


def test_merge_by_title_of_any_script(spark):
    titles = ["ＡＢ", "ＡＢ？", "ＣＤ", "é", "É!", "e", "かな", "かに", "Тест", "тест", "x²", "x", "a_b", "ab", "e\u0301", "？！", None]
    want = {}
    for t in titles:
        key = re.sub(r"\W+", "", t or "").lower()
        if key:
            want[key] = want.get(key, 0) + 1
    df = spark.createDataFrame([(i, t, "d", ["g"]) for i, t in enumerate(titles)], "o LONG, t STRING, d STRING, tags ARRAY<STRING>")
    assert {r["key"]: r["n"] for r in R.merged_by_title(df, "t", "o", ["d"], "tags").collect()} == want


def test_best_earlier_and_prefix_filter_as_brute_force(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 14))) for _ in range(25)]
    titles = [b[: rng.randint(0, len(b))] + rng.choice(["", "x", "yz"]) + b[rng.randint(0, len(b)) :] for b in rng.choices(base, k=90)]
    grams = lambda t: {t[i : i + 2] for i in range(len(t) - 1)} or {t}
    sim = lambda a, b: len(grams(a) & grams(b)) / len(grams(a) | grams(b))
    keys = sorted(set(titles))
    got = {(r["a"], r["b"]) for r in similar_keys(spark.createDataFrame([(k,) for k in keys], "key STRING")).collect()}
    assert got == {(a, b) for a in keys for b in keys if a != b and sim(a, b) >= 0.62}
    rows = [(f"i{k:03}", t, k) for k, t in enumerate(titles)]
    want = {}
    for i, t, o in rows:
        best = max(((sim(t, u), j) for j, u, p in rows if p < o), default=(0, ""))
        if best[0] >= 0.62:
            want[i] = best[1]
    assert {r["id"]: r["match_id"] for r in best_earlier(spark.createDataFrame(rows, "id STRING, t STRING, o LONG"), "id", "t", "o").collect()} == want


def test_frontier_as_the_walk(spark):
    rng = random.Random(4)
    links = [(s, p, f"u{rng.randint(0, 60)}") for s in range(12) for p in range(15)]
    known = {f"u{k}" for k in range(10)}
    taken, want = set(), []
    for s in range(12):
        n = 0
        for _, p, u in [x for x in links if x[0] == s]:
            if n < 4 and len(taken) < 30 and u not in known and u not in taken:
                taken.add(u)
                want.append((s, u))
                n += 1
    got = discovered(spark.createDataFrame(links, "seed LONG, pos LONG, url STRING"), spark.createDataFrame([(k,) for k in known], "url STRING"), 40, 4, 30)
    assert {(r["seed"], r["url"]) for r in got.collect()} == set(want)


def test_small_record_operators(spark):
    s = spark.createDataFrame([("s1", "u1", None), ("s2", None, "u1"), ("s3", "u3", None)], "id STRING, url STRING, import_key STRING")
    r = spark.createDataFrame([("a", "u1"), ("b", "u3"), ("c", "u9"), ("d", None)], "id STRING, at STRING")
    got = R.looked_up(r, "at", [(s, "import_key", "id"), (s, "url", "id")], "sid")
    assert {x["id"]: x["sid"] for x in got.collect()} == {"a": "s2", "b": "s3", "c": None, "d": None}
    q = spark.createDataFrame([("q", ["s3", None, "sx", "s1", "s3"]), ("e", None)], "qid STRING, ids ARRAY<STRING>")
    got = R.array_lookup(q, "qid", "ids", s.select(F.col("id").alias("sid"), F.col("id").alias("v")), "sid", "v", 5)
    assert {x["qid"]: x["found"] for x in got.collect()} == {"q": ["s3", "s1"], "e": []}
    v = R.violations(r, "r", "id", {"no at": F.col("at").isNull(), "u1": F.col("at") == "u1"})
    assert {tuple(x) for x in v.collect()} == {("r", "d", "no at"), ("r", "a", "u1")}
    assert [x["id"] for x in faceted(r, {"id": None}, " U3", ["at"]).collect()] == ["b"] and faceted(r, {"id": "a"}, "", ["at"]).count() == 1
    agg = spark.createDataFrame([("g", "", 1), ("g", "x", 2), ("g", "yy", 3), ("h", None, 1)], "g STRING, v STRING, o INT").groupBy("g").agg(R.first_non_empty("v", "o").alias("f"), R.longest("v", "o").alias("l"))
    assert {tuple(x) for x in agg.collect()} == {("g", "x", "yy"), ("h", None, None)}


def _docx(text):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:r><w:t>{text}</w:t></w:r></w:p><w:p/></w:document>')
    return b.getvalue()


def test_local_documents(spark, tmp_path):
    long = "面试题与答案" * 5
    files = {"a.txt": long.encode("gb18030"), "b.md": (long + "![x](y.png)").encode(), "c.html": f"<script>x</script><p>{long}</p>".encode(), "d.docx": _docx(long), "e.json": b'{"a": "%s"}' % long.encode(), "bad.docx": b"no zip", "short.txt": b"x", "index.md": long.encode(), "z.exe": b"x"}
    (tmp_path / "sub").mkdir()
    for k, v in files.items():
        (tmp_path / "sub" / k).write_bytes(v)
    got = {r["path"].rpartition("/")[2]: r for r in local_documents(spark, str(tmp_path)).collect()}
    assert set(got) == set(files) - {"index.md", "z.exe"}
    assert [got[k]["text"] for k in ("a.txt", "c.html", "d.docx")] == [long] * 3 and "png" not in got["b.md"]["text"] and got["e.json"]["text"].startswith("{\n")
    assert got["bad.docx"]["error"].startswith("BadZipFile") and got["short.txt"]["error"] == "too short"
    assert decoded(b"\xef\xbb\xbfx") == "x" and decoded(b"\xff\xff") == "��"


RSS = "<rss><channel><item><title>A &amp; <![CDATA[<b>b</b>]]></title><link>http://e/1</link><pubDate>x</pubDate></item><item><title>no link</title></item></channel></rss>"
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>t</title><link href="http://e/2"/><summary>s  s</summary></entry></feed>'


def test_feeds_robots_and_paging(spark):
    assert [(e["title"], e["url"]) for e in feed_entries(RSS.encode())] == [("A & b", "http://e/1")]
    rows = parsed_feeds(spark.createDataFrame([("r", bytearray(RSS, "utf8")), ("a", bytearray(ATOM, "utf8")), ("x", bytearray(b"<no"))], "feed STRING, document BINARY")).collect()
    assert {(r["feed"], r["url"], r["summary"]) for r in rows if r["error"] is None} == {("r", "http://e/1", ""), ("a", "http://e/2", "s s")} and sum(r["error"] is not None for r in rows) == 1
    pages = spark.createDataFrame([("http://e/private/1",), ("http://e/p",), ("http://f/private/1",)], "url STRING")
    robots = spark.createDataFrame([("http://e", "User-agent: *\nDisallow: /private")], "origin STRING, rules STRING")
    assert {r["url"] for r in allowed_by_robots(pages, robots).collect()} == {"http://e/p", "http://f/private/1"}
    total = {"a": 5, "b": 2}

    def fetch(query, size, page):
        return [(f"{query}{k}", "u", "s", None) for k in range(total[query])][(page - 1) * size : page * size]

    got = read_paged(spark, paged_source("paged_test", fetch, ["a", "b"], size=2, pages=2))
    assert {(r["query"], r["title"]) for r in got.collect()} == {("a", "a0"), ("a", "a1"), ("a", "a2"), ("a", "a3"), ("b", "b0"), ("b", "b1")}


def test_tables_and_stream(spark, tmp_path):
    assert read_json(spark, str(tmp_path / "none.json"), "a INT").count() == 0
    (tmp_path / "some.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert read_json(spark, str(tmp_path / "some.json"), "a INT").count() == 2
    out = str(tmp_path / "t")
    assert not commit_if(spark.range(0), [(spark.range(2), out)]) and commit_if(spark.range(1), [(spark.range(2), out)])
    replace_table(spark.range(3), out)
    assert spark.read.parquet(out).count() == 3
    log = changelog(changelog(spark.createDataFrame([], "ord INT, date STRING, title STRING, description STRING"), "d1", "a", ""), "d2", "b", "")
    assert [r["title"] for r in log.orderBy(F.desc("ord")).collect()] == ["b", "a"]
    assert enriched(spark.range(2), lambda it: (b.assign(y=b["id"] * 2) for b in it), "id LONG, y LONG").agg(F.sum("y")).first()[0] == 2
    land, state = tmp_path / "land", str(tmp_path / "state")
    rows = lambda *r: spark.createDataFrame(r, "k STRING, s STRING, o INT, t TIMESTAMP_NTZ")
    run = lambda: upsert_stream(spark, str(land), rows(("x", "x", 1, T[0])).schema, state, str(tmp_path / "cp"), "k", ["o"], ["s"], "t")
    rows(("a", "1", 1, T[0])).write.mode("append").parquet(str(land))
    run()
    rows(("a", "2", 2, T[1]), ("b", "1", 1, T[1])).write.mode("append").parquet(str(land))
    run()
    assert {(r["k"], r["s"], r["first_seen"]) for r in spark.read.parquet(state).collect()} == {("a", "2", T[0]), ("b", "1", T[1])}


def test_every_query_has_a_function_and_sql_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 40


def test_long_pages_and_texts_keep_their_tails(spark, tmp_path):
    from siftloom.plans.text_queries import QUERIES

    body = "\n".join(f"第 {k} 行 of a long page" for k in range(300))
    row = (1, "s.example", body)
    spark.createDataFrame([row], "doc_id LONG, site STRING, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    page, text = (QUERIES[q](spark, str(tmp_path)).first() for q in ("q_whole_page", "q_whole_text"))
    assert 2000 < len(body) < 7000 and text["lines"] == body
    assert page["excerpt"] == page["seen"] and " ".join(body.split()) in page["seen"] and page["seen"].endswith("no")


def test_frontier_query_takes_as_many_as_the_reference(spark, tmp_path):
    from siftloom.plans.record_queries import QUERIES

    pages = [(f"e{k:02}", [f"u{k:02}-{i}" for i in range(30)], dt(2025, 1, 1 + k)) for k in range(18)]
    spark.createDataFrame(pages, "id STRING, question_ids ARRAY<STRING>, added_at TIMESTAMP_NTZ").write.parquet(f"{tmp_path}/experiences.parquet")
    spark.createDataFrame([("u00-0", dt(2025, 1, 1))], "id STRING, deleted_at TIMESTAMP_NTZ").write.parquet(f"{tmp_path}/questions.parquet")
    got = {(r["seed"], r["pos"]) for r in QUERIES["q_frontier"](spark, str(tmp_path)).collect()}
    assert got == {(k, i) for k in range(15) for i in range(20)} - {(0, 0)} | {(0, 20)}


def test_places_in_a_total_order(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 5), k) for k in range(500)]
    df = spark.createDataFrame(rows, "a INT, id INT")
    got = {r["id"]: r["place"] for r in R.placed(df, F.col("a").desc(), F.col("id"), partitions=7).collect()}
    assert got == {k: n for n, (_, k) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1)}
    assert R.placed(df.limit(0), F.col("id")).count() == 0
    counted = {r["id"]: r["n"] for r in R.running_count(df, "a", F.col("id") % 2 == 0, "n", key="id").collect()}
    order = sorted(rows)
    assert counted == {k: sum(j % 2 == 0 for b, j in order[: n + 1]) for n, (_, k) in enumerate(order)}


def test_last_values_and_report(spark):
    df = spark.createDataFrame([("a", k, f"t{k}") for k in range(5)] + [("b", 0, "x")], "g STRING, k INT, t STRING")
    assert {r["g"]: r["values"] for r in R.last_values(df, "g", "t", F.col("k"), most=3).collect()} == {"a": ["t2", "t3", "t4"], "b": ["x"]}
    row = R.run_report(all=df.agg(F.count(F.lit(1)).alias("n")), none=df.limit(0).agg(F.count(F.lit(1)).alias("n"))).first()
    assert (row["all_n"], row["none_n"]) == (6, 0)


def test_best_similar_as_brute_force(spark):
    from difflib import SequenceMatcher

    rng = random.Random(8)
    bases = ["".join(rng.choice("如何在中断里喂看门狗并测量余量abc1") for _ in range(rng.choice((1, 4, 9, 15, 25)))) for _ in range(25)]

    def noisy():
        t = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(t) + 1)
            t[k : k + rng.randint(0, 2)] = rng.choice(["", "，", "甲", "乙B"])
        return "".join(t)

    rows = [(f"r{k:03}", noisy(), k // 2) for k in range(120)]
    known = [(f"q{k}", noisy()) for k in range(20)] + [("q9", "r001"), ("r0005", rows[0][1])]
    key = lambda t: "".join(c for c in t if c.isascii() and c.isalnum() or "一" <= c <= "鿿").lower()
    grams = lambda k: {k[i : i + 2] for i in range(len(k) - 1)} or {k}

    def like(a, b):
        x, y = key(a), key(b)
        return max(SequenceMatcher(None, x, y).ratio(), len(grams(x) & grams(y)) / len(grams(x) | grams(y)))

    want = {}
    for i, t, o in rows:
        best = max(((like(t, u), j, u) for j, u in known + [(j, u) for j, u, p in rows if p < o]), default=(0,))
        if best[0] >= 0.62:
            want[i] = (round(best[0], 9), best[1], best[2])
    got = best_similar(spark.createDataFrame(rows, "id STRING, title STRING, ord INT"), spark.createDataFrame(known, "id STRING, title STRING"))
    assert {r["id"]: (round(r["score"], 9), r["match_id"], r["match_title"]) for r in got.collect()} == want
    assert best_similar(spark.createDataFrame([], "id STRING, title STRING, ord INT"), spark.createDataFrame([], "id STRING, title STRING")).count() == 0


def test_streams_append_every_batch(spark, tmp_path):
    land = tmp_path / "land"
    spark.range(0, 5).coalesce(1).write.parquet(str(land))
    spark.range(5, 9).coalesce(1).write.mode("append").parquet(str(land))
    stream = spark.readStream.schema("id LONG").option("maxFilesPerTrigger", "1").parquet(str(land))
    assert sorted(r["id"] for r in run_now(stream, f"appended-{tmp_path.name}", "append").collect()) == list(range(9))


def _near_titles(rng, n):
    bases = ["".join(rng.choice("如何在中断里喂看门狗并测量余量abc1") for _ in range(rng.choice((0, 1, 2, 9, 25, 63, 64, 90, 210)))) for _ in range(12)]
    out = []
    for _ in range(n):
        t = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(t) + 1)
            t[k : k + rng.randint(0, 2)] = rng.choice(["", "甲", "乙b", "😀"])
        out.append("".join(t))
    return out


@pytest.mark.parametrize("by_sequence", [False, True])
def test_nearest_over_blocks_as_brute_force(by_sequence):
    from difflib import SequenceMatcher

    import numpy as np

    from siftloom.operators.nearest import Search

    rng = random.Random(21)
    keys, known = _near_titles(rng, 60), _near_titles(rng, 150)
    ords, known_ords = [rng.randrange(40) for _ in keys], [rng.randrange(40) for _ in known]
    records = [(rng.choice([None, "a", "b", "c"]), str(i)) for i in range(len(known))]
    grams = lambda k: {k[i : i + 2] for i in range(len(k) - 1)} or {k}

    def like(a, b):
        j = len(grams(a) & grams(b)) / len(grams(a) | grams(b))
        return max(j, SequenceMatcher(None, a, b).ratio()) if by_sequence else j

    s = Search(keys, np.array(ords), 0.62, by_sequence)
    for lo in range(0, len(known), 40):  # blocks: the best so far is kept from one to the next
        s.meet(known[lo : lo + 40], np.array(known_ords[lo : lo + 40]), records[lo : lo + 40])
    for k, (a, o) in enumerate(zip(keys, ords)):
        best = max(((like(a, b), (r[0] is not None, r[0] or ""), r[1]) for b, p, r in zip(known, known_ords, records) if p < o), default=(0,))
        assert (s.found[k] is not None) == (best[0] >= 0.62)
        if s.found[k]:
            assert (s.best[k], s.found[k][0] or "", s.found[k][1]) == (best[0], best[1][1], best[2])


def test_common_subsequence_as_by_rows():
    import numpy as np

    from siftloom.operators.nearest import common_subsequence

    rng = random.Random(3)
    texts = ["".join(rng.choice("abc甲") for _ in range(rng.randint(0, 90))) for _ in range(80)]
    cps = np.array([ord(c) for t in texts for c in t], np.uint64)
    size = np.array([len(t) for t in texts])

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
        return row[-1]

    for a in [t[:63] for t in texts[:25] if t]:
        assert common_subsequence(a, cps, np.cumsum(size) - size, size).tolist() == [lcs(a, t) for t in texts]


def test_titles_that_share_parts_make_no_pair_rows(spark):
    # Each title has its rarest bigrams in common with every other, and none is similar: 1 125 000 pairs when they met by bigram.
    rng = random.Random(5)
    rows = [(f"i{k}", "岗位甲乙丙丁" + "".join(chr(0x4E00 + rng.randrange(8000)) for _ in range(12)), k) for k in range(1500)] + [("last", "无关", 9000)]
    rows.append(("match", rows[7][1] + "终", 9001))
    got = best_earlier(spark.createDataFrame(rows, "id STRING, t STRING, o LONG"), "id", "t", "o")
    assert [(r["id"], r["match_id"]) for r in got.collect()] == [("match", "i7")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan or "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()


def test_sequence_ratio_query_as_brute_force(spark, tmp_path):
    from difflib import SequenceMatcher

    from siftloom.plans.record_queries import q_sequence_ratio

    rng = random.Random(12)
    key = lambda t: "".join(c for c in t if c.isascii() and c.isalnum() or "一" <= c <= "鿿").lower()
    grams = lambda k: {k[i : i + 2] for i in range(len(k) - 1)} or {k}
    sim = lambda a, b: len(grams(a) & grams(b)) / len(grams(a) | grams(b))
    rows = [(f"s{k:03}", t, dt(2026, 1, 1 + k % 25)) for k, t in enumerate(_near_titles(rng, 120))]
    spark.createDataFrame(rows, "id STRING, title STRING, added_at TIMESTAMP_NTZ").write.parquet(str(tmp_path / "sources.parquet"))
    want = {}
    for i, t, o in rows:
        best = max(((sim(key(t), key(u)), j, u) for j, u, p in rows if p < o), default=(0,))
        if best[0] >= 0.62:
            ratio = SequenceMatcher(None, key(t), key(best[2])).ratio()
            want[i] = (best[1], round(best[0], 6), round(ratio, 6))
    got = q_sequence_ratio(spark, str(tmp_path))
    assert {r["id"]: (r["match_id"], r["jaccard"], r["ratio"]) for r in got.collect()} == want


def test_best_similar_of_titles_with_common_characters(spark):
    # All titles have most characters in common with all others, in another order: a bound by characters alone leaves every pair.
    rng = random.Random(6)
    parts = ["岗位甲乙丙", "面试题整理", "看门狗余量", "中断里测量", "驱动研发组", "下午场终面"]
    orders = sorted({tuple(rng.sample(parts, 6)) for _ in range(400)})
    rows = [(f"r{k:03}", "".join(o), k) for k, o in enumerate(orders)]
    got = {r["id"]: r for r in best_similar(spark.createDataFrame(rows, "id STRING, title STRING, ord INT"), spark.createDataFrame([("q", "".join(orders[-1]) + "吗")], "id STRING, title STRING")).collect()}
    last = got[rows[-1][0]]
    assert (last["match_id"], last["match_title"]) == ("q", rows[-1][1] + "吗")
    assert last["score"] == 60 / 61


def test_known_without_enough_in_common_are_not_compared(monkeypatch):
    import numpy as np

    from siftloom.operators import nearest

    held = []
    near = nearest.Search._near
    monkeypatch.setattr(nearest.Search, "_near", lambda self, mine, known, most: held.append(mine.shape[1] * known.shape[1]) or near(self, mine, known, most))
    rng = random.Random(14)
    word = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    asks, known = [word("岗位面试题整理", 24) for _ in range(40)], [word("时钟总线中断寄存器", 24) + "岗位面" for _ in range(3000)]
    s = nearest.Search(asks, np.arange(40), 0.62, True)
    s.meet(known + [asks[3] + "终"], np.full(3001, -1), [(str(i),) for i in range(3001)])
    assert [k for k, r in enumerate(s.found) if r] == [3] and s.found[3] == ("3000",) and s.best[3] == 48 / 49
    # 40 x 3001 by bigrams and as many by characters, were each asking key held against each known.
    assert sum(held) < 40 * 3001


@pytest.mark.parametrize("by_sequence", [False, True])
def test_nearest_is_the_best_of_all_parts(spark, monkeypatch, by_sequence):
    from siftloom.operators import nearest

    monkeypatch.setattr(nearest, "ASKS", 300)
    rng = random.Random(15)
    keys = ["".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(20)) for _ in range(700)]
    asks = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key STRING, ord LONG")
    more = [(k + end, None if end != "丁" else i, r) for i, k in enumerate(keys) for end, r in (("甲", f"a{i}"), ("乙", f"b{i}"), ("丙丙丙", f"c{i}"), ("丁", f"d{i}"), ("戊", None))]
    got = nearest.nearest(asks, spark.createDataFrame(more, "key STRING, ord LONG, r STRING"), ["r"], 0.62, by_sequence)
    assert sorted(map(tuple, got.collect())) == sorted((k, i, 40 / 41 if by_sequence else 19 / 20, f"b{i}") for i, k in enumerate(keys))


def test_ratios_of_equal_pairs_are_worked_out_once(spark):
    from difflib import SequenceMatcher

    from siftloom.functions import text
    from siftloom.operators.matching import with_ratio

    rng = random.Random(16)
    titles = _near_titles(rng, 40) + ["a" * 199, "ab" * 150, "A,b" * 150, "", None]
    key = lambda t: "".join(c for c in t or "" if c.isascii() and c.isalnum() or "一" <= c <= "鿿").lower()
    grams = lambda k: {k[i : i + 2] for i in range(len(k) - 1)} or {k}
    rows = [(a, b) for a in titles for b in titles] * 2
    got = with_ratio(spark.createDataFrame(rows, "t STRING, u STRING"), "t", "u")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan, "bigrams row by row, with the key worked out for each"
    assert got.count() == len(rows)
    for r in got.distinct().collect():
        a, b = key(r["t"]), key(r["u"])
        want = len(grams(a) & grams(b)) / len(grams(a) | grams(b)), SequenceMatcher(None, a, b).ratio()
        assert (r["jaccard"], r["ratio"], r["similarity"]) == (*want, max(want))
    import pandas as pd

    calls = []
    whole = SequenceMatcher.ratio
    SequenceMatcher.ratio = lambda self: calls.append(1) or whole(self)
    try:
        out = text.likeness.func(pd.Series(["abcd", "abcd", "same", "ab" * 150]), pd.Series(["abce", "abce", "same", "ab" * 150]))
    finally:
        SequenceMatcher.ratio = whole
    assert len(calls) == 2 and out["ratio"].tolist()[:3] == [0.75, 0.75, 1.0] and out["jaccard"].tolist() == [0.5, 0.5, 1.0, 1.0]
