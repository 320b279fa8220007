from __future__ import annotations

import hashlib
import random
from urllib.parse import parse_qsl, urlencode, urlsplit

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from siftloom.functions import text as T, web as W
from siftloom.functions.scoring import Rules, assessed, keyword_hits, relevant_link
from siftloom.functions.structs import follow_ups, pitfalls, repaired_json, review_record
from siftloom.operators.chunking import chunks, halves


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {'STRING' if not isinstance(v, list) else 'ARRAY<STRING>'}" for k, v in (values or {"x": ""}).items())
    return spark.createDataFrame([tuple((values or {"x": ""}).values())], kinds).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("given_", "want"),
    [
        ("HTTPS://Ex.COM//a//b/?utm_source=x&b=1&a=#top", "https://ex.com/a/b?b=1&a="),
        (" https://u:p@Ex.com:80 ", "https://u:p@ex.com:80/"),
        ("https://e.com/a?FROM=z&q=a%20b~c*&&k", "https://e.com/a?q=a+b~c%2A&k="),
        ("local://import/7a.md", "local://import/7a.md"),
        ("https://e.com/", "https://e.com/"),
        ("https://e.com/x?q=面", "https://e.com/x?q=%E9%9D%A2"),
        (None, None),
    ],
)
def test_normal_url(spark, given_, want):
    assert one(spark, W.normal_url(F.col("u")), u=given_) == want


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("abz_%~* é面", min_size=1, max_size=4), st.text("abz~*+ é面", max_size=4)), max_size=4))
def test_query_encoding_is_that_of_the_standard_library(spark, pairs):
    url = "https://e.com/p?" + urlencode(pairs)
    want = urlencode([(k, v) for k, v in parse_qsl(urlsplit(url).query, keep_blank_values=True) if k.lower() not in W.TRACKING])
    assert one(spark, W.normal_url(F.col("u")), u=url) == "https://e.com/p" + (f"?{want}" if want else "")


def test_text_functions(spark):
    assert one(spark, T.without_tags(F.col("x"), 5), x=" a<b>　c \x1c d e f") == "a c d"
    assert one(spark, T.without_tags(F.col("x"), 5), x=None) == ""
    assert one(spark, T.match_key(F.col("x")), x="Ünï C++ 面经-１2") == "nc面经2"
    assert one(spark, T.stable_id(F.col("x"), "q"), x="面") == "q-" + hashlib.sha256("面".encode()).hexdigest()[:16]
    assert one(spark, T.bounded_lines(F.col("x"), 9), x=" a  b\r\n\n  \n c ") == "a b\nc"
    assert one(spark, T.canonical_label(F.col("x"), ["Linux 驱动", "C++"]), x=" linux驱动 ") == "Linux 驱动"
    assert one(spark, T.canonical_label(F.col("x"), ["Linux 驱动", "C++"]), x="C#") == "C++"
    assert one(spark, T.bigrams(F.col("x")), x="aaa") == ["aa"]
    assert one(spark, T.bigrams(F.col("x")), x="") == [""]
    assert one(spark, T.string_list(F.col("x"), 2, 3), x=[" ", "abcd", None, "b", "c"]) == ["abc", "b"]
    assert one(spark, T.with_tags(F.col("x"), F.lit("d"), F.lit("a"), F.lit("")), x=["a"]) == ["a", "d"]
    assert one(spark, T.numbered(F.col("x").cast("int")), x="123") == "123"
    assert one(spark, T.sequence_ratio(F.lit("tide"), F.lit("diet"))) == 0.25
    assert one(spark, T.sequence_ratio(F.lit("diet"), F.lit("tide"))) == 0.5


def test_images_and_outline_limit(spark):
    plain = one(spark, T.without_images(F.col("x")), x="Q ![a](b.png) <img src=x>\n[1]: http://h/a.png?x\n![a][1]  \nA")
    assert "png" not in plain and "img" not in plain and plain.startswith("Q") and plain.endswith("A")
    assert one(spark, T.outline_limit(F.col("x"), 60, 2), x="# t\n") == 4
    assert one(spark, T.outline_limit(F.col("x"), 60, 2), x="x" * 2000) == 60
    assert one(spark, T.outline_limit(F.col("x"), 60, 0), x="x") == 2


def test_links(spark):
    page = "<a href='/a'>one <b>two</b></a><a rel=\"nofollow\" href='/n'>n</a><a href='/t' title='T'> </a><a href='/old'>x<a href='/new'>y</a><a href='/open'>"
    assert [(r["href"], r["anchor"]) for r in one(spark, W.page_links(F.col("x")), x=page)] == [("/a", "one two"), ("/t", "T"), ("/new", "y")]
    safe = lambda href: one(spark, W.safe_link(F.lit("https://w.e.com/a/b"), F.col("x"), ("e.com",)), x=href)
    assert safe("/q/1?utm_source=a") == "https://w.e.com/q/1"
    assert safe("c") == "https://w.e.com/a/c"
    assert safe("../c") == "https://w.e.com/c"
    assert safe("//e.com/c") == "https://e.com/c"
    assert [safe(x) for x in ("/login", "/x/users/1", "https://evil-e.com/q", "#a", "", "mailto:a@e.com", "/a.PDF", "ftp://e.com/a")] == [None] * 8


def test_visible_text_and_dates(spark):
    assert one(spark, W.visible_text(F.col("x"), 99), x="<script>a</script>b&amp;<!-- c -->d<style>e</style>&lt;i&gt;f") == "b& d f"
    assert one(spark, W.feed_date(F.col("x")), x="Tue, 04 Mar 2025 01:00:00 +0800") == "2025-03-03T17:00:00+00:00"
    assert one(spark, W.feed_date(F.col("x")), x="spring 2025") == "spring 2025"
    assert one(spark, W.feed_date(F.col("x")), x=" ") is None
    assert one(spark, W.epoch_time(F.col("x")), x="x") is None
    assert one(spark, W.iso_time(F.col("x")), x="nonsense") is None


def test_scoring(spark):
    rules = Rules(boosts={"e.com": 15, "w.e.com": 3}, reference_domains=("docs.org",))
    a = one(spark, assessed(F.lit("Linux 驱动 面试题"), F.lit(None).cast("string"), F.lit("https://w.e.com/x"), rules))
    assert (a["score"], a["kind"]) == (15 + 24 + 8, "interview")  # 面试 stands within 面试题
    assert list(a["signals"]) == ["interview:面试题", "interview:面试", "scope:linux", "scope:驱动"]
    assert one(spark, assessed(F.lit("面试 FPGA linux"), F.lit(""), F.lit(""), rules))["kind"] == "excluded"
    assert one(spark, assessed(F.lit("documentation"), F.lit(""), F.lit("https://docs.org/"), rules))["score"] == -45
    assert list(one(spark, keyword_hits(F.lit("Microscope"), ["ros", "cope"]))) == ["ros", "cope"]
    relevant = lambda anchor, seed, forum: one(spark, relevant_link(F.lit(anchor), F.lit("https://e/"), F.lit(seed), F.lit(forum), rules))
    assert [relevant("面经", "linux", False), relevant("面经", "", False), relevant("spi", "", True), relevant("spi i2c", "", False), relevant("fpga spi i2c", "", True)] == [True, False, True, True, False]


def test_lists_of_texts_and_objects(spark):
    f = one(spark, follow_ups(F.col("x")), x='[" a  b ", {"question": "q", "answer_short": "s"}, {"title": "no answer"}, 3, ""]')
    assert [(r["is_legacy"], r["title"], r["answer_short"], r["answer_detail"]) for r in f] == [(True, "a b", None, None), (False, "q", "s", "s")]
    assert one(spark, follow_ups(F.col("x")), x="no json") == []
    assert one(spark, follow_ups(F.col("x")), x=None) == []
    p = one(spark, pitfalls(F.col("x")), x='[{"mistake": "m", "why_wrong": "w", "correct_approach": "c"}, {"title": "t"}, "old"]')
    assert [(r["title"], r["explanation"], r["correction"]) for r in p] == [("m", "w", "c"), ("old", None, None)]
    assert one(spark, F.to_json(repaired_json(F.col("x"))), x='say ```json\n{"a": [1,],}\n```') == '{"a":[1]}'
    r = '{"verdict": "Expanded", "summary": "s", "issues": ["", "a"]}'
    assert list(one(spark, review_record(F.col("x")), x=r)["issues"]) == ["a"]
    assert list(one(spark, review_record(F.col("x"), True, 1), x=r)["issues"]) == []
    assert one(spark, review_record(F.col("x")), x='{"verdict": "fine", "summary": "s"}') is None


def test_chunks_by_their_properties(spark):
    """Nothing but blanks is lost, no chunk is over a limit that a single piece keeps, and no chunk would have taken the next piece."""
    rng = random.Random(5)
    limit, marks = 20, 3
    texts = ["".join(rng.choice("ab ?？\n\n\n　") for _ in range(rng.randint(0, 120))) for _ in range(150)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING").select("i", chunks(F.col("t"), limit, marks).alias("c")).collect()
    squash = lambda x: "".join(x.split())
    asked = lambda x: x.count("?") + x.count("？")
    for r in rows:
        got = list(r["c"])
        assert squash("".join(got)) == squash(texts[r["i"]]) and all(got)
        assert all(len(c) <= limit for c in got) and all(asked(c) <= marks for c in got if "\n\n" in c)
        for c, after in zip(got, got[1:]):
            both = f"{c}\n\n{after.split(chr(10) * 2)[0]}".strip()
            assert len(both) > limit or asked(both) > marks


def test_halves(spark):
    h = one(spark, halves(F.col("x")), x="a" * 300 + "\n\n" + "b" * 250)
    assert (h["left"], h["right"]) == ("a" * 300, "b" * 250)
    h = one(spark, halves(F.col("x")), x="a" * 10 + "\n\n" + "b" * 600)
    assert len(h["left"]) == 306 and one(spark, halves(F.col("x")), x="short") is None


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Tue, 04 Mar 2025 01:00:00 GMT", "2025-03-04T01:00:00+00:00"), ("4 Mar 2025 01:00 EST", "2025-03-04T06:00:00+00:00"), ("Tue, 4 Mar 25 23:30:00 -0800", "2025-03-05T07:30:00+00:00"),
        ("4 Mar 2025 01:00:00", "2025-03-04T01:00:00+00:00"), ("yesterday", "yesterday"), ("Tue, 99 Mar 2025 01:00:00 GMT", "Tue, 99 Mar 2025 01:00:00 GMT"), (" ", None), (None, None),
    ],
)
def test_feed_dates(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "x STRING").select(W.feed_date(F.col("x"))).first()[0] == want


@pytest.mark.parametrize(("raw", "want"), [("&#8212; &#x4e2d; &eacute;", "— 中 é"), ("&amp;lt;", "&lt;"), ("&#0;&#xD800;&#x110000;", "\ufffd" * 3), ("&#128;&bogus; & &;", "€&bogus; & &;"), ("a&apos;b", "a'b"), (None, None), ("", "")])
def test_unescaped(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "x STRING").select(W.unescaped(F.col("x"))).first()[0] == want


def test_links_of_odd_markup(spark):
    html = "<a data-href='/x' href='/y'>1</a><a href=/u>2</a><a class=c href=\"/v?a=1&amp;b=2\" rel='x NoFollow'>3</a><a href=\"/w?a=1&amp;b=2\">4 &lt; 5</a>"
    got = one(spark, W.page_links(F.col("x")), x=html)
    assert [(r["pos"], r["href"], r["anchor"]) for r in got] == [(0, "/y", "1"), (1, "/u", "2"), (3, "/w?a=1&b=2", "4 < 5")]


def test_addresses_with_wrong_codes(spark):
    assert one(spark, W.normal_url(F.col("x")), x="\u3000https://A.example//p/?q=%zz+b&r=100%\u3000") == "https://a.example/p?q=%25zz+b&r=100%25"
