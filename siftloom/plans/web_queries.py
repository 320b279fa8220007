"""Queries on addresses, dates, entities and links in varied spellings, with SQL that works them out in its own way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import web as W
from ..session import table

_VARIANT = "ascii(right(id, 1)) % 8"


def _spellings(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of sources in eight spellings, by the last character of the id."""
    return table(spark, d, "sources").where("url IS NOT NULL").select("id", "url").distinct().selectExpr(
        "id",
        f"""CASE {_VARIANT}
          WHEN 0 THEN concat('　', url, '?q=%zz+b&utm_medium=x ') WHEN 1 THEN concat(url, '//a///b//?A=1&a=2&=3&k')
          WHEN 2 THEN concat(upper(left(url, 12)), substr(url, 13), '?q=', id, '%20%E4%B8%AD~*&UTM_Source=z#frag?x') WHEN 3 THEN concat(url, '?&&a=b=c&SPM=1&d=%2B%26%3D')
          WHEN 4 THEN concat(url, '/?from=x&share_token=y') WHEN 5 THEN concat(' ', url, '?中=文&e=%e4%b8%ad')
          WHEN 6 THEN concat(url, '?%75tm_term=1&100%=5%&p=a%2') ELSE concat(url, '#') END AS raw""",
    )


def q_url_spellings(spark: SparkSession, d: str) -> DataFrame:
    return _spellings(spark, d).select("id", "raw", W.normal_url(F.col("raw")).alias("url"))


def q_feed_zones(spark: SparkSession, d: str) -> DataFrame:
    """Arrival times as feeds write them: with zone names, without weekday, seconds or zone, with years of two digits; and texts that are no dates."""
    e = table(spark, d, "experiences").select("id", F.col("added_at").cast("timestamp").alias("at")).distinct()
    t = lambda f: F.date_format("at", f)
    forms = [
        F.concat(F.lit("Tue, "), t("dd MMM yyyy HH:mm:ss"), F.lit(" GMT")), F.concat(t("d MMM yyyy HH:mm:ss"), F.lit(" EST")), F.concat(F.lit("Wednesday, "), t("dd MMM yy HH:mm"), F.lit(" PDT")),
        F.concat(t("d MMM yyyy HH:mm"), F.lit(" +0530")), t("dd MMM yyyy HH:mm:ss"), F.concat(F.lit(" Sun,"), t("dd MMM yyyy HH:mm:ss"), F.lit(" -0000 (none)")), F.concat(t("yyyy-MM-dd"), F.lit("  <b>x</b>")), F.lit(" \t"),
    ]
    rows = e.select("id", "at", F.posexplode(F.array(*forms)).alias("form", "raw"))
    return rows.select("id", "form", "raw", F.coalesce(W.feed_date(F.col("raw")), F.lit("-")).alias("date"))


def q_entities(spark: SparkSession, d: str) -> DataFrame:
    """Texts of documents, their characters outside ASCII written as references by number, decoded again; names, wrong numbers and double escapes between them."""
    words = table(spark, d, "documents").select("doc_id", F.regexp_replace("text", "[<>&]", " ").alias("text"))
    coded = F.array_join(F.transform(F.regexp_extract_all("text", F.lit("(?s)."), 0), lambda c: F.when(c.rlike("[一-鿿]"), F.concat(F.lit("&#x"), F.lower(F.hex(F.encode(c, "UTF-16BE"))), F.lit(";"))).otherwise(c)), "")
    return words.select("doc_id", W.visible_text(F.concat(F.lit("<p>&eacute;&mdash;&amp;lt;&#8212;&#0;&bogus; &#x1F600;</p>"), coded, F.lit("&nbsp;&#128;")), 200_000).alias("seen"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Documents as pages whose links have quoted and bare values, other attributes in front, entities, repeats, and lead back to the page."""
    i = F.col("doc_id").cast("string")
    n = (F.col("doc_id") % 97).cast("string")
    return table(spark, d, "documents").where("site IS NOT NULL").select(
        "doc_id", F.concat(F.lit("https://"), F.col("site"), F.lit("/p/"), i).alias("page"),
        F.concat(
            F.lit("<a data-href='/x' href='/q/"), n, F.lit("'>one</a><a href=/bare/"), i, F.lit("/>two</a><A TITLE=\"t &lt; u\" HREF = \"?a=1&amp;b="), n, F.lit("\"> </A>"),
            F.lit("<a href=/q/"), n, F.lit("#again>same</a><a href='/p/"), i, F.lit("'>self</a><a rel=nofollow href=/n>no</a><a href='/open'><a href=\"../up/"), n, F.lit("\">in &amp; out</a><a href='/login'>in</a>"),
        ).alias("html"),
    )


def q_page_links(spark: SparkSession, d: str) -> DataFrame:
    links = F.explode(W.content_links(F.col("html"), F.col("page"), ("example",))).alias("l")
    return _pages(spark, d).select("doc_id", links).select("doc_id", F.col("l.pos").cast("int").alias("pos"), "l.url", "l.anchor")


QUERIES = {f.__name__: f for f in (q_url_spellings, q_feed_zones, q_entities, q_page_links)}

_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_ENC = lambda c: f"replace(url_encode(url_decode(replace({c}, '+', ' '))), '%20', '+')"
_IGNORED = "[" + ", ".join(f"'{x}'" for x in W.TRACKING) + "]"
SQL = {
    "q_url_spellings": f"""WITH s AS (SELECT DISTINCT id, url FROM sources WHERE url IS NOT NULL), r AS (SELECT id, CASE {_VARIANT} WHEN 0 THEN '　' || url || '?q=%zz+b&utm_medium=x ' WHEN 1 THEN url || '//a///b//?A=1&a=2&=3&k'
      WHEN 2 THEN upper(left(url, 12)) || substr(url, 13) || '?q=' || id || '%20%E4%B8%AD~*&UTM_Source=z#frag?x' WHEN 3 THEN url || '?&&a=b=c&SPM=1&d=%2B%26%3D' WHEN 4 THEN url || '/?from=x&share_token=y' WHEN 5 THEN ' ' || url || '?中=文&e=%e4%b8%ad'
      WHEN 6 THEN url || '?%75tm_term=1&100%=5%&p=a%2' ELSE url || '#' END raw FROM s), t AS (SELECT id, raw, regexp_replace(raw, '^{_WS}|{_WS}$', '', 'g') u FROM r),
      p AS (SELECT id, raw, split_part(split_part(u, '#', 1), '?', 1) a, list_filter(string_split(substr(split_part(u, '#', 1), length(split_part(split_part(u, '#', 1), '?', 1)) + 2), '&'), lambda x: x <> '') q FROM t),
      k AS (SELECT id, raw, lower(regexp_extract(a, '^[^:]+://[^/]*')) h, regexp_replace(regexp_replace(regexp_extract(a, '^[^:]+://[^/]*(.*)$', 1), '/+', '/', 'g'), '/$', '') f,
        list_transform(list_filter(q, lambda x: NOT list_contains({_IGNORED}, lower(url_decode(split_part(x, '=', 1))))), lambda x: {_ENC("split_part(x, '=', 1)")} || '=' || {_ENC("substr(x, length(split_part(x, '=', 1)) + 2)")}) q FROM p)
      SELECT id, raw, h || CASE WHEN f = '' THEN '/' ELSE f END || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END url FROM k""",
    "q_feed_zones": """WITH e AS (SELECT DISTINCT id, date_trunc('second', added_at) tm FROM experiences), f AS (SELECT id, tm, unnest(range(8)) form FROM e), r AS (SELECT id, tm, form, CASE form WHEN 0 THEN strftime(tm, 'Tue, %d %b %Y %H:%M:%S GMT') WHEN 1 THEN strftime(tm, '%-d %b %Y %H:%M:%S EST')
      WHEN 2 THEN strftime(tm, 'Wednesday, %d %b %y %H:%M PDT') WHEN 3 THEN strftime(tm, '%-d %b %Y %H:%M +0530') WHEN 4 THEN strftime(tm, '%d %b %Y %H:%M:%S') WHEN 5 THEN strftime(tm, ' Sun,%d %b %Y %H:%M:%S -0000 (none)') WHEN 6 THEN strftime(tm, '%Y-%m-%d  <b>x</b>') ELSE ' ' || chr(9) END raw FROM f)
      SELECT id, form, raw, CASE form WHEN 6 THEN strftime(tm, '%Y-%m-%d x') WHEN 7 THEN '-' ELSE strftime(CASE WHEN form IN (2, 3) THEN date_trunc('minute', tm) ELSE tm END + CASE form WHEN 1 THEN INTERVAL 300 MINUTE WHEN 2 THEN INTERVAL 420 MINUTE WHEN 3 THEN INTERVAL (-330) MINUTE ELSE INTERVAL 0 MINUTE END, '%Y-%m-%dT%H:%M:%S+00:00') END date FROM r""",
    "q_entities": f"""SELECT doc_id, trim(regexp_replace(left('é—&lt;—�&bogus; \U0001f600 ' || regexp_replace(text, '[<>&]', ' ', 'g') || ' €', 1000000), '{_WS}', ' ', 'g'), ' ') seen FROM documents""",
    "q_page_links": """WITH n AS (SELECT doc_id, site, doc_id % 97 n, 'https://' || lower(site) h FROM documents WHERE site IS NOT NULL), l AS (SELECT doc_id, unnest([{'pos': 0, 'url': h || '/q/' || n, 'anchor': 'one'}, {'pos': 1, 'url': h || '/bare/' || doc_id, 'anchor': 'two'},
      {'pos': 2, 'url': h || '/p/' || doc_id || '?a=1&b=' || n, 'anchor': 't < u'}, {'pos': 6, 'url': h || '/up/' || n, 'anchor': 'in & out'}]) l FROM n) SELECT doc_id, l.pos, l.url, l.anchor FROM l""",
}
