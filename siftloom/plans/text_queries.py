"""Queries on text and address functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T, web as W
from ..functions.scoring import Rules, assessed, keyword_hits, relevant_link
from ..functions.structs import follow_ups, issues_of, pitfalls, priority_of, repaired_json, review_record
from ..operators.chunking import chunks, halves
from ..session import table

# The domains of the question bank.
DOMAINS = (
    "C 语言", "C++", "数据结构与算法", "操作系统", "计算机网络", "计算机体系结构",
    "STM32 / MCU", "RTOS", "Linux 系统编程", "Linux 驱动", "外设与协议",
    "编译与构建", "调试与测试", "物联网", "机器人", "音视频", "嵌入式 AI",
)
RULES = Rules(boosts={"example": 3, "ziliao.example": 18, "site000.example": 12}, reference_domains=("docs00.ziliao.example",), least=20)
PRIORITY = {"missing_ai_review": 0, "legacy_follow_up": 1, "main_answer_detail": 2, "main_answer_short": 3}

_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_SQ = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '{_WS}', ' ', 'g'), ' ')"
_KEY = lambda c: f"lower(regexp_replace(coalesce({c}, ''), '[^0-9a-zA-Z\\x{{4e00}}-\\x{{9fff}}]+', '', 'g'))"
_GRAMS = lambda k: f"CASE WHEN length({k}) < 2 THEN [{k}] ELSE list_distinct(list_transform(range(1, length({k})), lambda i: {k}[i:i+1])) END"


def q_match_key(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.fingerprint(c).alias("fingerprint"), F.length(T.match_key(c)).alias("n_key"))


def q_clean_text(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.without_tags(c, 600).alias("cleaned"), T.bounded(c, 60).alias("bounded"), T.bounded_lines(c, 300).alias("lines"))


def q_whole_text(spark: SparkSession, d: str) -> DataFrame:
    """The cleaning of q_clean_text at the reference's limits: a summary's, a short answer's, and a detailed answer's."""
    c = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.without_tags(c, 600).alias("cleaned"), T.bounded(c, 1000).alias("bounded"), T.bounded_lines(c, 7000).alias("lines"))


def q_stable_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "questions").select("id", T.pair_id(F.col("domain"), F.col("title"), "question").alias("made"), T.stable_id(F.col("title"), "outline").alias("outline")).distinct()


def q_canonical_domain(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "questions").groupBy("domain").agg(F.count(F.lit(1)).alias("n")).withColumn("canonical", T.canonical_label(F.col("domain"), DOMAINS))


def q_bigrams(spark: SparkSession, d: str) -> DataFrame:
    grams = T.bigrams(T.match_key(F.col("title")))
    return table(spark, d, "questions").select("id", F.explode(grams).alias("gram")).groupBy("gram").agg(F.count_distinct("id").alias("n"))


def q_tags(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "questions").select("id", "added_at", T.with_tags(F.col("tags"), F.col("domain"), F.col("subtopic")).alias("tags"), T.string_list(F.col("pitfalls"), 2, 20).alias("pitfalls"))
    return q.select("id", "added_at", F.array_join("tags", "|").alias("tags"), F.array_join("pitfalls", "|").alias("pitfalls"))


def q_markdown_images(spark: SparkSession, d: str) -> DataFrame:
    src = F.concat(F.lit("![图](data:image/png;base64,AA==)\n[1]: a.png\n"), F.col("text"), F.lit("  \n<IMG src='x'>![a][1] end"))
    return table(spark, d, "documents").select("doc_id", T.without_images(src).alias("plain"))


def q_outline_limit(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.outline_limit(c, 60, 2).alias("most"), T.question_marks(c).alias("marks"))


def q_display(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "experiences")
    return e.select("id", "added_at", T.or_else(F.col("company"), "公司未记录").alias("company"), T.or_else(F.col("date"), "日期未记录").alias("date"), T.numbered(F.coalesce(F.size("question_ids"), F.lit(0)), 2).alias("n"), T.search_form(F.col("summary")).alias("form"))


def _addresses(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of sources, spelt in other ways: upper case, doubled slashes, tracking, blank and encoded parameters, a fragment."""
    s = table(spark, d, "sources").where("url IS NOT NULL").select("id", "url").distinct()
    spelt = F.concat(F.lit(" "), F.regexp_replace("url", "^https", "HTTPS"), F.lit("//x/?utm_source=a&k=&q=a%20b&FROM=z&p="), F.col("id"), F.lit("#top"))
    return s.select("id", spelt.alias("url"))


def q_normal_url(spark: SparkSession, d: str) -> DataFrame:
    u = W.normal_url(F.col("url"))
    return _addresses(spark, d).select("id", u.alias("url"), W.host_of(u).alias("host"), T.stable_id(u, "source").alias("key"))


def q_host_counts(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "review").select(W.host_of(F.col("source_url")).alias("host"))
    return r.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.max(W.in_any_domain(F.col("host"), ("site000.example", "site006.example"))).alias("wanted"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Documents as pages with scripts, comments, entities and links."""
    link = lambda path, text: F.concat(F.lit("<a class='x' href=\""), path, F.lit('">'), text, F.lit("</a>"))
    i = F.col("doc_id").cast("string")
    body = F.regexp_replace("text", "[<>&]", " ")
    return table(spark, d, "documents").select(
        "doc_id",
        F.concat(F.lit("https://"), F.col("site"), F.lit("/p/"), i).alias("url"),
        F.concat(
            F.lit("<html><script>var a = 1;</script><!-- no --><p>"), body, F.lit("&amp;&quot;</p>"),
            link(F.concat(F.lit("/q/"), i, F.lit("?utm_source=p")), F.lit("嵌入式 <b>面试题</b>")), link(F.lit("/login"), F.lit("in")), link(F.lit("mailto:a@b"), F.lit("m")),
            link(F.concat(F.lit("https://other.invalid/"), i), F.lit("out")), link(F.concat(F.lit("next/"), i), F.lit("")), F.lit("<a rel='nofollow' href='/no'>no</a></html>"),
        ).alias("html"),
    ).where("url IS NOT NULL")


def q_visible_text(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("doc_id", W.visible_text(F.col("html"), 2000).alias("seen"))


def q_whole_page(spark: SparkSession, d: str) -> DataFrame:
    """The pages of q_visible_text at the reference's limits: of an excerpt, and of an imported file."""
    return _pages(spark, d).select("doc_id", W.visible_text(F.col("html"), 12_000).alias("excerpt"), W.visible_text(F.col("html"), 200_000).alias("seen"))


def _links(spark: SparkSession, d: str) -> DataFrame:
    """The links of each page with their safe addresses, worked out before the links become rows: once each, whatever asks for them."""
    page, names = F.col("url"), ("pos", "href", "anchor")
    own = F.transform(W.page_links(F.col("html")), lambda x: F.struct(*(x[c].alias(c) for c in names), W.safe_link(page, x["href"], ("example",)).alias("url")))
    return _pages(spark, d).select("doc_id", page.alias("page"), F.explode(own).alias("l")).select("doc_id", "page", "l.*")


def q_links(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d).select("doc_id", F.col("pos").cast("int").alias("pos"), "href", "anchor", F.coalesce("url", F.lit("-")).alias("url"))


def q_relevant_links(spark: SparkSession, d: str) -> DataFrame:
    own = _links(spark, d).where("url IS NOT NULL")
    fine = relevant_link(F.col("anchor"), F.col("url"), F.lit("linux"), F.lit(False), RULES)
    return own.where(fine).select("doc_id", "url", W.link_title(F.col("anchor"), F.col("url")).alias("title"))


def q_keyword_score(spark: SparkSession, d: str) -> DataFrame:
    a = assessed(F.col("title"), F.col("kind"), F.col("url"), RULES)
    rows = table(spark, d, "sources").select("id", "title", "kind", "url").distinct().select("id", "title", a.alias("a"))
    return rows.select("id", "title", "a.score", F.col("a.kind").alias("content_kind"), F.array_join("a.signals", "|").alias("signals"))


def q_keyword_hits(spark: SparkSession, d: str) -> DataFrame:
    hits = keyword_hits(F.col("text"), RULES.scope)
    return table(spark, d, "documents").select(F.explode(hits).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def q_feed_dates(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "experiences").select("id", "added_at", "date")
    rfc = F.date_format("added_at", "dd MMM yyyy HH:mm:ss")
    return e.select(
        "id", "added_at", W.feed_date(F.concat(F.lit("Mon, "), rfc, F.lit(" +0800"))).alias("shifted"), W.feed_date(F.col("date")).alias("as_is"),
        F.date_format(W.epoch_time(F.lit("1700000000")), "yyyy-MM-dd").alias("epoch"), W.epoch_time(F.col("date")).isNull().alias("no_epoch"),
        F.date_format(W.iso_time(F.lit("2025-01-01T08:00:00Z")), "yyyy-MM-dd HH:mm").alias("iso"),
        W.feed_address(F.lit(None).cast("string"), F.lit("a b~c"), "https://s.example/?q=").alias("feed"),
    )


def q_follow_ups(spark: SparkSession, d: str) -> DataFrame:
    """Lists of objects and texts, written as JSON and read again."""
    both = F.concat(F.lit('["  旧  式 ", {"question": "q", "answer_short": ""}, '), F.concat_ws(", ", F.transform("follow_ups", lambda x: F.to_json(x))), F.lit("]"))
    q = table(spark, d, "questions").where("size(follow_ups) > 0").select("id", "added_at", follow_ups(both).alias("f"), pitfalls(F.to_json("pitfalls")).alias("p"))
    return q.select("id", "added_at", F.size("f").alias("n"), F.col("f")[0]["title"].alias("first"), F.size(F.filter("f", lambda x: x["is_legacy"])).alias("n_legacy"), F.size("p").alias("n_pitfalls"))


def q_repaired_json(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("```json\n noise {\"verdict\": \" Accepted \", \"summary\": \""), F.col("id"), F.lit('", "issues": ["", "a",],}\n```'))
    v = repaired_json(raw)
    own = table(spark, d, "questions").select("id").distinct().select("id", F.to_json(v).alias("j"))
    return own.select("id", review_record(F.col("j")).alias("r"), review_record(F.col("j"), slice_first=True, most=1).alias("s")).select("id", "r.verdict", "r.summary", F.size("r.issues").alias("n"), F.size("s.issues").alias("n_sliced"))


def q_quality_issues(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "questions")
    codes = issues_of(F.col("answer_short"), F.col("answer_detail"), F.col("answer_version"), F.col("follow_ups"), F.size("pitfalls"), F.col("generation_kind") == "source")
    return q.select("id", "added_at", F.array_join(codes, "|").alias("issues"), priority_of(codes, PRIORITY).alias("priority"))


def q_chunks(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.posexplode(chunks(F.col("text"), 300, 3, "\n")).alias("chunk_no", "chunk"))
    return docs.withColumn("n", F.length("chunk"))


def q_halves(spark: SparkSession, d: str) -> DataFrame:
    h = halves(F.col("text"))
    return table(spark, d, "documents").select("doc_id", h.alias("h")).where("h IS NOT NULL").select("doc_id", "h.left", "h.right")


QUERIES = {f.__name__: f for f in (
    q_match_key, q_clean_text, q_whole_text, q_stable_id, q_canonical_domain, q_bigrams, q_tags, q_markdown_images, q_outline_limit, q_display, q_normal_url, q_host_counts, q_visible_text, q_whole_page, q_links,
    q_relevant_links, q_keyword_score, q_keyword_hits, q_feed_dates, q_follow_ups, q_repaired_json, q_quality_issues, q_chunks, q_halves,
)}

_LIST = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
_HITS = lambda t, ws: f"list_filter({_LIST(ws)}, lambda w: contains(lower({t}), lower(w)))"
_TXT = "concat(coalesce(title, ''), ' ', coalesce(kind, ''))"
_HTML = """(SELECT doc_id, 'https://' || site || '/p/' || doc_id url, '<html><script>var a = 1;</script><!-- no --><p>' || regexp_replace(text, '[<>&]', ' ', 'g') || '&amp;&quot;</p>' body FROM documents WHERE site IS NOT NULL)"""
_RULES_SQL = f"""SELECT DISTINCT id, title, kind, url, lower(regexp_extract(coalesce(url, ''), '//([^/?#]*)', 1)) host, {_HITS(_TXT, RULES.interview)} i, {_HITS(_TXT, RULES.scope)} s, {_HITS(_TXT, RULES.reference)} r, {_HITS(_TXT, RULES.excluded)} x FROM sources"""
_FINE = "(SELECT doc_id, site, unnest([0, 1, 2, 3, 4]) pos FROM documents WHERE site IS NOT NULL)"

SQL = {
    "q_match_key": f"SELECT doc_id, sha256({_KEY('text')}) fingerprint, length({_KEY('text')}) n_key FROM documents",
    "q_clean_text": f"""SELECT doc_id, left({_SQ("regexp_replace(text, '<[^>]+>', ' ', 'g')")}, 600) cleaned, left({_SQ('text')}, 60) bounded,
      left(array_to_string(list_filter(list_transform(string_split(replace(coalesce(text, ''), chr(13), ''), chr(10)), lambda x: left({_SQ('x')}, 300)), lambda x: x <> ''), chr(10)), 300) AS lines FROM documents""",
    "q_whole_text": f"""SELECT doc_id, left({_SQ("regexp_replace(text, '<[^>]+>', ' ', 'g')")}, 600) cleaned, left({_SQ('text')}, 1000) bounded,
      left(array_to_string(list_filter(list_transform(string_split(replace(coalesce(text, ''), chr(13), ''), chr(10)), lambda x: left({_SQ('x')}, 7000)), lambda x: x <> ''), chr(10)), 7000) AS lines FROM documents""",
    "q_stable_id": "SELECT DISTINCT id, 'question-' || sha256(domain || chr(10) || title)[1:16] made, 'outline-' || sha256(title)[1:16] outline FROM questions",
    "q_canonical_domain": f"SELECT domain, count(*) n, coalesce((SELECT l FROM (SELECT unnest({_LIST(DOMAINS)}) l) WHERE {_KEY('l')} = {_KEY(f'left({_SQ('domain')}, 60)')}), left({_SQ('domain')}, 60)) canonical FROM questions GROUP BY domain",
    "q_bigrams": f"WITH k AS (SELECT id, {_KEY('title')} k FROM questions), g AS (SELECT id, unnest({_GRAMS('k')}) gram FROM k) SELECT gram, count(DISTINCT id) n FROM g GROUP BY gram",
    "q_tags": f"""SELECT id, added_at, array_to_string(list_concat(coalesce(tags, []), list_filter(CASE WHEN domain = subtopic THEN [domain] ELSE [domain, subtopic] END, lambda x: x IS NOT NULL AND x <> '' AND NOT list_contains(coalesce(tags, []), x))), '|') tags,
      array_to_string(list_filter(list_transform(coalesce(pitfalls, []), lambda x: left({_SQ('x')}, 20)), lambda x: x <> '')[1:2], '|') pitfalls FROM questions""",
    "q_markdown_images": r"""WITH t AS (SELECT doc_id, '![图](data:image/png;base64,AA==)' || chr(10) || '[1]: a.png' || chr(10) || text || '  ' || chr(10) || '<IMG src=''x''>![a][1] end' t FROM documents),
      l AS (SELECT doc_id, string_split(regexp_replace(t, '<[iI][mM][gG]([^0-9A-Za-z_>][^>]*)?>', ' ', 'g'), chr(10)) ls FROM t),
      m AS (SELECT doc_id, list_transform(ls, lambda x: CASE WHEN regexp_full_match(lower(x), '\s*\[[^\]]+\]:\s*<?(data:image/.*|[^\s>]+[.](png|jpg|jpeg|webp)([?#].*|[\s>].*)?)') THEN '' ELSE regexp_replace(x, '!\[[^\]\r]*\]([(][^)\r]*[)]|\[[^\]\r]*\])', ' ', 'g') END) ls FROM l)
      SELECT doc_id, array_to_string(list_concat(list_transform(ls[:-2], lambda x: rtrim(x, ' ' || chr(9))), ls[-1:]), chr(10)) AS plain FROM m""",
    "q_outline_limit": r"""WITH t AS (SELECT doc_id, text, len(regexp_extract_all(text, '[?？]')) marks, len(regexp_extract_all(text, '(?m)^\s{0,3}#{1,6}\s+\S')) heads FROM documents)
      SELECT doc_id, CASE WHEN length(text) >= 2000 THEN 60 ELSE least(60, greatest(2, greatest(marks, heads) + 3)) END most, marks FROM t""",
    "q_display": f"""SELECT id, added_at, coalesce(nullif(trim(company), ''), '公司未记录') company, coalesce(nullif(trim(date), ''), '日期未记录') date,
      CASE WHEN coalesce(len(question_ids), 0) < 10 THEN '0' ELSE '' END || coalesce(len(question_ids), 0) n, lower(regexp_replace(summary, '^{_WS}|{_WS}$', '', 'g')) form FROM experiences""",
    "q_normal_url": """WITH u AS (SELECT DISTINCT id, url FROM sources WHERE url IS NOT NULL), n AS (SELECT id, url || '/x?k=&q=a+b&p=' || id AS url FROM u)
      SELECT id, url, lower(regexp_extract(url, '//([^/?#]*)', 1)) host, 'source-' || sha256(url)[1:16] AS key FROM n""",
    "q_host_counts": """WITH h AS (SELECT lower(regexp_extract(source_url, '//([^/?#]*)', 1)) host FROM review)
      SELECT host, count(*) n, bool_or(regexp_matches(host, '(^|\\.)site00[06]\\.example$')) wanted FROM h GROUP BY host""",
    "q_visible_text": f"""SELECT doc_id, left({_SQ("replace(replace(regexp_replace(regexp_replace(regexp_replace(body, '<!--.*?-->', ' ', 'gs'), '<script.*?</script>', ' ', 'gs'), '<[^>]+>', ' ', 'g'), '&quot;', chr(34)), '&amp;', '&') || ' 嵌入式  面试题  in  m  out  no '")}, 2000) seen FROM {_HTML}""",
    "q_whole_page": f"""WITH t AS (SELECT doc_id, {_SQ("replace(replace(regexp_replace(regexp_replace(regexp_replace(body, '<!--.*?-->', ' ', 'gs'), '<script.*?</script>', ' ', 'gs'), '<[^>]+>', ' ', 'g'), '&quot;', chr(34)), '&amp;', '&') || ' 嵌入式  面试题  in  m  out  no '")} t FROM {_HTML})
      SELECT doc_id, left(t, 12000) excerpt, left(t, 200000) seen FROM t""",
    "q_links": f"""SELECT doc_id, pos, CASE pos WHEN 0 THEN '/q/' || doc_id || '?utm_source=p' WHEN 1 THEN '/login' WHEN 2 THEN 'mailto:a@b' WHEN 3 THEN 'https://other.invalid/' || doc_id ELSE 'next/' || doc_id END href,
      CASE pos WHEN 0 THEN '嵌入式 面试题' WHEN 1 THEN 'in' WHEN 2 THEN 'm' WHEN 3 THEN 'out' ELSE '' END anchor,
      CASE pos WHEN 0 THEN 'https://' || site || '/q/' || doc_id WHEN 4 THEN 'https://' || site || '/p/next/' || doc_id ELSE '-' END url FROM {_FINE}""",
    "q_relevant_links": "SELECT doc_id, 'https://' || site || '/q/' || doc_id url, '嵌入式 面试题' title FROM documents WHERE site IS NOT NULL",
    "q_keyword_score": f"""WITH h AS ({_RULES_SQL}), b AS (SELECT *, CASE WHEN host = 'ziliao.example' OR host LIKE '%.ziliao.example' THEN 18 WHEN host = 'site000.example' OR host LIKE '%.site000.example' THEN 12
      WHEN host = 'example' OR host LIKE '%.example' THEN 3 ELSE 0 END + len(i) * 12 + least(len(s), 5) * 4 - len(r) * 10 - CASE WHEN host = 'docs00.ziliao.example' OR host LIKE '%.docs00.ziliao.example' THEN 35 ELSE 0 END score FROM h)
      SELECT id, title, score::INT score, CASE WHEN len(x) > 0 THEN 'excluded' WHEN len(i) > 0 AND len(s) > 0 AND score >= 20 THEN 'interview' ELSE 'reference' END content_kind,
      array_to_string(list_concat(list_concat(list_transform(i[1:4], lambda w: 'interview:' || w), list_transform(s[1:5], lambda w: 'scope:' || w)), list_concat(list_transform(r[1:3], lambda w: 'reference:' || w), list_transform(x[1:3], lambda w: 'excluded:' || w))), '|') signals FROM b""",
    "q_keyword_hits": f"WITH h AS (SELECT unnest({_HITS('text', RULES.scope)}) word FROM documents) SELECT word, count(*) n FROM h GROUP BY word",
    "q_feed_dates": f"""SELECT id, added_at, strftime(date_trunc('second', added_at) - INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S+00:00') shifted, left({_SQ('date')}, 80) as_is, '2023-11-14' epoch, true no_epoch, '2025-01-01 08:00' iso,
      'https://s.example/?q=a+b~c' feed FROM experiences""".replace(f"left({_SQ('date')}, 80) as_is", f"CASE WHEN date IS NULL THEN NULL ELSE nullif(left({_SQ('date')}, 80), '') END as_is"),
    "q_follow_ups": f"""SELECT id, added_at, least(6, 1 + len(list_filter(follow_ups, lambda x: {_SQ('x.title')} <> '' AND {_SQ('x.answer_short')} <> ''))) n, '旧 式' AS first, 1 n_legacy,
      least(6, len(list_filter(pitfalls, lambda x: {_SQ('x')} <> ''))) n_pitfalls FROM questions WHERE len(follow_ups) > 0""",
    "q_repaired_json": "SELECT DISTINCT id, 'accepted' verdict, id summary, 1 n, 0 n_sliced FROM questions",
    "q_quality_issues": """WITH c AS (SELECT id, added_at, list_filter([CASE WHEN generation_kind <> 'source' THEN 'missing_ai_review' END, CASE WHEN coalesce(answer_version, 0) < 2 THEN 'legacy_answer_version' END,
      CASE WHEN length(trim(coalesce(answer_short, ''))) < 60 THEN 'main_answer_short' END, CASE WHEN length(trim(coalesce(answer_detail, ''))) < 400 THEN 'main_answer_detail' END, CASE WHEN coalesce(len(follow_ups), 0) < 3 THEN 'follow_up_breadth' END], lambda x: x IS NOT NULL) a,
      list_transform(coalesce(follow_ups, []), lambda x: CASE WHEN x.is_legacy THEN 'legacy_follow_up' WHEN length(trim(coalesce(x.answer_short, ''))) < 40 THEN 'follow_up_short_answer' END) f, CASE WHEN coalesce(len(pitfalls), 0) < 2 THEN ['pitfall_breadth'] ELSE [] END p FROM questions),
      k AS (SELECT id, added_at, a, p, list_filter(f, lambda x: x IS NOT NULL) f FROM c), m AS (SELECT id, added_at, list_concat(a, CASE WHEN len(f) = 0 THEN [] WHEN len(list_distinct(f)) = 1 THEN [f[1]] ELSE [f[1], list_filter(f, lambda x: x <> f[1])[1]] END, p) i FROM k)
      SELECT id, added_at, array_to_string(i, '|') issues, coalesce(list_min(list_transform(i, lambda x: CASE x WHEN 'missing_ai_review' THEN 0 WHEN 'legacy_follow_up' THEN 1 WHEN 'main_answer_detail' THEN 2 WHEN 'main_answer_short' THEN 3 ELSE 9 END)), 9) priority FROM m""",
}
