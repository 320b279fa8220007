"""Queries on keyed records: state, matching, selection, reports, validation, search, streams; with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import match_key
from ..operators import records as R
from ..operators.frontier import discovered
from ..operators.matching import best_earlier, theta_best, with_ratio
from ..operators.search import catalogue, catalogue_lines, faceted
from ..operators.state import due, stale, unchanged, upsert
from ..session import table
from ..streaming.increments import landed, run_now, windowed

NOW = "TIMESTAMP_NTZ '2026-03-01 12:00:00'"
_ORD = "(epoch_us(arrived_at) * 100 + batch_no)"


def _reviews(spark: SparkSession, d: str) -> DataFrame:
    """review rows with ord: a total order of deliveries."""
    return table(spark, d, "review").withColumn("ord", F.unix_micros(F.col("arrived_at").cast("timestamp")) * 100 + F.col("batch_no"))


def q_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The first half of the batches is the state, the second half comes in; a staged decision stays."""
    r = _reviews(spark, d)
    seen = dict(key="review_id", order=["ord"], payload=["decision", "candidate_score", "recommendation"], seen="arrived_at", sticky=("decision", ("staged",)))
    empty = spark.createDataFrame([], "review_id STRING, decision STRING, candidate_score INT, recommendation STRING, first_seen TIMESTAMP_NTZ, last_seen TIMESTAMP_NTZ")
    return upsert(upsert(empty, r.where("batch_no <= 12"), **seen), r.where("batch_no > 12"), **seen)


def q_due(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources").groupBy("id").agg(F.max("added_at").alias("at"), F.max("deleted_at").alias("gone"))
    now = F.expr(f"CAST({NOW} AS TIMESTAMP)")
    at = F.col("at").cast("timestamp")
    return s.select(
        "id", due(at, now, 30).alias("due"), due(at, now, 0).alias("always"),
        stale(F.col("at").isNotNull(), F.col("gone").isNotNull(), at, F.col("id").endswith("0"), now).alias("stale"),
    )


def q_unchanged(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "review").select("review_id", "batch_no", F.sha2("title", 256).alias("print"))
    return unchanged(r.where("batch_no > 12"), r.where("batch_no <= 12"), ["review_id", "print"])


def q_best_match(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources").groupBy("id", "title").agg(F.min("added_at").alias("at"))
    s = s.withColumn("ord", F.unix_micros(F.col("at").cast("timestamp")))
    return best_earlier(s, "id", "title", "ord").select("id", "match_id", F.round("score", 6).alias("score"))


def q_nearest_question(spark: SparkSession, d: str) -> DataFrame:
    """The held-out items' nearest questions by bigrams, however far."""
    items = table(spark, d, "benchitems").select(F.col("item_id").cast("string").alias("id"), "text")
    q = table(spark, d, "questions").select("id", F.col("title").alias("text")).distinct()
    return theta_best(items, q, match_key(F.col("text"))).withColumn("score", F.round("score", 6))


def q_sequence_ratio(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources").groupBy("id", "title").agg(F.min("added_at").alias("at")).withColumn("ord", F.unix_micros(F.col("at").cast("timestamp")))
    best = best_earlier(s, "id", "title", "ord").select("id", "match_id")
    text = s.select("id", "title")
    pairs = best.join(text, "id").join(text.select(F.col("id").alias("match_id"), F.col("title").alias("known")), "match_id")
    return with_ratio(pairs, "title", "known").select("id", "match_id", F.round("jaccard", 6).alias("jaccard"), F.round("ratio", 6).alias("ratio"), "rounded")


def q_merged_titles(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "questions").withColumn("ord", F.unix_micros(F.col("added_at").cast("timestamp")))
    m = R.merged_by_title(q.groupBy("id", "title").agg(F.min("ord").alias("ord"), F.first("answer_detail", True).alias("answer_detail"), F.first("tags", True).alias("tags")), "title", "ord", ["answer_detail"], "tags")
    return m.select("key", "n", F.length("answer_detail").alias("n_detail"), F.size("tags").alias("n_tags"))


def q_first_values(spark: SparkSession, d: str) -> DataFrame:
    r = _reviews(spark, d)
    out = r.groupBy("candidate_id").agg(R.first_non_empty("question_evidence", "ord").alias("evidence"), R.first_non_empty("difficulty", "ord").alias("difficulty"))
    reasons = R.joined_reasons(r, "candidate_id", "domain", "ord", "无")
    return out.join(reasons, "candidate_id").select("candidate_id", F.coalesce("evidence", F.lit("")).alias("evidence"), "domain")


def q_source_lookup(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources").groupBy("id", "url", "import_key").agg(F.lit(1))
    r = table(spark, d, "review").select("review_id", "source_url").distinct()
    return R.looked_up(r, "source_url", [(s, "import_key", "id"), (s, "url", "id")], "source_id").select("review_id", F.coalesce("source_id", F.lit("-")).alias("source_id"))


def q_source_notes(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "questions").dropDuplicates(["id"])
    s = table(spark, d, "sources").groupBy("id").agg(F.min("title").alias("title"))
    return R.array_lookup(q, "id", "source_ids", s.withColumnRenamed("id", "source_id"), "source_id", "title").select("id", F.array_join("found", "|").alias("notes"))


def q_ranked(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "review").groupBy("review_id").agg(F.max("decision").alias("decision"), F.max("candidate_score").alias("score"), F.max("arrived_at").alias("came"))
    rank = F.when(F.col("decision") == "pending", 0).when(F.col("decision") == "approved", 1).when(F.col("decision") == "staged", 2).otherwise(5)
    return R.top(r.withColumn("rank", rank), F.col("rank"), F.col("score").desc_nulls_last(), F.col("came").desc(), F.col("review_id"), most=50)


def q_top_per_provider(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "review").where("candidate_provider IS NOT NULL").groupBy("candidate_provider", "review_id").agg(F.max("candidate_score").alias("score"))
    return R.top_per(r, ["candidate_provider"], F.col("score").desc_nulls_last(), F.col("review_id"), most=5)


def q_batches(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return R.batched(o, [F.col("o_orderkey")], 4, by=["o_custkey"])


def q_counts(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "review")
    return R.counts(r, "candidate_provider").withColumn("what", F.lit("provider")).withColumnRenamed("candidate_provider", "v").unionByName(R.counts(r, "decision").withColumn("what", F.lit("decision")).withColumnRenamed("decision", "v"))


def q_conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "review")
    return r.groupBy("batch_no").agg(
        F.count_if(F.col("generation_kind") == "source").alias("direct"), F.count_if(F.col("generation_kind") == "expanded").alias("expanded"),
        F.count_if((F.col("recommendation") == "new-draft") & (F.col("decision") == "pending")).alias("fresh"), F.count_if(F.col("source_url").startswith("local://")).alias("local"),
        F.sum(F.size(F.split("title", "，"))).alias("parts"),
    )


def q_distinct_categories(spark: SparkSession, d: str) -> DataFrame:
    return R.first_seen_values(table(spark, d, "questions"), "domain", "added_at")


def q_staged_ids(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "review").where("staged_question_id IS NOT NULL").select("candidate_id", "staged_question_id").distinct()
    return r.groupBy("candidate_id").agg(F.array_join(F.array_sort(F.collect_set("staged_question_id")), "|").alias("ids"))


def q_repeated_ids(spark: SparkSession, d: str) -> DataFrame:
    return R.repeated_keys(table(spark, d, "questions"), "id").withColumn("entity", F.lit("questions")).unionByName(R.repeated_keys(table(spark, d, "experiences"), "id").withColumn("entity", F.lit("experiences")))


def q_violations(spark: SparkSession, d: str) -> DataFrame:
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    q = R.violations(
        table(spark, d, "questions").dropDuplicates(["id"]), "questions", "id",
        {
            "no title": blank(F.col("title")), "no short answer": blank(F.col("answer_short")), "no detail": blank(F.col("answer_detail")),
            "status": ~F.col("status").isin("source-only", "ai-draft", "reviewed", "verified", "outdated"), "no tags": F.coalesce(F.size("tags"), F.lit(0)) == 0,
            "verified without source": (F.col("status") == "verified") & (F.coalesce(F.size("source_ids"), F.lit(0)) == 0),
            "shallow version 2": (F.col("answer_version") >= 2) & (F.length("answer_detail") < 250), "incomplete follow-up": F.exists("follow_ups", lambda x: ~x["is_legacy"] & blank(x["answer_short"])),
        },
    )
    e = R.violations(table(spark, d, "experiences").dropDuplicates(["id"]), "experiences", "id", {"no role": blank(F.col("role")), "no round": blank(F.col("round")), "no summary": blank(F.col("summary")), "no source": F.col("source_id").isNull()})
    return q.unionByName(e).groupBy("entity", "rule").agg(F.count(F.lit(1)).alias("n"))


def q_search(spark: SparkSession, d: str) -> DataFrame:
    q = faceted(table(spark, d, "questions"), {"domain": "RTOS", "difficulty": None}, "  WDT ", ["title", "answer_short", "answer_detail", "domain", "subtopic"], ["tags"])
    return q.select("id", "title").distinct()


def q_search_sources(spark: SparkSession, d: str) -> DataFrame:
    s = faceted(table(spark, d, "sources"), {}, "面", ["title", "kind", "url"]).select("id").distinct().withColumn("what", F.lit("source"))
    e = table(spark, d, "experiences").withColumn("company", F.coalesce("company", F.lit("公司未记录")))
    return s.unionByName(faceted(e, {}, "未记录", ["company", "role", "round", "summary"]).select("id").distinct().withColumn("what", F.lit("experience")))


def q_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return catalogue(*(table(spark, d, t) for t in ("questions", "experiences", "sources")))


def q_catalogue_lines(spark: SparkSession, d: str) -> DataFrame:
    return catalogue_lines(table(spark, d, "questions"), ["id", "title", "domain", "subtopic", "difficulty", "tags", "status"]).distinct()


def q_experience_titles(spark: SparkSession, d: str) -> DataFrame:
    """Inner lookup of an experience's questions, left lookup of its source."""
    e = table(spark, d, "experiences").dropDuplicates(["id"])
    q = table(spark, d, "questions").groupBy("id").agg(F.min("title").alias("question"))
    s = table(spark, d, "sources").groupBy("id").agg(F.min("title").alias("source"))
    rows = e.select(F.col("id").alias("experience"), "source_id", F.explode("question_ids").alias("qid")).distinct()
    return rows.join(q, rows.qid == q.id).drop(q.id).join(s, rows.source_id == s.id, "left").select("experience", "question", F.coalesce("source", F.lit("-")).alias("source"))


def q_frontier(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "experiences").where("question_ids IS NOT NULL").groupBy("id").agg(F.first("question_ids").alias("qs"), F.min("added_at").alias("at"))
    seeds = R.top(e, F.col("at"), F.col("id"), most=40)
    ordered = R.batched(seeds, [F.col("at"), F.col("id")], 1).select(F.col("batch_no").alias("seed"), F.posexplode("qs").alias("pos", "url"))
    known = table(spark, d, "questions").where("deleted_at IS NOT NULL").select(F.col("id").alias("url"))
    return discovered(ordered, known)


def q_event_windows(spark: SparkSession, d: str) -> DataFrame:
    events = landed(spark, d, table(spark, d, "events").schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    out = run_now(windowed(events, "ts", "event_type", "value"), f"event_windows-{uuid.uuid4().hex}")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


def q_first_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.groupBy("user_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), F.count(F.lit(1)).alias("n"))


def q_order_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their customers' nations: aggregated before the join, so the join is between customers."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("spent"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name").agg(F.sum("n").alias("n"), F.round(F.sum("spent"), 2).alias("spent"))


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("q_")}

_K = lambda c: f"lower(regexp_replace(coalesce({c}, ''), '[^0-9a-zA-Z\\x{{4e00}}-\\x{{9fff}}]+', '', 'g'))"
_G = lambda k: f"CASE WHEN length({k}) < 2 THEN [{k}] ELSE list_distinct(list_transform(range(1, length({k})), lambda i: {k}[i:i+1])) END"
_J = "len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g)))"
_BLANK = lambda c: f"trim(coalesce({c}, '')) = ''"

SQL = {
    "q_upsert": f"""WITH r AS (SELECT *, {_ORD} ord FROM review), h AS (SELECT review_id, batch_no > 12 late, arg_max(decision, ord) decision, arg_max(candidate_score, ord) filter (true) candidate_score0, min(arrived_at) f, max(arrived_at) l, max(ord) m FROM r GROUP BY 1, 2),
      v AS (SELECT h.review_id, late, r.decision, r.candidate_score, r.recommendation, f, l FROM h JOIN r ON r.review_id = h.review_id AND r.ord = h.m)
      SELECT coalesce(a.review_id, b.review_id) review_id, CASE WHEN a.decision = 'staged' OR b.review_id IS NULL THEN a.decision ELSE b.decision END decision, CASE WHEN b.review_id IS NULL THEN a.candidate_score ELSE b.candidate_score END candidate_score,
      CASE WHEN b.review_id IS NULL THEN a.recommendation ELSE b.recommendation END recommendation, coalesce(a.f, b.f) first_seen, coalesce(b.l, a.l) last_seen FROM (SELECT DISTINCT * FROM v WHERE NOT late) a FULL JOIN (SELECT DISTINCT * FROM v WHERE late) b USING (review_id)""",
    "q_due": """WITH s AS (SELECT id, max(added_at) tm, max(deleted_at) gone, floor(epoch(TIMESTAMP '2026-03-01 12:00:00' - max(added_at)) / 86400) age FROM sources GROUP BY id)
      SELECT id, age >= 30 due, true always, gone IS NOT NULL OR (id LIKE '%0' AND age >= 3) OR age >= 30 stale FROM s""",
    "q_unchanged": """SELECT review_id, batch_no, sha256(title) print FROM review r WHERE batch_no > 12 AND NOT EXISTS (SELECT 1 FROM review p WHERE p.batch_no <= 12 AND p.review_id = r.review_id AND p.title = r.title)""",
    "q_best_match": f"""WITH s AS (SELECT id, title, min(added_at) tm FROM sources GROUP BY 1, 2), k AS (SELECT id, tm, {_K('title')} k FROM s), g AS (SELECT id, tm, k, {_G('k')} g FROM k),
      p AS (SELECT a.id, b.id b, {_J} score FROM g a JOIN g b ON b.tm < a.tm) SELECT id, max((score, b)).b match_id, round(max((score, b)).s, 6) score FROM (SELECT id, b, score FROM p WHERE score >= 0.62) GROUP BY id""".replace(
        "max((score, b)).b match_id, round(max((score, b)).s, 6) score", "max({'s': score, 'b': b}).b match_id, round(max({'s': score, 'b': b}).s, 6) score"
    ),
    "q_nearest_question": f"""WITH i AS (SELECT item_id::VARCHAR id, {_G(_K('text'))} g FROM benchitems), q AS (SELECT DISTINCT id, {_G(_K('title'))} g FROM questions), iu AS (SELECT id, len(g) n, unnest(g) x FROM i), qu AS (SELECT id, len(g) n, unnest(g) x FROM q),
      p AS (SELECT a.id, b.id b, a.n an, b.n bn, count(*) c FROM iu a JOIN qu b USING (x) GROUP BY ALL), s AS (SELECT id, b, c / (an + bn - c) score FROM p) SELECT id, round(max({{'s': score, 'b': b}}).s, 6) score, max({{'s': score, 'b': b}}).b match_id FROM s GROUP BY id""",
    "q_first_values": f"""WITH r AS (SELECT *, {_ORD} ord FROM review), e AS (SELECT candidate_id, arg_min(question_evidence, ord) FILTER (question_evidence IS NOT NULL AND question_evidence <> '') evidence FROM r GROUP BY 1),
      v AS (SELECT candidate_id, domain, min(ord) tm FROM r WHERE domain <> '' GROUP BY 1, 2), d AS (SELECT candidate_id, left(string_agg(domain, '；' ORDER BY tm, domain), 600) AS domain FROM v GROUP BY 1)
      SELECT candidate_id, coalesce(evidence, '') evidence, coalesce(domain, '无') AS domain FROM e LEFT JOIN d USING (candidate_id)""",
    "q_source_lookup": """WITH k AS (SELECT import_key k, min(id) id, 0 i FROM sources WHERE import_key IS NOT NULL GROUP BY 1 UNION ALL SELECT url, min(id), 1 FROM sources WHERE url IS NOT NULL GROUP BY 1), m AS (SELECT k, arg_min(id, i) id FROM k GROUP BY k)
      SELECT DISTINCT review_id, coalesce(id, '-') source_id FROM review LEFT JOIN m ON k = source_url""",
    "q_source_notes": """WITH q AS (SELECT id, any_value(source_ids) s FROM questions GROUP BY id), u AS (SELECT id, unnest(s) source_id, generate_subscripts(s, 1) pos FROM q), m AS (SELECT id, source_id, min(pos) pos FROM u WHERE source_id IS NOT NULL GROUP BY 1, 2),
      t AS (SELECT id source_id, min(title) title FROM sources GROUP BY 1), n AS (SELECT id, title, pos, row_number() OVER (PARTITION BY id ORDER BY pos) k FROM m JOIN t USING (source_id)) SELECT q.id, coalesce(string_agg(title, '|' ORDER BY pos), '') notes FROM q LEFT JOIN n ON n.id = q.id AND k <= 5 GROUP BY q.id""",
    "q_ranked": """WITH r AS (SELECT review_id, max(decision) decision, max(candidate_score) score, max(arrived_at) came FROM review GROUP BY 1)
      SELECT *, CASE decision WHEN 'pending' THEN 0 WHEN 'approved' THEN 1 WHEN 'staged' THEN 2 ELSE 5 END AS rank FROM r ORDER BY rank, score DESC NULLS LAST, came DESC, review_id LIMIT 50""",
    "q_top_per_provider": """WITH r AS (SELECT candidate_provider, review_id, max(candidate_score) score FROM review WHERE candidate_provider IS NOT NULL GROUP BY 1, 2)
      SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY candidate_provider ORDER BY score DESC NULLS LAST, review_id) <= 5""",
    "q_batches": "SELECT o_orderkey, o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 batch_no FROM orders",
    "q_counts": "SELECT coalesce(candidate_provider, 'unknown') v, count(*) n, 'provider' what FROM review GROUP BY 1 UNION ALL SELECT coalesce(decision, 'unknown'), count(*), 'decision' FROM review GROUP BY 1",
    "q_conditional_counts": """SELECT batch_no, count(*) FILTER (generation_kind = 'source') direct, count(*) FILTER (generation_kind = 'expanded') expanded, count(*) FILTER (recommendation = 'new-draft' AND decision = 'pending') fresh,
      count(*) FILTER (starts_with(source_url, 'local://')) "local", sum(len(string_split(title, '，')))::BIGINT parts FROM review GROUP BY 1""",
    "q_distinct_categories": "SELECT domain, min(added_at) first_at FROM questions WHERE domain IS NOT NULL GROUP BY 1",
    "q_staged_ids": "SELECT candidate_id, string_agg(DISTINCT staged_question_id, '|' ORDER BY staged_question_id) ids FROM review WHERE staged_question_id IS NOT NULL GROUP BY 1",
    "q_repeated_ids": "SELECT id, count(*) n, 'questions' entity FROM questions GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT id, count(*), 'experiences' FROM experiences GROUP BY 1 HAVING count(*) > 1",
    "q_violations": f"""WITH q AS (SELECT DISTINCT ON (id) * FROM questions), e AS (SELECT DISTINCT ON (id) * FROM experiences), v AS (
      SELECT 'questions' entity, unnest(list_filter([CASE WHEN {_BLANK('title')} THEN 'no title' END, CASE WHEN {_BLANK('answer_short')} THEN 'no short answer' END, CASE WHEN {_BLANK('answer_detail')} THEN 'no detail' END,
        CASE WHEN status NOT IN ('source-only', 'ai-draft', 'reviewed', 'verified', 'outdated') THEN 'status' END, CASE WHEN coalesce(len(tags), 0) = 0 THEN 'no tags' END, CASE WHEN status = 'verified' AND coalesce(len(source_ids), 0) = 0 THEN 'verified without source' END,
        CASE WHEN answer_version >= 2 AND length(answer_detail) < 250 THEN 'shallow version 2' END, CASE WHEN len(list_filter(follow_ups, lambda x: NOT x.is_legacy AND {_BLANK('x.answer_short')})) > 0 THEN 'incomplete follow-up' END], lambda x: x IS NOT NULL)) AS rule FROM q
      UNION ALL SELECT 'experiences', unnest(list_filter([CASE WHEN {_BLANK('role')} THEN 'no role' END, CASE WHEN {_BLANK('round')} THEN 'no round' END, CASE WHEN {_BLANK('summary')} THEN 'no summary' END, CASE WHEN source_id IS NULL THEN 'no source' END], lambda x: x IS NOT NULL)) FROM e)
      SELECT entity, rule, count(*) n FROM v GROUP BY ALL""",
    "q_search": "SELECT DISTINCT id, title FROM questions WHERE domain = 'RTOS' AND contains(lower(concat_ws(' ', coalesce(title, ''), coalesce(answer_short, ''), coalesce(answer_detail, ''), domain, coalesce(subtopic, ''), coalesce(array_to_string(tags, ' '), ''))), 'wdt')",
    "q_search_sources": """SELECT DISTINCT id, 'source' what FROM sources WHERE contains(lower(concat_ws(' ', coalesce(title, ''), coalesce(kind, ''), coalesce(url, ''))), '面')
      UNION ALL SELECT DISTINCT id, 'experience' FROM experiences WHERE contains(lower(concat_ws(' ', coalesce(company, '公司未记录'), coalesce(role, ''), coalesce(round, ''), coalesce(summary, ''))), '未记录')""",
    "q_catalogue": "SELECT domain, count(DISTINCT id) questions, (SELECT count(DISTINCT id) FROM experiences) experiences, (SELECT count(DISTINCT id) FROM sources) sources FROM questions GROUP BY domain UNION ALL SELECT '*', count(DISTINCT id), (SELECT count(DISTINCT id) FROM experiences), (SELECT count(DISTINCT id) FROM sources) FROM questions",
    "q_catalogue_lines": "SELECT DISTINCT '{' || array_to_string(list_filter([" + ", ".join(f"""'"{c}":' || to_json({c})::VARCHAR""" for c in ("id", "title", "domain", "subtopic", "difficulty", "tags", "status")) + "], lambda x: x IS NOT NULL), ',') || '}' line FROM questions",
    "q_experience_titles": """WITH e AS (SELECT DISTINCT ON (id) * FROM experiences), u AS (SELECT DISTINCT id experience, source_id, unnest(question_ids) qid FROM e), q AS (SELECT id qid, min(title) question FROM questions GROUP BY 1), s AS (SELECT id source_id, min(title) source FROM sources GROUP BY 1)
      SELECT experience, question, coalesce(source, '-') source FROM u JOIN q USING (qid) LEFT JOIN s USING (source_id)""",
    "q_event_windows": "SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) n, round(sum(value), 4) total FROM events GROUP BY 1, 2",
    "q_first_events": "SELECT user_id, min(ts) first_ts, max(ts) last_ts, arg_max(event_type, {'t': ts, 'i': event_id}) last_type, count(*) n FROM events GROUP BY 1",
    "q_order_lookup": "SELECT n_name, count(*) n, round(sum(o_totalprice), 2) spent FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
    "q_merged_titles": f"""WITH q AS (SELECT id, title, any_value(answer_detail) ad, any_value(tags) tags, min(added_at) tm FROM questions GROUP BY 1, 2), k AS (SELECT *, {_K('title')} AS key FROM q WHERE {_K('title')} <> ''), t AS (SELECT key, count(DISTINCT x) n_tags FROM (SELECT key, unnest(tags) x FROM k) GROUP BY 1)
      SELECT key, count(*) n, max(length(ad)) n_detail, CASE WHEN count(*) > 1 THEN least(8, coalesce(any_value(n_tags), 0)) ELSE coalesce(any_value(n_tags), 0) END n_tags FROM k LEFT JOIN t USING (key) GROUP BY key""",
}
