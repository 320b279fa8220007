"""Queries on the joins, selections and orders of a run over keyed records, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..functions.structs import issues_of, priority_of
from ..operators import records as R
from ..operators.matching import best_similar
from ..operators.state import due, stale, unchanged
from ..session import table

NOW = "TIMESTAMP_NTZ '2026-03-01 12:00:00'"
PRIORITY = {"missing_ai_review": 0, "legacy_follow_up": 1, "main_answer_detail": 2, "main_answer_short": 3}


def _now() -> Column:
    return F.expr(f"CAST({NOW} AS TIMESTAMP)")


def _first(rows: DataFrame, key: str, *columns: str, order: str = "added_at") -> DataFrame:
    """The earliest delivery of each key, the least values of equal times."""
    return rows.groupBy(key).agg(F.min(F.struct(order, *columns)).alias("x")).select(key, "x.*")


def _reviews(spark: SparkSession, d: str) -> DataFrame:
    return _first(table(spark, d, "review"), "review_id", "batch_no", "decision", "recommendation", "duplicate_score", "candidate_score", "candidate_id", "title", "domain", "source_url", "staged_question_id", "candidate_provider", order="arrived_at")


def q_review_order(spark: SparkSession, d: str) -> DataFrame:
    """The place of every review: pending ones first, new drafts before the rest, the least similar, then the best candidates; in order of arrival where all is equal."""
    r = _reviews(spark, d)
    order = [F.coalesce("decision", F.lit("pending")) != "pending", F.coalesce("recommendation", F.lit("")) != "new-draft", F.coalesce("duplicate_score", F.lit(0.0)), -F.coalesce("candidate_score", F.lit(0)), F.col("arrived_at"), F.col("review_id")]
    return R.placed(r, *order).select("review_id", F.col("place").cast("bigint").alias("place"))


def q_refinement_order(spark: SparkSession, d: str) -> DataFrame:
    """The 50 questions to work over first: the most urgent code, the most codes, the oldest version, the shortest answer."""
    q = _first(table(spark, d, "questions"), "id", "answer_short", "answer_detail", "answer_version", "follow_ups", "pitfalls", "generation_kind")
    codes = issues_of(F.col("answer_short"), F.col("answer_detail"), F.col("answer_version"), F.col("follow_ups"), F.size("pitfalls"), F.col("generation_kind") == "source")
    own = q.select("id", F.col("answer_version").alias("version"), F.length(F.coalesce("answer_detail", F.lit(""))).alias("n"), codes.alias("codes")).where("size(codes) > 0")
    own = own.select("id", priority_of(F.col("codes"), PRIORITY).alias("priority"), F.size("codes").alias("n_codes"), "version", "n")
    return R.top(own, F.col("priority"), F.col("n_codes").desc(), F.col("version"), F.col("n"), F.col("id"), most=50)


def q_seed_order(spark: SparkSession, d: str) -> DataFrame:
    """The 40 candidates to start from: the best score, then the first seen."""
    c = table(spark, d, "review").groupBy("source_url").agg(F.max("candidate_score").alias("score"), F.min("arrived_at").alias("first_seen"))
    return R.top(c, F.col("score").desc_nulls_last(), F.col("first_seen"), F.col("source_url"), most=40)


def q_latest_made(spark: SparkSession, d: str) -> DataFrame:
    """The 100 records made last, and the 100 candidates by score alone."""
    q = _first(table(spark, d, "questions"), "id", "title")
    c = table(spark, d, "review").groupBy("candidate_id").agg(F.max("candidate_score").alias("score"), F.min("arrived_at").alias("came"))
    made = R.top(q, F.col("added_at").desc(), F.col("id"), most=100).select(F.lit("made").alias("what"), "id")
    best = R.top(c, F.col("score").desc_nulls_last(), F.col("came"), F.col("candidate_id"), most=100).select(F.lit("scored").alias("what"), F.col("candidate_id").alias("id"))
    return made.unionByName(best)


def q_due_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of sources with the last time that a review came from them, and whether they are due again."""
    s = table(spark, d, "sources").where("url IS NOT NULL").select("url").distinct()
    seen = table(spark, d, "review").groupBy(F.col("source_url").alias("url")).agg(F.max("arrived_at").alias("seen"))
    own = s.join(seen, "url", "left")
    return own.select("url", "seen", due(F.col("seen").cast("timestamp"), _now(), 30).alias("due"))


def q_pending(spark: SparkSession, d: str) -> DataFrame:
    """The first 30 sources whose experiences are to be made anew: none yet, or withdrawn, failed or old."""
    s = table(spark, d, "sources").groupBy("id").agg(F.min("added_at").alias("came"), F.max("deleted_at").alias("gone"))
    e = table(spark, d, "experiences").groupBy(F.col("source_id").alias("id")).agg(F.max("added_at").alias("made"), F.min(F.coalesce(F.length("company"), F.lit(0))).alias("least"))
    own = s.join(e, "id", "left")
    again = stale(F.col("made").isNotNull(), F.coalesce(F.col("gone") > F.col("made"), F.lit(False)), F.col("made").cast("timestamp"), F.coalesce(F.col("least") == 0, F.lit(False)), _now(), 3, 400)
    return R.top(own.where(again), F.col("came"), F.col("id"), most=30).select("id", "came", F.col("made").isNull().alias("new"))


def q_carried_over(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the last batches with what an earlier delivery decided, a provider and a score in place of missing ones."""
    r = table(spark, d, "review").select("review_id", "batch_no", "arrived_at", "decision", "staged_question_id", "candidate_provider", "candidate_score", "source_url")
    old = r.where("batch_no <= 20").groupBy("review_id").agg(F.max(F.struct("arrived_at", "batch_no", "decision", "staged_question_id")).alias("p"))
    new = r.where("batch_no > 20").select("review_id", "batch_no", "arrived_at", "candidate_provider", "candidate_score", "source_url").distinct()
    return new.join(old, "review_id", "left").select(
        "review_id", "batch_no", "arrived_at", F.coalesce("p.decision", F.lit("pending")).alias("decision"), F.coalesce("p.staged_question_id", F.lit("-")).alias("staged"),
        F.coalesce("candidate_provider", F.regexp_extract("source_url", "^[a-z]+", 0)).alias("provider"), F.coalesce("candidate_score", F.lit(0)).alias("score"),
    )


def q_status_update(spark: SparkSession, d: str) -> DataFrame:
    """Candidates, marked as promoted where one of their reviews is staged."""
    r = table(spark, d, "review")
    staged = r.where("decision = 'staged'").select("candidate_id").distinct().withColumn("hit", F.lit(True))
    c = r.groupBy("candidate_id").agg(F.min("arrived_at").alias("first_seen"))
    return c.join(staged, "candidate_id", "left").select("candidate_id", "first_seen", F.when(F.col("hit"), "promoted").otherwise("discovered").alias("status"))


def q_first_review(spark: SparkSession, d: str) -> DataFrame:
    """Each candidate's first review."""
    r = table(spark, d, "review").groupBy("candidate_id").agg(F.min(F.struct("arrived_at", "review_id", "title", "decision")).alias("x"))
    return r.select("candidate_id", "x.review_id", "x.title", "x.decision")


def q_batch_drafts(spark: SparkSession, d: str) -> DataFrame:
    """The staged ids of each batch and what became of them: the question there is, or a failure."""
    b = table(spark, d, "review").where("staged_question_id IS NOT NULL").select("batch_no", F.col("staged_question_id").alias("id")).distinct()
    q = table(spark, d, "questions").groupBy("id").agg(F.max("answer_version").alias("version"))
    return b.join(q, "id", "left").select("batch_no", "id", F.when(F.col("version").isNull(), "missing from the response").otherwise("-").alias("failure"), F.coalesce("version", F.lit(0)).alias("version"))


def q_outline_state(spark: SparkSession, d: str) -> DataFrame:
    """Outlines (title and domain of reviews) done or pending, by whether a question answers them; those without a title or of an unknown domain are left out."""
    o = table(spark, d, "review").where("trim(coalesce(title, '')) <> '' AND trim(coalesce(question_evidence, '')) <> ''").select("batch_no", T.stable_id(T.match_key(F.col("title")), "outline").alias("key")).distinct()
    a = table(spark, d, "questions").select(T.stable_id(T.match_key(F.col("title")), "outline").alias("key"))
    done = o.join(a.distinct(), "key", "left_semi").groupBy("batch_no").agg(F.count(F.lit(1)).alias("done"))
    pending = unchanged(o, a, ["key"]).groupBy("batch_no").agg(F.count(F.lit(1)).alias("pending"))
    return done.join(pending, "batch_no", "full_outer").fillna(0)


def q_run_report(spark: SparkSession, d: str) -> DataFrame:
    """One row about a run: what came, what there is, what failed."""
    r, s, q = (table(spark, d, t) for t in ("review", "sources", "questions"))
    return R.run_report(
        review=r.agg(F.count_distinct("review_id").alias("records"), F.count(F.lit(1)).alias("deliveries"), F.count_if(F.col("question_evidence").isNull()).alias("without_evidence")),
        sources=s.agg(F.count_distinct("id").alias("records"), F.count_if(F.col("url").isNull()).alias("without_address")),
        questions=q.agg(F.count_distinct("id").alias("records"), F.count_if(F.coalesce(F.trim("answer_detail"), F.lit("")) == "").alias("failed")),
    )


def q_last_titles(spark: SparkSession, d: str) -> DataFrame:
    """The last 20 titles of each domain, as the context of the next call."""
    q = _first(table(spark, d, "questions"), "id", "domain", "title")
    return R.last_values(q, "domain", "title", F.col("added_at"), F.col("id"), most=20).select("domain", F.array_join("values", "|").alias("titles"), F.size("values").alias("n"))


def q_staged_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of each review when they are walked in order: staged, a duplicate, or still open; at most 200 are staged."""
    r = R.placed(_reviews(spark, d).select("review_id", "arrived_at", "decision", "title"), F.col("arrived_at"), F.col("review_id"))
    fits = F.col("decision").isin("pending", "approved") & (F.length("title") >= 4)
    taken = table(spark, d, "questions").select(T.match_key(F.col("title")).alias("k"))
    return R.staged(r, T.match_key(F.col("title")), fits, "place", taken, 200).select("review_id", F.col("place").cast("bigint").alias("place"), "outcome")


def q_merged_results(spark: SparkSession, d: str) -> DataFrame:
    """Questions merged by the letters and numbers of their titles: the first title, the longest answer, the tags of all; generated ones without an answer to stand on are left out."""
    q = table(spark, d, "questions").groupBy("id", "title").agg(F.min(F.struct("added_at", "generation_kind", "answer_detail", "tags")).alias("x")).select("id", "title", "x.*")
    fine = ~((F.coalesce("generation_kind", F.lit("")) != "source") & (F.trim(F.coalesce("answer_detail", F.lit(""))) == ""))
    placed = R.placed(q.where(fine), F.col("added_at"), F.col("id"), F.col("title"), name="ord")
    m = R.merged_by_title(placed, "title", "ord", ["answer_detail"], "tags")
    return m.select("key", "n", "title", F.coalesce(F.length("answer_detail"), F.lit(0)).alias("n_detail"), F.array_join("tags", "|").alias("tags"))


def q_resume(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of documents still to be worked on: those whose content and number no document loaded before has."""
    size = 500
    p = table(spark, d, "documents").select("doc_id", "loaded_at", F.sha2("text", 256).alias("print"), F.posexplode(F.sequence(F.lit(0), F.floor((F.greatest(F.length("text"), F.lit(1)) - 1) / size).cast("int"))).alias("k", "chunk"))
    cut = F.lit("2026-01-01").cast("timestamp_ntz")
    done = p.where(F.col("loaded_at") < cut)
    return unchanged(p.where(F.col("loaded_at") >= cut), done, ["print", "chunk"]).select("doc_id", "chunk")


def q_question_payload(spark: SparkSession, d: str) -> DataFrame:
    """What a call about a question is given: bounded fields and the titles of up to five sources."""
    q = _first(table(spark, d, "questions"), "id", "title", "domain", "answer_short", "answer_detail", "source_ids")
    s = table(spark, d, "sources").groupBy(F.col("id").alias("source_id")).agg(F.min("title").alias("title"))
    notes = R.array_lookup(q, "id", "source_ids", s, "source_id", "title")
    return q.join(notes, "id").select("id", T.bounded(F.col("title"), 240).alias("title"), T.bounded(F.col("domain"), 60).alias("domain"), T.bounded(F.col("answer_short"), 1000).alias("short"), T.bounded_lines(F.col("answer_detail"), 7000).alias("detail"), F.array_join("found", "|").alias("notes"))


def q_best_similar(spark: SparkSession, d: str) -> DataFrame:
    """The best match of each source's title among those before it and all questions, by sequence or by bigrams."""
    s = table(spark, d, "sources").groupBy("id", "title").agg(F.min("added_at").alias("at"))
    one = s.groupBy("id").agg(F.min(F.struct("at", "title")).alias("x")).select("id", "x.title", F.unix_micros(F.col("x.at").cast("timestamp")).alias("ord"))
    known = table(spark, d, "questions").select("id", "title").distinct()
    return best_similar(one, known).select("id", F.round("score", 6).alias("score"), "rounded", "match_id", "match_title")


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("q_")}

_K = lambda c: f"lower(regexp_replace(coalesce({c}, ''), '[^0-9a-zA-Z\\x{{4e00}}-\\x{{9fff}}]+', '', 'g'))"
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_SQ = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '{_WS}', ' ', 'g'), ' ')"
_NOW = "TIMESTAMP '2026-03-01 12:00:00'"
_AGE = lambda c: f"floor((epoch_us({_NOW}) - epoch_us({c})) / 86400000000)"
_ROWS = lambda cols: ", ".join(f"'{c}': {c}" for c in cols)
_R = f"(SELECT review_id, unnest(min({{{_ROWS(['arrived_at', 'batch_no', 'decision', 'recommendation', 'duplicate_score', 'candidate_score', 'candidate_id', 'title'])}}})) FROM review GROUP BY review_id)"
SQL = {
    "q_review_order": f"""SELECT review_id, row_number() OVER (ORDER BY coalesce(decision, 'pending') <> 'pending', coalesce(recommendation, '') <> 'new-draft', coalesce(duplicate_score, 0), -coalesce(candidate_score, 0), arrived_at, review_id) place FROM {_R}""",
    "q_refinement_order": """WITH q AS (SELECT DISTINCT ON (id) * FROM questions ORDER BY id, added_at, answer_short NULLS FIRST, answer_detail NULLS FIRST), c AS (SELECT id, answer_version AS "version", length(coalesce(answer_detail, '')) n, list_filter([CASE WHEN generation_kind <> 'source' THEN 'missing_ai_review' END, CASE WHEN coalesce(answer_version, 0) < 2 THEN 'v' END,
      CASE WHEN length(trim(coalesce(answer_short, ''))) < 60 THEN 'main_answer_short' END, CASE WHEN length(trim(coalesce(answer_detail, ''))) < 400 THEN 'main_answer_detail' END, CASE WHEN coalesce(len(follow_ups), 0) < 3 THEN 'b' END,
      CASE WHEN len(list_filter(follow_ups, lambda x: x.is_legacy)) > 0 THEN 'legacy_follow_up' END, CASE WHEN len(list_filter(follow_ups, lambda x: NOT x.is_legacy AND length(trim(coalesce(x.answer_short, ''))) < 40)) > 0 THEN 'f' END, CASE WHEN coalesce(len(pitfalls), 0) < 2 THEN 'p' END], lambda x: x IS NOT NULL) codes FROM q),
      p AS (SELECT id, list_min(list_transform(codes, lambda x: CASE x WHEN 'missing_ai_review' THEN 0 WHEN 'legacy_follow_up' THEN 1 WHEN 'main_answer_detail' THEN 2 WHEN 'main_answer_short' THEN 3 ELSE 9 END)) priority, len(codes) n_codes, "version", n FROM c WHERE len(codes) > 0)
      SELECT * FROM p ORDER BY priority, n_codes DESC, "version", n, id LIMIT 50""",
    "q_seed_order": "SELECT source_url, max(candidate_score) score, min(arrived_at) first_seen FROM review GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 3, 1 LIMIT 40",
    "q_latest_made": """SELECT * FROM (SELECT 'made' what, id FROM (SELECT id, min(added_at) tm FROM questions GROUP BY 1) ORDER BY tm DESC, id LIMIT 100)
      UNION ALL SELECT * FROM (SELECT 'scored', candidate_id FROM (SELECT candidate_id, max(candidate_score) s, min(arrived_at) tm FROM review GROUP BY 1) ORDER BY s DESC NULLS LAST, tm, candidate_id LIMIT 100)""",
    "q_due_addresses": f"WITH s AS (SELECT DISTINCT url FROM sources WHERE url IS NOT NULL), r AS (SELECT source_url url, max(arrived_at) seen FROM review GROUP BY 1) SELECT url, seen, seen IS NULL OR {_AGE('seen')} >= 30 due FROM s LEFT JOIN r USING (url)",
    "q_pending": f"""WITH s AS (SELECT id, min(added_at) came, max(deleted_at) gone FROM sources GROUP BY 1), e AS (SELECT source_id id, max(added_at) made, min(coalesce(length(company), 0)) least FROM experiences GROUP BY 1)
      SELECT id, came, made IS NULL AS "new" FROM s LEFT JOIN e USING (id) WHERE made IS NULL OR coalesce(gone > made, false) OR (least = 0 AND {_AGE('made')} >= 3) OR {_AGE('made')} >= 400 ORDER BY came, id LIMIT 30""",
    "q_carried_over": """WITH o AS (SELECT DISTINCT ON (review_id) review_id, decision, staged_question_id FROM review WHERE batch_no <= 20 ORDER BY review_id, arrived_at DESC, batch_no DESC, decision DESC NULLS LAST, staged_question_id DESC NULLS LAST),
      n AS (SELECT DISTINCT review_id, batch_no, arrived_at, candidate_provider, candidate_score, source_url FROM review WHERE batch_no > 20)
      SELECT review_id, batch_no, arrived_at, coalesce(o.decision, 'pending') decision, coalesce(staged_question_id, '-') staged, coalesce(candidate_provider, regexp_extract(source_url, '^[a-z]+')) provider, coalesce(candidate_score, 0) score FROM n LEFT JOIN o USING (review_id)""",
    "q_status_update": "SELECT candidate_id, min(arrived_at) first_seen, CASE WHEN bool_or(coalesce(decision, '') = 'staged') THEN 'promoted' ELSE 'discovered' END status FROM review GROUP BY 1",
    "q_first_review": "SELECT candidate_id, review_id, title, decision FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY arrived_at, review_id, title, decision NULLS FIRST) k FROM (SELECT DISTINCT candidate_id, arrived_at, review_id, title, decision FROM review)) WHERE k = 1",
    "q_batch_drafts": """WITH q AS (SELECT id, max(answer_version) v FROM questions GROUP BY 1) SELECT DISTINCT batch_no, staged_question_id id, CASE WHEN v IS NULL THEN 'missing from the response' ELSE '-' END failure, coalesce(v, 0) AS "version" FROM review LEFT JOIN q ON q.id = staged_question_id WHERE staged_question_id IS NOT NULL""",
    "q_outline_state": f"""WITH o AS (SELECT DISTINCT batch_no, {_K('title')} k FROM review WHERE trim(coalesce(title, '')) <> '' AND trim(coalesce(question_evidence, '')) <> ''), a AS (SELECT DISTINCT {_K('title')} k FROM questions)
      SELECT batch_no, count(a.k) done, count(*) - count(a.k) pending FROM o LEFT JOIN a USING (k) GROUP BY 1""",
    "q_run_report": """SELECT (SELECT count(DISTINCT review_id) FROM review) review_records, (SELECT count(*) FROM review) review_deliveries, (SELECT count(*) FROM review WHERE question_evidence IS NULL) review_without_evidence, (SELECT count(DISTINCT id) FROM sources) sources_records,
      (SELECT count(*) FROM sources WHERE url IS NULL) sources_without_address, (SELECT count(DISTINCT id) FROM questions) questions_records, (SELECT count(*) FROM questions WHERE trim(coalesce(answer_detail, '')) = '') questions_failed""",
    "q_last_titles": """WITH q AS (SELECT id, unnest(min({'added_at': added_at, 'domain': domain, 'title': title})) FROM questions GROUP BY id), k AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY added_at DESC, id DESC) n FROM q)
      SELECT domain, string_agg(title, '|' ORDER BY n DESC) titles, count(*) n FROM k WHERE n <= 20 GROUP BY domain""",
    "q_staged_outcomes": f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY arrived_at, review_id) place, {_K('title')} k, coalesce(decision IN ('pending', 'approved') AND length(title) >= 4, false) fits FROM {_R}), t AS (SELECT DISTINCT {_K('title')} k, true known FROM questions),
      w AS (SELECT r.*, fits AND known IS NULL AND row_number() OVER (PARTITION BY r.k, fits ORDER BY place) = 1 wins FROM r LEFT JOIN t ON t.k = r.k), c AS (SELECT *, count(*) FILTER (wins) OVER (ORDER BY place) b FROM w)
      SELECT review_id, place, CASE WHEN wins AND b <= 200 THEN 'staged' WHEN fits AND NOT wins AND b < 200 THEN 'duplicate' ELSE 'open' END outcome FROM c""",
    "q_merged_results": r"""WITH q AS (SELECT id, title, unnest(min({'added_at': added_at, 'generation_kind': generation_kind, 'answer_detail': answer_detail, 'tags': tags})) FROM questions GROUP BY id, title), f AS (SELECT *, row_number() OVER (ORDER BY added_at, id, title) ord, lower(regexp_replace(title, '[^\p{L}\p{N}_]+', '', 'g')) AS key FROM q WHERE NOT (coalesce(generation_kind, '') <> 'source' AND trim(coalesce(answer_detail, '')) = '')),
      u AS (SELECT key, ord, unnest(tags) tag, generate_subscripts(tags, 1) pos FROM f), d AS (SELECT key, tag, min(ord * 1000 + pos) tm FROM u GROUP BY ALL), l AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY tm) k FROM d),
      m AS (SELECT key, count(*) n, arg_min(title, ord) title, max(coalesce(length(answer_detail), 0)) n_detail FROM f WHERE key <> '' GROUP BY key)
      SELECT m.key, n, title, n_detail, coalesce((SELECT string_agg(tag, '|' ORDER BY k) FROM l WHERE l.key = m.key AND (n = 1 OR k <= 8)), '') tags FROM m""",
    "q_resume": """WITH p AS (SELECT doc_id, loaded_at, sha256(text) f, unnest(range((greatest(length(text), 1) - 1) // 500 + 1)) chunk FROM documents)
      SELECT doc_id, chunk FROM p WHERE loaded_at >= TIMESTAMP '2026-01-01' AND NOT EXISTS (SELECT 1 FROM p o WHERE o.loaded_at < TIMESTAMP '2026-01-01' AND o.f = p.f AND o.chunk = p.chunk)""",
    "q_question_payload": f"""WITH q AS (SELECT id, unnest(min({{'added_at': added_at, 'title': title, 'domain': domain, 'answer_short': answer_short, 'answer_detail': answer_detail, 'source_ids': source_ids}})) FROM questions GROUP BY id), u AS (SELECT id, unnest(source_ids) source_id, generate_subscripts(source_ids, 1) pos FROM q),
      m AS (SELECT id, source_id, min(pos) pos FROM u WHERE source_id IS NOT NULL GROUP BY 1, 2), t AS (SELECT id source_id, min(title) title FROM sources GROUP BY 1), n AS (SELECT id, title, pos, row_number() OVER (PARTITION BY id ORDER BY pos) k FROM m JOIN t USING (source_id)), w AS (SELECT id, string_agg(title, '|' ORDER BY pos) notes FROM n WHERE k <= 5 GROUP BY 1)
      SELECT id, left({_SQ('title')}, 240) title, left({_SQ('domain')}, 60) AS domain, left({_SQ('answer_short')}, 1000) short, left(array_to_string(list_filter(list_transform(string_split(replace(coalesce(answer_detail, ''), chr(13), ''), chr(10)), lambda x: left({_SQ('x')}, 7000)), lambda x: x <> ''), chr(10)), 7000) detail, coalesce(notes, '') notes FROM q LEFT JOIN w USING (id)""",
}
