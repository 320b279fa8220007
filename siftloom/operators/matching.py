"""The best earlier match of each title, and all similar keys by an exact prefix filter.

Titles are compared by distinct match key, so repeated titles meet once. The best match is searched by bits of the sets (``nearest``),
without a row for a pair: the pairs over a threshold grow as the square of the titles. For all pairs (``similar_keys``) bigrams are
ranked by how rare they are; two keys of Jaccard similarity t or more share a bigram among the first size - ceil(t size) + 1
of each, so an equi-join of these prefixes misses none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import bigrams, jaccard, likeness, match_key
from ..session import durable
from .nearest import nearest

SAME = 0.62


def same_set(key: str) -> Column:
    """The bigrams of a key in order, as one text: keys of the same bigrams have the same."""
    return F.array_join(F.array_sort(bigrams(F.col(key))), "")


def similar_keys(keys: DataFrame, least: float = SAME) -> DataFrame:
    """From distinct (key): (a, b, score) of different keys of Jaccard similarity ``least`` or more, both ways."""
    own = keys.select("key", bigrams(F.col("key")).alias("grams"))
    rank = own.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    ranked = own.select("key", F.explode("grams").alias("gram")).join(rank, "gram").groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "gram"))), lambda x: x["gram"]).alias("grams"))
    need = lambda size: (size - F.ceil(F.lit(least) * size - 1e-9) + 1).cast("int")
    posts = ranked.select("key", F.size("grams").alias("size"), F.explode(F.slice("grams", F.lit(1), need(F.size("grams")))).alias("gram"))
    a, b = posts.alias("a"), posts.alias("b")
    near = F.least("a.size", "b.size") >= F.lit(least) * F.greatest("a.size", "b.size") - 1e-9
    pairs = a.join(b, (F.col("a.gram") == F.col("b.gram")) & (F.col("a.key") < F.col("b.key")) & near).select(F.col("a.key").alias("a"), F.col("b.key").alias("b")).distinct()
    scored = pairs.withColumn("score", jaccard(bigrams(F.col("a")), bigrams(F.col("b")))).where(F.col("score") >= least)
    return scored.unionByName(scored.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))


def best_earlier(rows: DataFrame, key: str, title: str, order: str, least: float = SAME) -> DataFrame:
    """(key, match_id, score): of the rows that come earlier, the one of the greatest similarity, then the greatest id.

    Rows without an earlier match of ``least`` or more are left out. A key held by many rows is reduced to its earliest row
    for the question whether it comes before, and to its greatest earlier id by a running maximum.
    """
    own = rows.where(F.col(order).isNotNull()).select(F.col(key).alias("id"), F.col(order).alias("ord"), F.col(order).cast("long").alias("at"), match_key(F.col(title)).alias("key"))
    own = durable(own.withColumn("key", F.min("key").over(Window.partitionBy(same_set("key")))), "own")
    before = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    held = durable(own.groupBy("key", "at").agg(F.max("id").alias("k_id")).withColumn("match_id", F.max("k_id").over(before)).withColumn("later", F.count(F.lit(1)).over(before) > 0), "held")
    known = held.where("NOT later OR match_id IS NULL OR k_id > match_id").select("key", F.col("at").alias("ord"), "k_id")
    far = nearest(held.where("NOT later").select("key", F.col("at").alias("ord")), known, ["k_id"], least, False)
    found = far.select("key", F.col("ord").alias("at"), "score", F.col("k_id").alias("match_id")).unionByName(held.where("later").select("key", "at", F.lit(1.0).alias("score"), "match_id"))
    best = own.join(found, ["key", "at"]).groupBy("id", "ord").agg(F.max(F.struct("score", "match_id")).alias("x"))
    return best.select(F.col("id").alias(key), F.col("ord").alias(order), "x.match_id", "x.score")


def best_similar(rows: DataFrame, known: DataFrame, least: float = SAME) -> DataFrame:
    """(id, score, match_id, match_title, rounded): for each row (id, title, ord) the most similar of the known (id, title) and of the rows before it.

    Similarity is the greater of the sequence ratio (the row first) and of the Jaccard similarity of bigrams, over match keys; equal
    ones go to the greatest id, then title. Rows without a match of ``least`` or more are left out. Every row that comes before counts,
    whatever became of it, so no row waits for another. Keys meet once, however many rows have them.
    """
    own = rows.select("id", "title", F.col("ord").cast("long").alias("ord"), match_key(F.col("title")).alias("key"))
    held = own.unionByName(known.select("id", "title", F.lit(None).cast("long").alias("ord"), match_key(F.col("title")).alias("key")))
    record = F.struct(F.col("id").cast("string").alias("id"), "title")
    held = durable(held.groupBy("key", "ord").agg(F.max(record).alias("r")).withColumn("set", same_set("key")), "held")
    before = lambda by: Window.partitionBy(by).orderBy(F.col("ord").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    # Rows after one of the same bigrams have no better match than these: only the others ask.
    sets = held.groupBy("set", "ord").agg(F.max("r").alias("r")).withColumn("found", F.max("r").over(before("set"))).where("ord IS NOT NULL").select("set", "ord", "found")
    asked = durable(held.where("ord IS NOT NULL").select("set", "key", "ord").join(sets, ["set", "ord"]), "asked")
    records = held.withColumn("found", F.max("r").over(before("key"))).where("found IS NULL OR r > found").select("key", "ord", "r.id", "r.title")
    far = nearest(asked.where("found IS NULL").select("key", "ord"), records, ["id", "title"], least, True)
    found = far.select("key", "ord", "score", F.col("id").alias("match_id"), F.col("title").alias("match_title")).unionByName(asked.where("found IS NOT NULL").select("key", "ord", F.lit(1.0).alias("score"), F.col("found.id").alias("match_id"), F.col("found.title").alias("match_title")))
    best = own.select("id", "key", "ord").join(found, ["key", "ord"]).groupBy("id").agg(F.max(F.struct("score", "match_id", "match_title")).alias("x"))
    return best.select("id", "x.*", F.round("x.score", 4).alias("rounded"))


def with_ratio(pairs: DataFrame, candidate: str, known: str) -> DataFrame:
    """pairs with ratio (of the sequence, candidate first) and similarity, the greater of it and the Jaccard similarity, and its rounding to four places.

    Pairs of the same keys come to the same task and are compared once a batch.
    """
    keyed = pairs.withColumns({"_a": match_key(F.col(candidate)), "_b": match_key(F.col(known))})
    keyed = keyed.repartition(2 * pairs.sparkSession.sparkContext.defaultParallelism, "_a", "_b")
    out = keyed.withColumn("_x", likeness("_a", "_b")).withColumns({"jaccard": F.col("_x.jaccard"), "ratio": F.col("_x.ratio")}).drop("_a", "_b", "_x")
    return out.withColumn("similarity", F.greatest("jaccard", "ratio")).withColumn("rounded", F.round("similarity", 4))


def theta_best(rows: DataFrame, known: DataFrame, key: Column) -> DataFrame:
    """(id, score, match_id) of the greatest similarity at any height, for a bounded set ``rows`` against all of ``known`` by shared bigrams."""
    a = rows.select("id", key.alias("key")).select("id", bigrams(F.col("key")).alias("x"))
    b = known.select(F.col("id").alias("k_id"), key.alias("key")).select("k_id", bigrams(F.col("key")).alias("y"))
    size_a, size_b = a.select("id", F.size("x").alias("sa")), b.select("k_id", F.size("y").alias("sb"))
    shared = a.select("id", F.explode("x").alias("g")).join(b.select("k_id", F.explode("y").alias("g")), "g").where("id <> k_id").groupBy("id", "k_id").agg(F.count(F.lit(1)).alias("both"))
    scored = shared.join(size_a, "id").join(size_b, "k_id").withColumn("score", F.col("both") / (F.col("sa") + F.col("sb") - F.col("both")))
    return scored.groupBy("id").agg(F.max(F.struct("score", "k_id")).alias("x")).select("id", "x.score", F.col("x.k_id").alias("match_id"))
