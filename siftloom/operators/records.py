"""Operators over keyed records: first and best rows, merging by key, lookups, capped selection, reports, validation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import title_key
from ..session import durable


def last_values(rows: DataFrame, by: str, value: str, *order: Column, most: int) -> DataFrame:
    """(by, values): the group's last ``most`` values in order, the latest at the end."""
    backwards = [c.desc() for c in order]
    last = rows.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*backwards))).where(F.col("_n") <= most)
    return last.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("k"), F.col(value).alias("v")))), lambda x: x["v"]).alias("values"))


def run_report(**parts: DataFrame) -> DataFrame:
    """One row of counts: each part is a frame of one row, its columns named after it."""
    return reduce(DataFrame.crossJoin, (df.select(*(F.col(c).alias(f"{name}_{c}") for c in df.columns)) for name, df in parts.items()))


def first_non_empty(c: str, order: str) -> Column:
    """Aggregate: the first value in order that isn't null or empty."""
    full = F.nullif(F.col(c), F.lit(""))
    return F.min_by(full, F.when(full.isNotNull(), F.col(order)))


def longest(c: str, order: str) -> Column:
    """Aggregate: the longest value, the earliest of equals."""
    return F.max_by(c, F.struct(F.length(F.coalesce(c, F.lit(""))), -F.col(order)))


def merged_by_title(rows: DataFrame, title: str, order: str, keep_longest: Sequence[str], tags: str, most_tags: int = 8) -> DataFrame:
    """One row per title_key of the title: the first row's title, the longest of some fields, the tags of all in order, cut only where rows merged."""
    own = rows.withColumn("key", title_key(F.col(title))).where("key <> ''")
    tag = own.select("key", order, F.posexplode(tags).alias("pos", "tag")).groupBy("key", "tag").agg(F.min(F.struct(order, "pos")).alias("at"))
    tag = tag.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "tag"))), lambda x: x["tag"]).alias("all_tags"))
    out = own.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min_by(title, order).alias(title), *(longest(c, order).alias(c) for c in keep_longest))
    cut = F.when(F.col("n") > 1, F.slice("all_tags", 1, most_tags)).otherwise(F.col("all_tags"))
    return out.join(tag, "key", "left").withColumn(tags, F.coalesce(cut, F.array().cast("array<string>"))).drop("all_tags")


def joined_reasons(rows: DataFrame, by: str, c: str, order: str, default: str, limit: int = 600) -> DataFrame:
    """The group's distinct non-empty texts in order, joined and cut; a default for none."""
    one = rows.where(F.col(c) != "").groupBy(by, c).agg(F.min(order).alias("at"))
    some = one.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", c))), lambda x: x[c]), "；").alias(c))
    return rows.select(by).distinct().join(some, by, "left").withColumn(c, F.left(F.coalesce(c, F.lit(default)), F.lit(limit)))


def staged(rows: DataFrame, key: Column, fits: Column, order: str, taken: DataFrame, limit: int) -> DataFrame:
    """Selection in order, up to a limit: rows that fit, whose key isn't taken and is the first of its kind.

    Adds outcome: staged, duplicate (fits, but its key is taken or came before, while there was room), or open. What the
    row-by-row walk decides is a rank among winners, so no row waits for another: a winner's rank, and for a loser the
    number of winners before it, are running counts over sorted ranges.
    """
    own = rows.withColumn("k", key).withColumn("fits", F.coalesce(fits, F.lit(False)))
    known = taken.select(F.col(taken.columns[0]).alias("k")).distinct().withColumn("known", F.lit(True))
    first = own.where("fits").groupBy("k").agg(F.min(order).alias("first"))
    marked = own.join(known, "k", "left").join(first, "k", "left").withColumn("wins", F.col("fits") & F.col("known").isNull() & (F.col(order) == F.col("first")))
    counted = running_count(marked, order, F.col("wins"), "before")
    return counted.withColumn(
        "outcome", F.when(F.col("wins") & (F.col("before") <= limit), "staged").when(F.col("fits") & ~F.col("wins") & (F.col("before") < limit), "duplicate").otherwise("open")
    ).drop("k", "fits", "known", "first", "wins", "before")


def placed(rows: DataFrame, *order: Column, name: str = "place", partitions: int | None = None) -> DataFrame:
    """rows with their place (from 1) in a total order: sorted by ranges, counted within each, the ranges' sizes added, so no task sees all rows.

    The order has to end with a key, so that no two rows share a place. Kept in the shared folder.
    """
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    local = ranged.sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_k", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 1)
    local = durable(local, "placed")
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_base"))  # one row per range
    return local.join(before, "_part").withColumn(name, F.col("_k") + F.col("_base")).drop("_part", "_k", "_base")


def running_count(rows: DataFrame, order: str, test: Column, name: str, key: str | None = None) -> DataFrame:
    """The number of rows up to each row that pass the test, by ``order`` and then by ``key``: counted within ranges of the order, the ranges' sums added, so no task sees all rows.

    Without a key, rows of one order value count together.
    """
    by = [F.col(order)] + ([F.col(key)] if key else [])
    local = durable(rows.withColumn("_t", F.when(test, 1).otherwise(0)).repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "ranged")
    sums = local.groupBy("_part").agg(F.sum("_t").alias("_sum"))
    before = sums.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_base"))  # one row per range
    within = F.sum("_t").over(Window.partitionBy("_part").orderBy(*by).rangeBetween(Window.unboundedPreceding, Window.currentRow) if not key else Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return local.withColumn("_n", within).join(before, "_part").withColumn(name, F.col("_n") + F.col("_base")).drop("_part", "_t", "_n", "_base")


def looked_up(rows: DataFrame, c: str, tables: Sequence[tuple[DataFrame, str, str]], name: str) -> DataFrame:
    """rows with ``name``: the value of the first table that knows the key, from (table, key, value)."""
    known = reduce(DataFrame.unionByName, (t.where(F.col(k).isNotNull()).select(F.col(k).alias(c), F.struct(F.lit(i).alias("i"), F.col(v).alias("v")).alias("x")) for i, (t, k, v) in enumerate(tables)))
    return rows.join(known.groupBy(c).agg(F.min("x").alias("x")), c, "left").withColumn(name, F.col("x.v")).drop("x")


def array_lookup(rows: DataFrame, key: str, items: str, table: DataFrame, on: str, value: str, most: int = 5) -> DataFrame:
    """(key, found): the values of the list's first ``most`` known items, in the list's order."""
    one = rows.select(key, F.posexplode(items).alias("pos", on)).where(F.col(on).isNotNull()).groupBy(key, on).agg(F.min("pos").alias("pos"))
    hit = one.join(table.groupBy(on).agg(F.min(value).alias(value)), on)
    first = hit.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).where(F.col("n") <= most)
    found = first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", value))), lambda x: x[value]).alias("found"))
    return rows.select(key).distinct().join(found, key, "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))


def top(rows: DataFrame, *order: Column, most: int) -> DataFrame:
    return rows.orderBy(*order).limit(most)


def top_per(rows: DataFrame, by: Sequence[str], *order: Column, most: int) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def batched(rows: DataFrame, order: Sequence[Column], size: int, by: Sequence[str] = ()) -> DataFrame:
    """rows with batch_no: consecutive rows of one group in groups of ``size``."""
    return rows.withColumn("batch_no", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / size))


def counts(rows: DataFrame, c: str, missing: str = "unknown") -> DataFrame:
    return rows.groupBy(F.coalesce(c, F.lit(missing)).alias(c)).agg(F.count(F.lit(1)).alias("n"))


def first_seen_values(rows: DataFrame, c: str, order: str) -> DataFrame:
    """Distinct values and where each came first."""
    return rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.min(order).alias("first_at"))


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def violations(rows: DataFrame, entity: str, key: str, rules: dict[str, Column]) -> DataFrame:
    """(entity, id, rule): one row per record and broken rule, in one pass over the records."""
    broken = F.array_compact(F.array(*(F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items())))
    return rows.select(F.lit(entity).alias("entity"), F.col(key).alias("id"), F.explode(broken).alias("rule"))
