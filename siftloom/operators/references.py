"""References to records that are missing, were deleted, or arrived later than the record that names them.

The distinct foreign keys, far fewer than the references, are held against the parents' keys; only the keys found wanting
go back to the references. A key that holds a large part of all references is therefore one row up to that last join,
where the few heaviest keys are broadcast: a key counts as heavy if it holds more than 1/HEAVY of the references, so
there are fewer than HEAVY of them at any size.

Defined cases: a null reference or a null list is no reference; an empty string is a key like any other; references
repeated within a record or by a second delivery count once; an empty parent table makes every reference ``missing``;
an empty child table gives no rows; rows whose own id is null have no identity and are left out; further columns of the
inputs are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import durable

HEAVY = 256


def references(df: DataFrame, tbl: str, field: str, target: str, rec: str = "id", at: str = "added_at") -> DataFrame:
    """(tbl, rec_id, field, target, ref_id, arrival): one row per record and distinct non-null reference."""
    many = dict(df.dtypes)[field].startswith("array")
    rows = df.select(F.col(rec).alias("rec_id"), F.col(at).alias("at"), F.col(field).alias("ref")).where("rec_id IS NOT NULL")
    arrivals = rows.groupBy("rec_id").agg(F.min("at").alias("arrival"))
    refs = rows.select("rec_id", F.explode("ref").alias("ref_id")) if many else rows.select("rec_id", F.col("ref").alias("ref_id"))
    return (
        refs.where("ref_id IS NOT NULL")
        .distinct()
        .join(arrivals, "rec_id")
        .select(F.lit(tbl).alias("tbl"), "rec_id", F.lit(field).alias("field"), F.lit(target).alias("target"), "ref_id", "arrival")
    )


def parents(df: DataFrame, target: str, key: str = "id", at: str = "added_at", deleted: str = "deleted_at") -> DataFrame:
    """(target, ref_id, since, gone): one row per key that exists."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.lit(target).alias("target"), F.col(key).alias("ref_id"))
        .agg(F.min(at).alias("since"), F.max(F.col(deleted).isNotNull()).alias("gone"))
    )


def dangling(refs: DataFrame, known: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(tbl, rec_id, field, ref_id, arrival, reason) of the references that don't hold.

    refs are read twice, so give them as a written table where they are long to make.
    """
    on = ["target", "ref_id"]
    keys = durable(refs.groupBy(on).agg(F.count(F.lit(1)).alias("uses"), F.min("arrival").alias("first_use")), "keys")
    missing = keys.join(known, on, "left_anti").select(*on, "uses", F.lit("missing").alias("verdict"), F.lit(None).cast("timestamp_ntz").alias("since"))
    wanting = (
        keys.join(known, on)
        .where("gone OR since > first_use")
        .select(*on, "uses", F.when(F.col("gone"), "deleted").otherwise("late").alias("verdict"), "since")
    )
    bad = durable(missing.unionByName(wanting), "wanting")
    total = keys.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    hot = bad.where(F.col("uses") > total / heavy).drop("uses")
    back = refs.join(bad.where(F.col("uses") <= total / heavy).drop("uses"), on)
    if not hot.isEmpty():
        back = back.unionByName(refs.join(F.broadcast(hot), on))
    return back.where("verdict <> 'late' OR since > arrival").select("tbl", "rec_id", "field", "ref_id", "arrival", F.col("verdict").alias("reason"))


def dangling_report(refs: DataFrame, found: DataFrame) -> DataFrame:
    """(tbl, field, period, n_refs, n_missing, n_deleted, n_late) per month of the referring record's arrival."""
    period = F.date_format("arrival", "yyyy-MM").alias("period")
    n = lambda reason: F.count_if(F.col("reason") == reason).alias(f"n_{reason}")
    everything = refs.groupBy("tbl", "field", period).agg(F.count(F.lit(1)).alias("n_refs"))
    wrong = found.groupBy("tbl", "field", period).agg(n("missing"), n("deleted"), n("late"))
    return everything.join(wrong, ["tbl", "field", "period"], "left").fillna(0)
