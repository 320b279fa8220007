"""State that outlives a run: upserts with sticky fields, and what is due again.

A key delivered by many rows is one row before the join, by a partial aggregate, so a hot key costs no more there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def latest(rows: DataFrame, key: str, order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """(key, payload...) of the last row of each key; null and empty keys fall away."""
    best = rows.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).groupBy(key).agg(F.max(F.struct(*order, *(c for c in payload if c not in order))).alias("x"))
    return best.select(key, *(F.col(f"x.{c}").alias(c) for c in payload))


def upsert(previous: DataFrame, new: DataFrame, key: str, order: Sequence[str], payload: Sequence[str], seen: str, sticky: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """previous (key, payload..., first_seen, last_seen) with new rows (key, payload..., seen) worked in.

    The last arrival gives the payload; the first sight stays; a sticky field keeps one of the named values once it has it;
    keys that don't arrive stay as they are.
    """
    n = latest(new, key, order, payload).select(key, *(F.col(c).alias(f"n_{c}") for c in payload), F.lit(True).alias("came"))
    times = new.groupBy(key).agg(F.min(seen).alias("n_first"), F.max(seen).alias("n_last"))
    p = previous.select(key, *(F.col(c).alias(f"p_{c}") for c in payload), F.col("first_seen").alias("p_first"), F.col("last_seen").alias("p_last"))
    both = p.join(n.join(times, key), key, "full_outer")
    field = lambda c: F.when(F.col("came"), F.col(f"n_{c}")).otherwise(F.col(f"p_{c}"))
    kept = {c: F.when(F.col(f"p_{c}").isin(*sticky[1]), F.col(f"p_{c}")).otherwise(field(c)) if sticky and c == sticky[0] else field(c) for c in payload}
    return both.select(key, *(v.alias(c) for c, v in kept.items()), F.coalesce("p_first", "n_first").alias("first_seen"), F.coalesce("n_last", "p_last").alias("last_seen"))


def age_days(then: Column, now: Column) -> Column:
    """Whole days from then to now, towards the past."""
    return F.floor((F.unix_micros(now) - F.unix_micros(then)) / 86_400_000_000)


def due(checked: Column, now: Column, every: int) -> Column:
    """Never checked, no readable time, no interval, or that many days ago."""
    return checked.isNull() | F.lit(every <= 0) | (age_days(checked, now) >= every)


def stale(known: Column, changed: Column, made: Column, failed: Column, now: Column, retry: int = 3, refresh: int = 30) -> Column:
    """Whether a result is to be made again: none yet, changed at its origin, no readable time, failed some days ago, or old (refresh 0: never)."""
    age = age_days(made, now)
    return F.coalesce(~known | changed | made.isNull() | (failed & (age >= retry)) | (F.lit(refresh > 0) & (age >= refresh)), F.lit(True))


def unchanged(now: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose fingerprint isn't among those done."""
    return now.join(done.select(*keys).distinct(), list(keys), "left_anti")
