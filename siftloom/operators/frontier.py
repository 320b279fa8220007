"""Which links of the seed pages to take: in the order of seeds and links, new ones only, so many per seed and in all.

A seed's cap decides what a later seed may still take, so the walk is a fold. What it sees is bounded before it starts: of
each of at most ``seeds`` pages the first per_seed + total distinct new links are enough, as no more than ``total`` can be
taken before it. That bounded list is folded in one task; everything before it is distributed.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F


def _walk(per_seed: int, total: int) -> object:
    def f(pdf: pd.DataFrame) -> pd.DataFrame:
        taken: set[str] = set()
        out = []
        for seed, links in pdf.sort_values(["seed", "pos"]).groupby("seed", sort=True):
            if len(taken) >= total:
                break
            n = 0
            for row in links.itertuples():
                if n >= per_seed or len(taken) >= total:
                    break
                if row.url not in taken:
                    taken.add(row.url)
                    out.append((seed, row.pos, row.url))
                    n += 1
        return pd.DataFrame(out, columns=["seed", "pos", "url"])

    return f


def discovered(links: DataFrame, known: DataFrame, seeds: int = 40, per_seed: int = 20, total: int = 300) -> DataFrame:
    """From links (seed BIGINT in order, pos, url) and known (url): the links taken, (seed, pos, url)."""
    fresh = links.where(F.col("url").isNotNull() & (F.col("seed") < seeds)).join(known.select("url").distinct(), "url", "left_anti")
    fresh = fresh.groupBy("seed", "url").agg(F.min("pos").alias("pos"))
    n = F.row_number().over(Window.partitionBy("seed").orderBy("pos", "url"))
    bounded = fresh.withColumn("n", n).where(F.col("n") <= per_seed + total).select(F.col("seed").cast("bigint"), F.col("pos").cast("bigint"), "url")
    return bounded.withColumn("walk", F.lit(0)).groupBy("walk").applyInPandas(_walk(per_seed, total), "seed BIGINT, pos BIGINT, url STRING")
