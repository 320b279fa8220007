"""Increments as streams: what lands in a folder is worked in once, then the stream stops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.state import upsert
from ..session import shared_dir
from ..sources.tables import exists, replace_table


def landed(spark: SparkSession, folder: str, schema: StructType, glob: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def upsert_stream(spark: SparkSession, folder: str, schema: StructType, state: str, checkpoint: str, key: str, order: Sequence[str], payload: Sequence[str], seen: str, sticky: tuple[str, Sequence[str]] | None = None) -> None:
    """Work new files into the state table, each exactly once as far as the checkpoint knows; upserts are idempotent for a batch that is run again."""
    kinds = {f.name: f.dataType.simpleString() for f in schema}

    def one(batch: DataFrame, _: int) -> None:
        previous = spark.read.parquet(state) if exists(spark, state) else spark.createDataFrame([], f"{key} {kinds[key]}, " + ", ".join(f"{c} {kinds[c]}" for c in payload) + f", first_seen {kinds[seen]}, last_seen {kinds[seen]}")
        replace_table(upsert(previous, batch, key, order, payload, seen, sticky), state)

    landed(spark, folder, schema).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed(events: DataFrame, at: str, by: str, value: str, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Counts and sums per window and key; on a stream, windows close when the watermark passes them."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), by, "n", F.round("total", 4).alias("total"))


def run_now(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Run a stream over what is there and give its result as a table in the shared folder.

    In append mode each micro-batch is a folder of its own, so a batch that is run again replaces its own rows and no other's;
    in complete mode the last batch is the result.
    """
    spark = stream.sparkSession
    out = f"{shared_dir(spark)}/{name}"

    def one(df: DataFrame, k: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={k}" if mode == "append" else out)

    stream.writeStream.outputMode(mode).foreachBatch(one).option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    made = spark.read.schema(stream.schema).parquet(out)
    return made.drop("batch") if mode == "append" and "batch" not in stream.columns else made
