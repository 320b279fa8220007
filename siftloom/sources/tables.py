"""Tables as files: JSON arrays in and out, and writes that replace a table at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str) -> tuple:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A file of one JSON array; a missing or empty one is an empty table."""
    fs, p = _fs(spark, path)
    if not fs.exists(p) or fs.getContentSummary(p).getLength() == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def write_json(df: DataFrame, path: str) -> None:
    """Lines of JSON."""
    df.write.mode("overwrite").json(path)


def _beside(df: DataFrame, path: str) -> str:
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.parquet(beside)
    return beside


def _swap(spark: SparkSession, beside: str, path: str) -> str | None:
    """Put a written table in another's place; returns where the old one is now, if there was one."""
    fs, p = _fs(spark, path)
    aside = f"{path.rstrip('/')}-old-{uuid.uuid4().hex}" if fs.exists(p) else None
    if aside and not fs.rename(p, _fs(spark, aside)[1]):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(_fs(spark, beside)[1], p):
        if aside:
            fs.rename(_fs(spark, aside)[1], p)
        raise OSError(f"can't put {beside} in place of {path}")
    return aside


def replace_table(df: DataFrame, path: str) -> None:
    """Written beside the table, then the old one is moved aside and the new one put in its place; the old rows are deleted last, so a crash never loses both.

    Between the two moves a reader that opens the table finds none; one that has opened it before keeps the files till the deletion.
    """
    commit_if(None, [(df, path)])


def commit_if(condition: DataFrame | None, writes: list[tuple[DataFrame, str]]) -> bool:
    """Write all tables if the condition has any row (or is None), none otherwise. All are written before the first is put in place; if one can't be, those before it are put back."""
    if condition is not None and condition.isEmpty():
        return False
    spark = writes[0][0].sparkSession
    ready = [(_beside(df, path), path) for df, path in writes]
    done: list[tuple[str, str | None]] = []
    try:
        for beside, path in ready:
            done.append((path, _swap(spark, beside, path)))
    except OSError:
        for path, aside in reversed(done):
            fs, p = _fs(spark, path)
            fs.delete(p, True)
            if aside:
                fs.rename(_fs(spark, aside)[1], p)
        raise
    for _, aside in done:
        if aside:
            fs, p = _fs(spark, aside)
            fs.delete(p, True)
    return True


def changelog(previous: DataFrame, date: str, title: str, description: str) -> DataFrame:
    """previous (ord, date, title, description) and one newer entry; read it by ord, the greatest first."""
    row = previous.agg((F.coalesce(F.max("ord"), F.lit(0)) + 1).alias("ord")).select("ord", *(F.lit(v).alias(k) for k, v in (("date", date), ("title", title), ("description", description))))
    return previous.unionByName(row)


def enriched(rows: DataFrame, enrich: Callable, schema: str) -> DataFrame:
    """rows through an enricher (an iterator of pandas frames to one of frames, as mapInPandas has it): where a model or a service is called."""
    return rows.mapInPandas(enrich, schema)
