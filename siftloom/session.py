"""Session, table access, and cutting of lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "siftloom", master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators rely on: UTC and adaptive execution.

    The number of shuffle partitions is the cluster's to set, by the size of its inputs; only a local session gets a small one.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if partitions is None and master and master.startswith("local"):
        partitions = 8
    if partitions is not None:
        base["spark.sql.shuffle.partitions"] = str(partitions)
    return b.config(map=base | conf).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it.

    Only a local session, where the driver is the only executor, gets a folder of its own when the setting is missing.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="siftloom-")
    atexit.register(shutil.rmtree, folder, True)
    own = f"file://{folder}"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there and survives the loss of executors. Deleted when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
