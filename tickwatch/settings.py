"""Session defaults and the shared folder for streams and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Sized so that a task's share fits in executor memory; AQE merges small
# shuffle partitions and splits skewed ones at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Noting the Python call site of every column takes longer than planning a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Room for the compiled code of all queries a long session comes back to.
    "spark.sql.codegen.cache.maxEntries": "1000",
    "spark.ui.enabled": "false",
}


def session(app: str = "tickwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; extra settings win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def importable(spark: SparkSession) -> None:
    """Let Python workers find this library where the driver found it, whatever folder Spark was started in."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without one gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickwatch-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run under the shared folder."""
    return f"{shared_dir(spark)}/tickwatch/{label}-{uuid.uuid4().hex[:12]}"


def as_table(df: DataFrame, label: str) -> DataFrame:
    """Write rows that several reads need as a table in the shared folder, and read it back."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_buckets(df: DataFrame, label: str, column: str) -> DataFrame:
    """``as_table`` with rows dealt by a column, whose groups need no shuffle; they lie together in each file.

    The name of the table stands in the session's catalog, its files in the shared folder.
    """
    path = run_dir(df.sparkSession, label)
    name = path.rpartition("/")[2].replace("-", "_")
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).sortBy(column).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)
