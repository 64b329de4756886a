"""Start streams and run them over what is there."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickwatch.settings import run_dir

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# One bound on the memory of all state partitions of an executor together.
_STATE_MEMORY = {
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
}

# One stateful operator per query: with it, rows behind the watermark are
# dropped at once; otherwise a batch later.
_SEVERAL_STATEFUL = "spark.sql.streaming.statefulOperator.allowMultiple"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def drop_late_at_once(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started inside drop late rows in the batch after the watermark moved."""
    return settings(spark, {_SEVERAL_STATEFUL: "false"})


def state_on_disk(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started inside keep their state in RocksDB, as those with timers need, in bounded memory."""
    return settings(spark, {_STATE_STORE: _ROCKSDB, **_STATE_MEMORY})


def start_files(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str | None = None
) -> StreamingQuery:
    """Start appending a stream to parquet files, each row once."""
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def start_batches(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Start handing each micro-batch of a stream to ``write``."""
    writer = df.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def open_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The keys and values that a stopped stream holds, read from its checkpoint."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def run_available(df: DataFrame, label: str) -> DataFrame:
    """Run a stream over all data that is there now and read back what it wrote."""
    spark = df.sparkSession
    folder = run_dir(spark, label)
    start_files(df, f"{folder}/rows", f"{folder}/checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def dropped_late(query: StreamingQuery) -> int:
    """Rows that the recent batches dropped as too late; 0 for the health jobs, whose clock knows no late rows."""
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states)


def run_until_closed(df: DataFrame, label: str, every: str = "1 second", at_most: float | None = None) -> DataFrame:
    """Run a stream with an arrival clock until its files are read and its last bucket is closed; read back what it wrote.

    The stream is done once a batch had no rows but the clock's own and no state is left.
    ``at_most`` seconds limit the run if given; a stream that reads a large table takes its time.
    """
    folder = run_dir(df.sparkSession, label)
    query = start_files(df, f"{folder}/rows", f"{folder}/checkpoint", every=every)
    wait_until_closed(query, at_most)
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")


def wait_until_closed(query: StreamingQuery, at_most: float | None = None) -> None:
    """Wait until a stream has read its files and no bucket is open, and stop it."""
    end = None if at_most is None else time.monotonic() + at_most
    try:
        while not is_closed(query):
            if query.exception():
                raise query.exception()
            if end is not None and time.monotonic() > end:
                raise TimeoutError(f"{query.name or query.id} was not closed in {at_most} seconds")
            time.sleep(0.2)
    finally:
        query.stop()


def is_closed(query: StreamingQuery) -> bool:
    """Files were read, the last batch found no further ones, and no bucket is open."""
    progress = query.lastProgress
    if not progress or not progress["stateOperators"]:
        return False
    files = [source for source in progress["sources"] if "FileStreamSource" in source["description"]]
    read = files and all(source["endOffset"] and source["startOffset"] == source["endOffset"] for source in files)
    return bool(read) and not any(state["numRowsTotal"] for state in progress["stateOperators"])
