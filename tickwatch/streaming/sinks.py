"""Where streams end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.operators import moves, quality
from tickwatch.streaming import ledger


# Row groups of market metrics are small, so that one market's history reads little else.
ROW_GROUP_BYTES = 8 << 20


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch to its own folder.

    A batch that is run again overwrites what it wrote, so rows arrive once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def routed_outputs(
    markets: Callable[[], DataFrame], base: str, value: str = "value"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes all outputs of each batch in one pass, for ``read_routed``.

    A batch that is run again overwrites what it wrote. ``markets`` is called for each
    batch, so a synced market table takes effect with the next one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_routed(quality.route(batch.select(value), markets(), value), f"{base}/batch_id={batch_id}")

    return write


def routed_table(
    markets: Callable[[], DataFrame], path: str, value: str = "value"
) -> Callable[[DataFrame, int], None]:
    """As ``routed_outputs``, into a table of batches that ``ledger.compact`` can put together by outcome."""

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = with_outcome(quality.route(batch.select(value), markets(), value))
        ledger.write_batch(routed, path, batch_id, ["outcome"])

    return write


def with_outcome(routed: DataFrame) -> DataFrame:
    """Routed ticks with their outcome; the payload of stored ticks is left out."""
    outcome = quality.outcome()
    kept = F.when(outcome != quality.STORED, F.col("raw_data"))
    return routed.withColumn("raw_data", kept).withColumn("outcome", outcome)


def write_routed(routed: DataFrame, path: str) -> None:
    """Write all outputs of routed ticks in one pass, a folder per outcome of one table.

    Nothing is cached and no tick is decoded twice, which suits a batch of any size.
    The payload is left out of stored ticks; the load time is written with each tick.
    ``read_routed`` gives the single outputs.
    """
    with_outcome(routed).write.mode("overwrite").partitionBy("outcome").parquet(path)


def read_routed(spark: SparkSession, path: str, outcome: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One output of a table that ``write_routed`` or ``routed_outputs`` wrote; only its folders are read."""
    rows = spark.read.parquet(path).where(F.col("outcome") == outcome)
    return quality.OUTPUTS[outcome](rows, keep)


def known_moves(
    markets: Callable[[], DataFrame], write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """Hand on the moves of known markets, with their load time."""

    def pass_on(batch: DataFrame, batch_id: int) -> None:
        known = moves.known_market_moves(batch, markets())
        write(known.withColumn("created_at", F.current_timestamp()), batch_id)

    return pass_on


def write_by_day(metrics: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Add metric rows to a table by day, newest first within files; market metrics also by market.

    A range partitioning on (day, market, time) splits a hot market over several
    files; row group statistics then find one market's history, and where a row group
    spans several markets its Bloom filter tells whether the market is one of them. With a
    batch id the rows have a folder of their own, which a repeated batch overwrites;
    without one they are appended. ``serving`` reads the table.
    """
    by_market = "market" in metrics.columns
    order = ["checked_date", *(["market"] if by_market else []), F.desc("checked_at")]
    dated = metrics.withColumn("checked_date", F.to_date("checked_at"))
    rows = dated.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("checked_date")
    if by_market:
        rows = rows.option("parquet.bloom.filter.enabled#market", "true").option("parquet.block.size", ROW_GROUP_BYTES)
    if batch_id is None:
        rows.mode("append").parquet(f"{path}/batch_id=-1")
    else:
        rows.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def daily_table(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds each batch of metrics to a table by day, once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_by_day(batch, path, batch_id)

    return write


def to_console(df: DataFrame, checkpoint: str):
    """Start printing a stream."""
    return df.writeStream.format("console").option("checkpointLocation", checkpoint).start()
