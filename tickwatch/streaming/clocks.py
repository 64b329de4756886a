"""Event-time and ingest clocks of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONOTONE = "0 seconds"


def with_ingest_clock(df: DataFrame, clock: str = "ingest_time", delay: str = MONOTONE) -> DataFrame:
    """Close buckets by the time ticks came in.

    That time moves forward within a topic partition, but partitions may be read at
    different speeds. ``delay`` is how far one may fall behind before its ticks
    would be too late to count.
    """
    return df.withWatermark(clock, delay)


def with_event_clock(df: DataFrame, delay: str = "1 second", clock: str = "event_time") -> DataFrame:
    """Close windows by the ticks' own time, late ones allowed for by ``delay``."""
    return df.withWatermark(clock, delay)


def with_arrival_clock(df: DataFrame, clock: str = "arrived_at", beat: bool = True) -> DataFrame:
    """Add the time at which a tick is read, the time of its micro-batch, and close buckets by it.

    No tick can be late by that clock, however far behind the others it was sent or
    its topic partition is read. A batch that is run again keeps its time. With
    ``beat`` one empty row a second moves the clock on while no tick comes, so that
    buckets close; it is taken out again here.
    """
    if not df.isStreaming:
        raise ValueError("the arrival clock is that of a stream")
    ticks = df.withColumns({"_beat": F.lit(False), clock: F.current_timestamp()})
    if beat:
        empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in df.schema]
        rate = df.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
        ticks = ticks.unionByName(rate.select(*empty, F.lit(True).alias("_beat"), F.col("timestamp").alias(clock)))
    timed = ticks.withWatermark(clock, MONOTONE)
    # The filter names the clock, or it would be pushed below the watermark.
    return timed.where(F.when(~F.col("_beat"), F.col(clock)).isNotNull()).drop("_beat")
