"""The jobs put together: ticks in, tables out.

``ticks`` is a stream with ``value``, ``seq`` and ``ingest_time``, as
``sources.kafka.read_ticks`` gives it. ``write`` takes each finished micro-batch, for
example ``sinks.batch_folder(path)`` or ``sources.jdbc.appender(...)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickwatch.operators import markets as sync
from tickwatch.operators.metrics import health_metrics, market_metrics
from tickwatch.operators.moves import price_moves
from tickwatch.operators.ticks import metric_events
from tickwatch.sources import files
from tickwatch.streaming import clocks, panes, sinks, splits, timers
from tickwatch.streaming.runner import drop_late_at_once, start_batches, state_on_disk

Write = Callable[[DataFrame, int], None]

# The health jobs count by the time a tick is read; its ingest time only gives the latency.
ARRIVED = "arrived_at"


def start_health(
    ticks: DataFrame, write: Write, checkpoint: str, bucket: str = "1 second", beat: bool = True, **run
) -> StreamingQuery:
    """Health of the whole stream per bucket of arrival time; every tick counts, and buckets close while none come."""
    events = metric_events(clocks.with_arrival_clock(ticks, ARRIVED, beat))
    return start_batches(health_metrics(events, bucket, ARRIVED), write, checkpoint, **run)


def start_market_health(
    ticks: DataFrame, write: Write, checkpoint: str, bucket: str = "1 second", beat: bool = True, **run
) -> StreamingQuery:
    """Health of each market per bucket of arrival time."""
    events = metric_events(clocks.with_arrival_clock(ticks, ARRIVED, beat), rules="market")
    return start_batches(market_metrics(events, bucket, ARRIVED), write, checkpoint, **run)


def start_timed_health(ticks: DataFrame, write: Write, checkpoint: str, bucket: str = "1 second", **run) -> StreamingQuery:
    """Health of the whole stream per bucket of the time at which ticks are read; timers close buckets, no clock row does."""
    with state_on_disk(ticks.sparkSession):
        closed = timers.closed_buckets(metric_events(ticks), bucket)
        return start_batches(closed, timers.whole_batches(write, bucket), checkpoint, **run)


def start_timed_market_health(
    ticks: DataFrame, write: Write, checkpoint: str, bucket: str = "1 second", **run
) -> StreamingQuery:
    """Health of each market per bucket of the time at which ticks are read."""
    with state_on_disk(ticks.sparkSession):
        closed = timers.closed_buckets(metric_events(ticks, rules="market"), bucket)
        return start_batches(timers.market_health(closed, bucket), write, checkpoint, **run)


def start_moves(
    ticks: DataFrame,
    markets: Callable[[], DataFrame],
    write: Write,
    checkpoint: str,
    size: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = "1 second",
    record_time: str | None = "ingest_time",
    **run,
) -> StreamingQuery:
    """Graded price moves of known markets; a tick without a time of its own takes that of its record."""
    moving = price_moves(ticks, size, slide, delay=delay, record_time=record_time)
    with drop_late_at_once(ticks.sparkSession):
        return start_batches(moving, sinks.known_moves(markets, write), checkpoint, **run)


def start_split_moves(
    tick_splits: Sequence[DataFrame],
    markets: Callable[[], DataFrame],
    write: Write,
    checkpoint: str,
    size: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = "1 second",
    record_time: str | None = "ingest_time",
    **run,
) -> StreamingQuery:
    """As ``start_moves``, over the splits of a feed, none of which can make the ticks of another late."""
    moving = splits.price_moves(tick_splits, size, slide, delay, record_time=record_time)
    with drop_late_at_once(moving.sparkSession), splits.least_watermark(moving.sparkSession):
        return start_batches(moving, sinks.known_moves(markets, write), checkpoint, **run)


def start_pane_moves(
    ticks: DataFrame,
    markets: Callable[[], DataFrame],
    write: Write,
    checkpoint: str,
    size: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = "1 second",
    record_time: str | None = "ingest_time",
    **run,
) -> StreamingQuery:
    """As ``start_moves``, with one change of state for a tick however many windows overlap."""
    moving = panes.price_moves(ticks, size, slide, delay, record_time=record_time)
    with state_on_disk(ticks.sparkSession):
        return start_batches(moving, sinks.known_moves(markets, write), checkpoint, **run)


def start_routing(
    ticks: DataFrame, markets: Callable[[], DataFrame], base: str, checkpoint: str, **run
) -> StreamingQuery:
    """Every tick to the output it belongs to."""
    return start_batches(ticks, sinks.routed_outputs(markets, base), checkpoint, **run)


def sync_markets(
    spark: SparkSession, existing_path: str, feed_path: str, folder: str, version: str, reactivate: bool = True
) -> tuple[str, DataFrame]:
    """Write the next market table and return its path and the report on the changes.

    The newest reply in the feed folder is compared, and no other.
    """
    existing, feed = files.read_markets(spark, existing_path), files.read_market_feed(spark, feed_path)
    path = files.write_markets(sync.sync_snapshot(existing, feed, reactivate), folder, version)
    return path, sync.sync_report(sync.sync_changes(existing, feed, reactivate))
