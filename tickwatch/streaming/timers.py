"""Health buckets that close on processing-time timers.

A tick counts in the bucket of the time at which its micro-batch is read. Each task folds
its share of a micro-batch by market first, so the state sees a few rows a market, however
many ticks there are. Each market holds the figures of its open bucket; a timer at the
bucket's end emits them and clears the state, so buckets close while no tick comes. The
state carries no lifetime of its own: one that ran out while the job was down would lose
counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickwatch.functions import durations
from tickwatch.operators import metrics
from tickwatch.settings import importable

FIGURES = "collected bigint, errors bigint, latency_sum double, latency_max double, amount double"
FOLDED = f"market string, {FIGURES}"
CLOSED = f"market string, bucket_ms bigint, {FIGURES}"
_FIGURES = ("collected", "errors", "latency_sum", "latency_max", "amount")
_HOW = tuple(zip(_FIGURES, ("sum", "sum", "sum", "max", "sum")))


def folded(events: DataFrame) -> DataFrame:
    """Figures by market of each task's share of a micro-batch."""
    good = ~F.col("is_error")
    rows = events.select(
        "market",
        F.lit(1).cast("bigint").alias("collected"),
        F.col("is_error").cast("bigint").alias("errors"),
        F.when(good, F.col("latency_ms")).alias("latency_sum"),
        F.when(good, F.col("latency_ms")).alias("latency_max"),
        F.when(good, F.col("trade_amount_krw")).alias("amount"),
    )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        schema = pa.schema(list(zip(("market", *_FIGURES), kinds)))
        held = schema.empty_table()
        for batch in batches:
            table = pa.concat_tables([held, pa.Table.from_batches([batch]).cast(schema)])
            found = table.group_by("market").aggregate(list(_HOW))
            held = found.select(["market", *(f"{name}_{how}" for name, how in _HOW)]).rename_columns(schema.names)
        yield from held.cast(schema).combine_chunks().to_batches()

    return rows.mapInArrow(fold, FOLDED)


def added(one: tuple, other: tuple) -> tuple:
    """Figures of two shares; null where neither has a valid tick."""
    out = []
    for (_, how), x, y in zip(_HOW, one, other):
        if x is None or y is None:
            out.append(x if y is None else y)
        else:
            out.append(max(x, y) if how == "max" else x + y)
    return tuple(out)


class Buckets(StatefulProcessor):
    """Holds one market's open bucket until its end."""

    def __init__(self, size_ms: int):
        self.size_ms = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", f"bucket_ms bigint, {FIGURES}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        bucket = now - now % self.size_ms
        total = None
        for row in rows:
            figures = tuple(row[name] for name in _FIGURES)
            total = figures if total is None else added(total, figures)
        if self.open.exists():
            held, *figures = self.open.get()
            if held < bucket:
                yield self.row(key, held, figures)
            else:
                # A clock that was set back opens no earlier bucket.
                bucket, total = held, added(tuple(figures), total)
        self.open.update((bucket, *total))
        self.handle.registerTimer(bucket + self.size_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # The figures may have gone out with later ticks of the same micro-batch.
        if self.open.exists():
            held, *figures = self.open.get()
            if held + self.size_ms <= expiredTimerInfo.getExpiryTimeInMs():
                self.open.clear()
                yield self.row(key, held, figures)

    def row(self, key, bucket: int, figures) -> Row:
        return Row(market=key[0], bucket_ms=bucket, **dict(zip(_FIGURES, figures)))

    def close(self) -> None:
        pass


def closed_buckets(events: DataFrame, bucket: str = "1 second") -> DataFrame:
    """Figures of closed buckets by market, for a stream of judged ticks.

    All markets' figures of a bucket leave in the same micro-batch, the first one after
    its end. Start it inside ``runner.state_on_disk``.
    """
    importable(events.sparkSession)
    size_ms = durations.seconds(bucket) * 1000
    return folded(events).groupBy("market").transformWithState(Buckets(size_ms), CLOSED, "append", "processingTime")


def _spans(closed: DataFrame, bucket: str) -> DataFrame:
    end = F.timestamp_millis(F.col("bucket_ms") + durations.seconds(bucket) * 1000)
    return closed.withColumn("bucket", F.struct(F.timestamp_millis("bucket_ms").alias("start"), end.alias("end")))


def market_health(closed: DataFrame, bucket: str = "1 second") -> DataFrame:
    """Closed buckets as market metrics."""
    return metrics.market_figures(_spans(closed, bucket), bucket)


def whole_health(closed: DataFrame, bucket: str = "1 second") -> DataFrame:
    """Closed buckets of one micro-batch, or of several, as metrics of the whole stream."""
    return metrics.whole_figures(_spans(closed, bucket), bucket)


def whole_batches(write: Callable[[DataFrame, int], None], bucket: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that hands on the whole stream's metrics of each micro-batch."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        write(whole_health(batch, bucket), batch_id)

    return fold
