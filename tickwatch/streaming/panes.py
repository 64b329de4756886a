"""Sliding windows of a stream from panes held as state.

A pane is the longest step that divides the windows' size and slide. Each task folds its
share of a micro-batch by market and pane, each market holds its open panes in a map, and
a window merges the panes in it when the watermark has passed its end. So a tick changes
one pane, however many windows overlap, and a late tick still counts in the windows that
are open after its own pane has passed.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickwatch.functions import durations
from tickwatch.operators import moves
from tickwatch.settings import importable

PANE = (
    "first_ms bigint, first_arrival decimal(20,0), first_price double, "
    "last_ms bigint, last_arrival decimal(20,0), last_price double"
)
FOLDED = f"market_code string, pane_ms bigint, {PANE}"
WINDOWS = "market_code string, start_ms bigint, end_ms bigint, start_price double, end_price double"

Pane = tuple[int, Decimal, float, int, Decimal, float]


def merged(one: Pane, other: Pane) -> Pane:
    """First and last of two sets of ticks: by time, and among equal times the first arrival is both."""
    first = min(one[:3], other[:3], key=lambda tick: tick[:2])
    last = max(one[3:], other[3:], key=lambda tick: (tick[0], -tick[1]))
    return first + last


def folded(ticks: DataFrame, pane_ms: int) -> DataFrame:
    """First and last tick by market and pane of each task's share of a micro-batch."""
    rows = ticks.select("market_code", "event_ms", F.col("arrival").cast("decimal(20,0)").alias("arrival"), "price")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        panes: dict[tuple[str, int], Pane] = {}
        for batch in batches:
            for market, ms, arrival, price in zip(*[column.to_pylist() for column in batch.columns]):
                tick = ms, arrival, price, ms, arrival, price
                key = market, ms - ms % pane_ms
                held = panes.get(key)
                panes[key] = tick if held is None else merged(held, tick)
        if panes:
            columns = zip(*[(*key, *pane) for key, pane in panes.items()])
            kinds = [pa.string(), pa.int64(), *[pa.int64(), pa.decimal128(20, 0), pa.float64()] * 2]
            names = [part.split()[0] for part in FOLDED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return rows.mapInArrow(fold, FOLDED)


class Panes(StatefulProcessor):
    """Holds one market's panes until no open window needs them."""

    def __init__(self, size_ms: int, slide_ms: int):
        self.size_ms, self.slide_ms = size_ms, slide_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane_ms bigint", PANE)
        # The watermark up to which all windows have been given out.
        self.given = handle.getValueState("given", "watermark_ms bigint")

    def first_end_after(self, ms: int) -> int:
        """The first end of a window after a time."""
        return ms - (ms - self.size_ms) % self.slide_ms + self.slide_ms

    def last_end_with(self, pane_ms: int) -> int:
        """The last end of a window that holds a pane."""
        return pane_ms - pane_ms % self.slide_ms + self.size_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        # Windows that ended by now take none of these ticks.
        yield from self.give(key, watermark)
        changed: dict[int, Pane] = {}
        for row in rows:
            _, pane_ms, *pane = row
            if self.last_end_with(pane_ms) > watermark:
                pane = tuple(pane)
                changed[pane_ms] = merged(changed[pane_ms], pane) if pane_ms in changed else pane
        for pane_ms, pane in changed.items():
            if self.panes.containsKey((pane_ms,)):
                pane = merged(tuple(self.panes.getValue((pane_ms,))), pane)
            self.panes.updateValue((pane_ms,), pane)
        self.wake(watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        yield from self.give(key, watermark)
        self.wake(watermark)

    def give(self, key, watermark: int) -> Iterator[Row]:
        """The windows whose end the watermark has reached since the last time, and drop the panes of no other."""
        if not self.given.exists():
            return
        (given,) = self.given.get()
        panes = {pane[0]: tuple(value) for pane, value in self.panes.iterator()}
        ends = set()
        for pane_ms in panes:
            end = self.first_end_after(pane_ms)
            while end <= watermark and end <= self.last_end_with(pane_ms):
                if end > given:
                    ends.add(end)
                end += self.slide_ms
        for end in sorted(ends):
            held = [panes[pane_ms] for pane_ms in sorted(panes) if end - self.size_ms <= pane_ms < end]
            whole = held[0]
            for pane in held[1:]:
                whole = merged(whole, pane)
            yield Row(market_code=key[0], start_ms=end - self.size_ms, end_ms=end, start_price=whole[2], end_price=whole[5])
        for pane_ms in panes:
            if self.last_end_with(pane_ms) <= watermark:
                self.panes.removeKey((pane_ms,))

    def wake(self, watermark: int) -> None:
        """Set the timer for the next window that ends, or forget the market if none is open."""
        ends = [max(self.first_end_after(pane[0]), self.first_end_after(watermark)) for pane in self.panes.keys()]
        if ends:
            self.given.update((watermark,))
            self.handle.registerTimer(min(ends))
        else:
            self.given.clear()

    def close(self) -> None:
        pass


def window_prices(ticks: DataFrame, size: str, slide: str) -> DataFrame:
    """Start and end price per (span, market_code) of a stream of priced ticks with a watermark.

    Gives the rows of ``moves.window_prices``. Start it inside ``runner.state_on_disk``.
    """
    importable(ticks.sparkSession)
    size_ms, slide_ms = durations.seconds(size) * 1000, durations.seconds(slide) * 1000
    pane_ms = durations.seconds(durations.common_step(size, slide)) * 1000
    found = folded(ticks, pane_ms).groupBy("market_code").transformWithState(
        Panes(size_ms, slide_ms), WINDOWS, "append", "eventTime"
    )
    span = F.struct(F.timestamp_millis("start_ms").alias("start"), F.timestamp_millis("end_ms").alias("end"))
    return found.select(span.alias("span"), "market_code", "start_price", "end_price")


def price_moves(
    df: DataFrame,
    size: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = "1 second",
    valid_only: bool = False,
    arrival: str = "seq",
    record_time: str | None = None,
    value: str = "value",
) -> DataFrame:
    """Graded price moves of a stream, as ``operators.moves.price_moves`` gives them, from panes."""
    moves.check_lengths(size, slide)
    ticks = moves.priced_ticks(df, arrival, record_time, valid_only, value).withWatermark("event_time", delay)
    return moves.graded(window_prices(ticks, size, slide))
