"""Watermarks of a feed that is read in splits, such as topic partitions or folders.

One watermark over all splits follows the fastest: ticks of a split that lags behind come
too late. Here each split is a source with a watermark of its own, and the least of them
closes windows, so no split loses ticks however far behind the others it is. A split that
has given no tick yet holds all windows open.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import AbstractContextManager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tickwatch.operators import moves
from tickwatch.streaming.clocks import with_event_clock
from tickwatch.streaming.runner import settings

_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def least_watermark(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started inside close windows by the least watermark of their sources."""
    return settings(spark, {_POLICY: "min"})


def united(splits: Sequence[DataFrame], clock: str = "event_time", delay: str = "1 second") -> DataFrame:
    """The splits of one feed as one stream, each with a watermark of its own. Start it inside ``least_watermark``."""
    if not splits:
        raise ValueError("a feed has at least one split")
    return reduce(DataFrame.unionByName, [with_event_clock(split, delay, clock) for split in splits])


def price_moves(
    splits: Sequence[DataFrame],
    size: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = "1 second",
    valid_only: bool = False,
    arrival: str = "seq",
    record_time: str | None = None,
    value: str = "value",
) -> DataFrame:
    """Graded price moves over all splits, as ``operators.moves.price_moves`` gives them for one stream."""
    moves.check_lengths(size, slide)
    ticks = [moves.priced_ticks(split, arrival, record_time, valid_only, value) for split in splits]
    return moves.graded(moves.window_prices(united(ticks, delay=delay), size, slide))
