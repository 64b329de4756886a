"""Price moves per market over sliding event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.functions import durations
from tickwatch.functions.barrier import computed_once
from tickwatch.functions.grading import change_percent, grade
from tickwatch.functions.numbers import round_half_even
from tickwatch.operators.ticks import decode_numbers
from tickwatch.schemas import MOVE_COLUMNS, typed

# A timestamp holds about 9.22e15 milliseconds either way; this leaves room for windows of some centuries.
_LAST_MS = 9_200_000_000_000_000

# Why a tick takes no part.
NO_TICK, NO_CODE, NO_PRICE, NO_TIME, OUT_OF_RANGE = "no tick", "no code", "no price", "no time", "time out of range"

# Room for any arrival number, of either sign, between two neighbouring milliseconds.
_PER_MS = "100000000000000000000"


def priced_ticks(
    df: DataFrame,
    arrival: str = "seq",
    record_time: str | None = None,
    valid_only: bool = False,
    value: str = "value",
) -> DataFrame:
    """Decode to (market_code, event_ms, event_time, price, arrival).

    Ticks without a code, a price or a time cannot take part; ``move_rejects`` has
    them. A tick that has no ``timestamp`` field takes the time of its record, if
    ``record_time`` names that column. ``valid_only`` also drops what the global
    health rules call an error.
    """
    prices = _decoded(df, arrival, record_time, valid_only, value).where(_reject_reason().isNull())
    if valid_only:
        prices = prices.where(
            (F.col("market_code") != "") & (F.col("price") > 0) & (F.col("volume") >= 0) & (F.col("sent") > 0)
        )
    return prices.select(
        "market_code", "event_ms", F.timestamp_millis("event_ms").alias("event_time"), "price", "arrival"
    )


def move_rejects(
    df: DataFrame, arrival: str = "seq", record_time: str | None = None, value: str = "value"
) -> DataFrame:
    """(arrival, reason) of the ticks that cannot take part in price moves."""
    rows = _decoded(df, arrival, record_time, False, value).withColumn("reason", _reject_reason())
    return rows.where(F.col("reason").isNotNull()).select(F.col("arrival").cast("bigint").alias(arrival), "reason")


def _reject_reason() -> Column:
    """Why a decoded tick cannot take part, null if it can."""
    in_range = F.col("event_ms").between(-_LAST_MS, _LAST_MS)
    return (
        F.when(~F.col("is_tick"), NO_TICK)
        .when(F.col("market_code").isNull(), NO_CODE)
        .when(F.col("price").isNull(), NO_PRICE)
        .when(F.col("event_ms").isNull(), NO_TIME)
        .when(~in_range, OUT_OF_RANGE)
    )


def _decoded(df: DataFrame, arrival: str, record_time: str | None, with_volume: bool, value: str) -> DataFrame:
    fields = {"code": "string", "trade_price": "double", "timestamp": "bigint"}
    if with_volume:
        fields |= {"trade_volume": "double"}
    kept = [arrival] if record_time is None else [arrival, record_time]
    sent = F.col("tick.timestamp")
    event_ms, absent = sent, None
    if record_time is not None:
        absent = "timestamp"
        event_ms = F.when(F.col("tick_absent"), F.unix_millis(record_time)).otherwise(sent)
    columns = {
        "is_tick": F.col("tick").isNotNull(),
        "market_code": F.col("tick.code"),
        "event_ms": event_ms,
        "price": F.col("tick.trade_price"),
        "arrival": F.col(arrival).cast("decimal(20,0)"),
    }
    if with_volume:
        columns |= {"volume": F.col("tick.trade_volume"), "sent": sent}
    ticks = decode_numbers(df.select(*kept, value), fields, value, absent=absent)
    return computed_once(ticks, [], columns)


def _first_and_last(rows: DataFrame, window: Column) -> DataFrame:
    """First and last price by time; among equal times the first arrival is both.

    Time and arrival are one DECIMAL(38,0) key, so the aggregate keeps two
    fixed-width buffers and stays a hash aggregate. A struct key would turn it
    into a sort of all rows.
    """
    millis = F.col("event_ms").cast("decimal(17,0)") * F.lit(_PER_MS).cast("decimal(21,0)")
    earliest = (millis + F.col("arrival")).cast("decimal(38,0)")
    latest = (millis - F.col("arrival")).cast("decimal(38,0)")
    return (
        rows.select("market_code", window.alias("span"), "price", earliest.alias("earliest"), latest.alias("latest"))
        .groupBy("span", "market_code")
        .agg(
            F.min_by("price", "earliest").alias("start_price"),
            F.max_by("price", "latest").alias("end_price"),
        )
    )


def window_prices(ticks: DataFrame, size: str, slide: str) -> DataFrame:
    """Start and end price per (span, market_code) over sliding windows.

    A batch folds each tick once into its pane, the longest step that divides size
    and slide, and spreads only the panes over the windows; spreading the ticks
    would multiply them by size / slide before the shuffle. A stream spreads the
    ticks, since a late tick must still count in the windows that are open after
    its own pane has closed.
    """
    if ticks.isStreaming:
        return _first_and_last(ticks, F.window("event_time", size, slide))
    panes = _first_and_last(ticks, F.window("event_time", durations.common_step(size, slide)))
    pane_start = F.col("span.start").alias("pane_start")
    return (
        panes.select(pane_start, "market_code", "start_price", "end_price")
        .groupBy(F.window("pane_start", size, slide).alias("span"), "market_code")
        .agg(
            F.min_by("start_price", "pane_start").alias("start_price"),
            F.max_by("end_price", "pane_start").alias("end_price"),
        )
    )


def price_moves(
    df: DataFrame,
    size: str = "5 minutes",
    slide: str = "1 minute",
    delay: str | None = None,
    valid_only: bool = False,
    arrival: str = "seq",
    record_time: str | None = None,
    value: str = "value",
) -> DataFrame:
    """Graded price move per market and window; windows that start at price 0 are left out.

    ``delay`` sets the watermark of a stream. The grade is taken from the
    unrounded change.
    """
    check_lengths(size, slide)
    ticks = priced_ticks(df, arrival, record_time, valid_only, value)
    if delay is not None:
        ticks = ticks.withWatermark("event_time", delay)
    return graded(window_prices(ticks, size, slide))


def check_lengths(size: str, slide: str) -> None:
    if durations.seconds(slide) > durations.seconds(size):
        raise ValueError(f"slide {slide!r} must not be longer than size {size!r}")


def graded(prices: DataFrame) -> DataFrame:
    """Start and end prices of windows as graded moves, those that start at price 0 left out."""
    moves = (
        prices.where(F.col("start_price") != 0)
        .withColumn("change", change_percent(F.col("start_price"), F.col("end_price")))
        .select(
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "start_price",
            "end_price",
            round_half_even(F.col("change"), 2).alias("change_rate"),
            grade(F.col("change")).alias("status"),
            "market_code",
        )
    )
    return typed(moves, MOVE_COLUMNS)


def move_status_counts(moves: DataFrame) -> DataFrame:
    """Number of windows per grade."""
    return moves.groupBy("status").agg(F.count("*").alias("windows"))


def known_market_moves(moves: DataFrame, markets: DataFrame) -> DataFrame:
    """Only the moves whose market is in the market table."""
    known = markets.select(F.col("market").alias("market_code"))
    return moves.join(known, "market_code", "left_semi").select(*moves.columns)
