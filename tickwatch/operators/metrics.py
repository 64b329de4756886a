"""Health of the tick stream per time bucket, whole and by market."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.functions import durations
from tickwatch.schemas import HEALTH_COLUMNS, MARKET_HEALTH_COLUMNS, typed


def _per_market(events: DataFrame, bucket: str, clock: str) -> DataFrame:
    """Partial figures per bucket and market; every buffer has a fixed width."""
    good = ~F.col("is_error")
    return events.groupBy(F.window(clock, bucket).alias("bucket"), "market").agg(
        F.count("*").alias("collected"),
        F.count_if("is_error").alias("errors"),
        F.sum(F.when(good, F.col("latency_ms"))).alias("latency_sum"),
        F.max(F.when(good, F.col("latency_ms"))).alias("latency_max"),
        F.sum(F.when(good, F.col("trade_amount_krw"))).alias("amount"),
    )


def _figures() -> dict[str, Column]:
    """Rates and means from the partial figures, 0.0 where there is nothing to average."""
    valid = F.col("collected") - F.col("errors")
    return {
        "error_rate_percentage": F.coalesce(F.try_divide("errors", "collected") * 100, F.lit(0.0)),
        "average_latency_ms": F.coalesce(F.try_divide(F.col("latency_sum"), valid), F.lit(0.0)),
        "max_latency_ms": F.coalesce("latency_max", F.lit(0.0)),
    }


def health_metrics(events: DataFrame, bucket: str = "1 second", clock: str = "ingest_time") -> DataFrame:
    """One row per bucket over all markets.

    Markets are folded first and counted second. That gives the exact number of
    distinct markets without holding a set of them, splits a bucket over as many
    tasks as it has markets, and runs unchanged on a stream (append mode).
    """
    return whole_figures(_per_market(events, bucket, clock), bucket)


def whole_figures(per_market: DataFrame, bucket: str) -> DataFrame:
    """Health of the whole stream from the figures per bucket and market."""
    seen = (F.col("collected") > F.col("errors")) & F.col("market").isNotNull()
    folded = per_market.groupBy("bucket").agg(
        F.sum("collected").alias("collected"),
        F.sum("errors").alias("errors"),
        F.sum("latency_sum").alias("latency_sum"),
        F.max("latency_max").alias("latency_max"),
        F.sum("amount").alias("amount"),
        F.count_if(seen).alias("unique_market_count"),
    )
    figures = folded.select(
        F.col("bucket.end").alias("checked_at"),
        F.lit(durations.label(bucket)).alias("time_unit"),
        F.col("collected").alias("total_collected_count"),
        F.col("errors").alias("total_error_count"),
        *[figure.alias(name) for name, figure in _figures().items()],
        "unique_market_count",
        F.coalesce("amount", F.lit(0.0)).alias("total_trade_volume_krw"),
    )
    return typed(figures, HEALTH_COLUMNS)


def market_metrics(events: DataFrame, bucket: str = "1 second", clock: str = "ingest_time") -> DataFrame:
    """One row per bucket and market. A hot market is pre-aggregated before the shuffle."""
    return market_figures(_per_market(events, bucket, clock), bucket)


def market_figures(per_market: DataFrame, bucket: str) -> DataFrame:
    """Health of each market from the figures per bucket and market."""
    figures = per_market.select(
        F.col("bucket.end").alias("checked_at"),
        "market",
        F.lit(durations.label(bucket)).alias("time_unit"),
        F.col("collected").alias("collected_count"),
        F.col("errors").alias("error_count"),
        *[figure.alias(name) for name, figure in _figures().items()],
        F.coalesce("amount", F.lit(0.0)).alias("trade_volume_krw"),
    )
    return typed(figures, MARKET_HEALTH_COLUMNS)
