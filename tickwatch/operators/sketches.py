"""Experiment summaries of any span of time from figures that merge.

Each span of stored metric rows is folded once into counts, sums, maxima and a sketch of
the latencies. A summary over any of these spans merges those few rows and reads no metric
row again. Counts, means and maxima are exact; the percentile has a bounded rank error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of the sketches: items kept at each level.
SIZE = 400


def rank_error(size: int = SIZE) -> float:
    """How far the rank of a quantile may be off, as a share of the rows.

    Twice the error that a sketch of this size keeps in 99 of 100 cases, so five standard
    deviations. Merging adds nothing to it.
    """
    return 2 * 2.296 / size**0.9723


def span_figures(metrics: DataFrame, span: str = "1 hour", size: int = SIZE) -> DataFrame:
    """One row for each span of metric rows, by ``checked_at``."""
    return metrics.groupBy(F.window("checked_at", span).alias("span")).agg(
        F.count("*").alias("samples"),
        F.sum("total_collected_count").alias("collected"),
        F.max("total_collected_count").alias("max_throughput"),
        F.sum("total_error_count").alias("errors"),
        F.sum("average_latency_ms").alias("latency_sum"),
        F.count("average_latency_ms").alias("latencies"),
        F.max("max_latency_ms").alias("max_latency_ms"),
        F.kll_sketch_agg_double("average_latency_ms", F.lit(size)).alias("latency_sketch"),
    )


def between(figures: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """The spans that lie from and to a time, if given."""
    if since is not None:
        figures = figures.where(F.col("span.start") >= F.lit(since).cast("timestamp"))
    if until is not None:
        figures = figures.where(F.col("span.end") <= F.lit(until).cast("timestamp"))
    return figures


def wider(figures: DataFrame, span: str = "1 day") -> DataFrame:
    """The figures of wider spans from those of narrower ones within them."""
    return _merged(figures.groupBy(F.window("span.start", span).alias("span")))


def _merged(grouped) -> DataFrame:
    return grouped.agg(
        F.sum("samples").alias("samples"),
        F.sum("collected").alias("collected"),
        F.max("max_throughput").alias("max_throughput"),
        F.sum("errors").alias("errors"),
        F.sum("latency_sum").alias("latency_sum"),
        F.sum("latencies").alias("latencies"),
        F.max("max_latency_ms").alias("max_latency_ms"),
        F.kll_merge_agg_double("latency_sketch").alias("latency_sketch"),
    )


def summary(figures: DataFrame, quantile: float = 0.95) -> DataFrame:
    """One row over all given spans, in the columns of ``serving.experiment_summary``."""
    whole = _merged(figures.groupBy())
    some = F.kll_sketch_get_n_double("latency_sketch") > 0
    found: Column = F.when(some, F.kll_sketch_get_quantile_double("latency_sketch", F.lit(quantile)))
    return whole.select(
        F.coalesce("samples", F.lit(0)).alias("samples"),
        F.try_divide("collected", "samples").alias("mean_throughput"),
        "max_throughput",
        F.try_divide("latency_sum", "latencies").alias("mean_latency_ms"),
        found.alias("p95_latency_ms"),
        "max_latency_ms",
        F.coalesce(F.try_divide("errors", "collected") * 100, F.lit(0.0)).alias("error_rate_percentage"),
    )
