"""Read the metric tables: latest, recent, history and an experiment summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.operators.quantiles import exact_quantile
from tickwatch.schemas import HEALTH_COLUMNS

# How many rows the recent view gives by default and at most, and its empty reply.
DEFAULT_LIMIT, MAX_LIMIT = 60, 300
NO_DATA = '{"message":"No metric data yet"}'


def iso_time(time: Column) -> Column:
    """ISO 8601 text with offset; a fraction is shown only when there is one."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ssxxx")
    split = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(time) % 1000000 == 0, whole).otherwise(split)


def served_fields() -> list[Column]:
    """The nine served fields, with the time as text."""
    return [iso_time(F.col(n)).alias(n) if n == "checked_at" else F.col(n) for n in HEALTH_COLUMNS]


def serialize(metrics: DataFrame) -> DataFrame:
    """Metric rows as they are served."""
    return metrics.select(*served_fields())


def clamp_limit(requested: object = DEFAULT_LIMIT) -> int:
    """Requested row count as a number between 1 and the maximum; the default if it is none."""
    try:
        limit = int(requested)
    except (TypeError, ValueError):
        limit = DEFAULT_LIMIT
    return min(max(limit, 1), MAX_LIMIT)


def latest(metrics: DataFrame) -> DataFrame:
    """The newest metric row, or none."""
    return serialize(metrics.orderBy(F.desc("checked_at")).limit(1))


def latest_response(metrics: DataFrame) -> DataFrame:
    """The newest metric as one JSON text, or the empty reply."""
    one = latest(metrics).select(F.to_json(F.struct("*")).alias("body"))
    return one.agg(F.coalesce(F.max("body"), F.lit(NO_DATA)).alias("body"))


def recent(metrics: DataFrame, limit: object = DEFAULT_LIMIT) -> DataFrame:
    """The newest metric rows, newest first."""
    return serialize(metrics.orderBy(F.desc("checked_at")).limit(clamp_limit(limit)))


def recent_response(metrics: DataFrame, limit: object = DEFAULT_LIMIT) -> DataFrame:
    """Count and rows of the recent view as one JSON text; at most ``MAX_LIMIT`` rows."""
    newest = metrics.orderBy(F.desc("checked_at")).limit(clamp_limit(limit))
    served = newest.select("checked_at", F.struct(*served_fields()).alias("row"))
    rows = F.sort_array(F.collect_list(F.struct("checked_at", "row")), asc=False)
    return served.agg(F.count("*").alias("count"), rows.alias("rows")).select(
        F.to_json(
            F.struct("count", F.transform("rows", lambda r: r["row"]).alias("results")),
        ).alias("body")
    )


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A metric table by day, as ``sinks.write_by_day`` writes it; ``checked_date`` prunes folders."""
    return spark.read.parquet(path).drop("batch_id")


def newest_days(table: DataFrame, rows: int) -> DataFrame:
    """The days of a stored table that hold its newest rows, at least as many as asked for.

    Rows of the days are counted from file footers; all older days are left unread.
    """
    days = table.groupBy("checked_date").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("checked_date")).limit(rows)
    held, first = 0, None
    for day in days.collect():
        held, first = held + day["n"], day["checked_date"]
        if held >= rows:
            break
    return table.where(F.lit(False) if first is None else F.col("checked_date") >= F.lit(first))


def stored_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest metric row of a stored table, or none."""
    return latest(newest_days(stored(spark, path), 1))


def stored_recent(spark: SparkSession, path: str, limit: object = DEFAULT_LIMIT) -> DataFrame:
    """The newest metric rows of a stored table, newest first."""
    return recent(newest_days(stored(spark, path), clamp_limit(limit)), limit)


def stored_market_history(
    spark: SparkSession, path: str, market: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """One market's rows of a stored table, newest first, from and to a day if given."""
    rows = stored(spark, path)
    if since is not None:
        rows = rows.where(F.col("checked_date") >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.where(F.col("checked_date") <= F.lit(until).cast("date"))
    return market_history(rows, market).drop("checked_date")


def market_history(market_metrics: DataFrame, market: str | None = None) -> DataFrame:
    """Metric rows by market, newest first; one market's rows if named."""
    rows = market_metrics if market is None else market_metrics.where(F.col("market") == market)
    return rows.orderBy("market", F.desc("checked_at"))


def experiment_summary(metrics: DataFrame) -> DataFrame:
    """One row on a run: samples, throughput, latency and error rate over its metric rows.

    Throughput is the collected count per row; the 95th percentile is taken over
    the average latency of the rows.
    """
    collected, errors = F.col("total_collected_count"), F.col("total_error_count")
    figures = metrics.agg(
        F.count("*").alias("samples"),
        F.avg(collected).alias("mean_throughput"),
        F.max(collected).alias("max_throughput"),
        F.avg("average_latency_ms").alias("mean_latency_ms"),
        F.max("max_latency_ms").alias("max_latency_ms"),
        (F.try_divide(F.sum(errors), F.sum(collected)) * 100).alias("error_rate_percentage"),
    )
    p95 = F.lit(exact_quantile(metrics, "average_latency_ms", 0.95)).cast("double")
    return figures.select(
        "samples",
        "mean_throughput",
        "max_throughput",
        "mean_latency_ms",
        p95.alias("p95_latency_ms"),
        "max_latency_ms",
        F.coalesce("error_rate_percentage", F.lit(0.0)).alias("error_rate_percentage"),
    )
