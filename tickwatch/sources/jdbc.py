"""Tables in a relational database."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Rows per insert of the sinks.
HEALTH_BATCH, MARKET_HEALTH_BATCH, MOVES_BATCH = 1, 50, 50


def read_table(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], split: Mapping[str, str] | None = None
) -> DataFrame:
    """Read a table; ``split`` (partitionColumn, lowerBound, upperBound, numPartitions) reads it in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    return reader.options(**(split or {})).load()


def append_options(url: str, table: str, properties: Mapping[str, str], rows_per_insert: int) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(rows_per_insert), **properties}


def appender(
    url: str,
    table: str,
    properties: Mapping[str, str],
    rows_per_insert: int = 1000,
    connections: int = 8,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends to a table over few connections.

    The batch is computed in its own partitions and then dealt out to the
    connections. Appends are at least once: a batch that is run again inserts again.
    """
    options = append_options(url, table, properties, rows_per_insert)

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.repartition(connections).write.format("jdbc").options(**options).mode("append").save()

    return append


def health_appender(url: str, table: str, properties: Mapping[str, str], **how) -> Callable[[DataFrame, int], None]:
    """Appends health metrics as they come, for ``jobs.start_health``."""
    return appender(url, table, properties, HEALTH_BATCH, **how)


def market_health_appender(url: str, table: str, properties: Mapping[str, str], **how) -> Callable[[DataFrame, int], None]:
    """Appends market health metrics, for ``jobs.start_market_health``."""
    return appender(url, table, properties, MARKET_HEALTH_BATCH, **how)


def moves_appender(url: str, table: str, properties: Mapping[str, str], **how) -> Callable[[DataFrame, int], None]:
    """Appends price moves, for ``jobs.start_moves``."""
    return appender(url, table, properties, MOVES_BATCH, **how)
