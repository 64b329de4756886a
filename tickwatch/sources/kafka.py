"""Ticks from and to a Kafka topic."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "ticker"


def read_options(
    servers: str,
    topic: str = TOPIC,
    starting: str = "latest",
    group_prefix: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    partitions: Sequence[int] | None = None,
) -> dict[str, str]:
    """Options of the connector that reads a topic, or the named partitions of it."""
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": starting}
    if partitions is None:
        options["subscribe"] = topic
    else:
        options["assign"] = json.dumps({topic: list(partitions)})
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_ticks(spark: SparkSession, servers: str, topic: str = TOPIC, **how) -> DataFrame:
    """Stream of a topic's ticks. Needs the Kafka connector on the session's classpath.

    ``how`` are the arguments of ``read_options``; ``min_partitions`` splits a hot topic
    partition over several tasks.
    """
    return from_records(spark.readStream.format("kafka").options(**read_options(servers, topic, **how)).load())


def read_splits(spark: SparkSession, servers: str, partitions: Sequence[int], topic: str = TOPIC, **how) -> list[DataFrame]:
    """A stream for each topic partition, for ``streaming.splits``."""
    return [read_ticks(spark, servers, topic, partitions=[number], **how) for number in partitions]


def from_records(records: DataFrame) -> DataFrame:
    """Kafka records as ticks: the text, its arrival number and the time it came in.

    Offsets order the ticks of one partition. Ticks of equal time in different
    partitions have no order, which is why a topic should be keyed by market.
    """
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.col("offset").alias("seq"),
        F.col("timestamp").alias("ingest_time"),
    )


def write_ticks(envelope: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC):
    """Start publishing a stream of key and value."""
    return (
        envelope.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
