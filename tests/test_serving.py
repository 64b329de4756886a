import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwatch.operators import serving
from tickwatch.operators.quantiles import exact_quantile
from tickwatch.streaming import sinks
from tickwatch.schemas import HEALTH_COLUMNS

SCHEMA = "ms BIGINT, " + ", ".join(f"{n} {k}" for n, k in HEALTH_COLUMNS.items() if n != "checked_at")


def metrics(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select(F.timestamp_millis("ms").alias("checked_at"), *[n for n in HEALTH_COLUMNS if n != "checked_at"])


def row(ms, count=10, errors=1, latency=5.0, peak=9.0):
    return (ms, "1s", count, errors, errors / count * 100, latency, peak, 3, 100.0)


def test_latest_and_recent(spark):
    frame = metrics(spark, [row(ms * 1000) for ms in random.Random(1).sample(range(1000), 1000)])
    assert serving.latest(frame).first().checked_at == "1970-01-01T00:16:39+00:00"
    newest = [r.checked_at for r in serving.recent(frame, 3).collect()]
    assert newest == [f"1970-01-01T00:16:3{s}+00:00" for s in (9, 8, 7)]
    assert serving.recent(frame).count() == 60
    assert serving.recent(frame, 100000).count() == 300


@pytest.mark.parametrize(
    ("asked", "given"),
    [(None, 60), ("x", 60), ("5", 5), (0, 1), (-3, 1), (300, 300), (301, 300), ("1.5", 60), (" 7 ", 7)],
)
def test_limit(asked, given):
    assert serving.clamp_limit(asked) == given


def test_responses(spark):
    frame = metrics(spark, [row(1000), row(2500), row(2000)])
    body = json.loads(serving.latest_response(frame).first().body)
    assert list(body) == list(HEALTH_COLUMNS)
    assert body["checked_at"] == "1970-01-01T00:00:02.500000+00:00" and body["total_collected_count"] == 10
    recent = json.loads(serving.recent_response(frame, 2).first().body)
    assert recent["count"] == 2
    assert [r["checked_at"] for r in recent["results"]] == [
        "1970-01-01T00:00:02.500000+00:00",
        "1970-01-01T00:00:02+00:00",
    ]


def test_responses_without_data(spark):
    frame = metrics(spark, [])
    assert json.loads(serving.latest_response(frame).first().body) == {"message": "No metric data yet"}
    assert json.loads(serving.recent_response(frame).first().body) == {"count": 0, "results": []}
    assert serving.latest(frame).count() == 0


def test_history(spark):
    rows = [("B", 1), ("A", 1), ("A", 3), ("B", 2), ("A", 2)]
    frame = spark.createDataFrame(rows, "market STRING, ms BIGINT").withColumn("checked_at", F.timestamp_millis("ms"))
    assert [(r.market, r.ms) for r in serving.market_history(frame).collect()] == [
        ("A", 3), ("A", 2), ("A", 1), ("B", 2), ("B", 1),
    ]
    assert [r.ms for r in serving.market_history(frame, "B").collect()] == [2, 1]


def quantile(spark, numbers, q, accuracy=10000, few=100):
    df = spark.createDataFrame([(x,) for x in numbers], "x DOUBLE").repartition(4)
    return exact_quantile(df, "x", q, accuracy, few)


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.95, 0.999, 1.0])
@pytest.mark.parametrize("shape", ["spread", "hot", "few", "one"])
def test_quantile(spark, q, shape):
    source = random.Random(2)
    numbers = {
        "spread": [source.uniform(0, 1e6) for _ in range(5000)],
        "hot": [7.0 if source.random() < 0.4 else source.uniform(-10, 10) for _ in range(5000)],
        "few": [3.0, 1.0, 2.0],
        "one": [4.0],
    }[shape]
    # A rough sketch still has to lead to the exact value.
    for accuracy in (10000, 100):
        assert quantile(spark, numbers, q, accuracy) == pytest.approx(np.quantile(numbers, q), rel=1e-12)


def test_quantile_of_nothing(spark):
    assert quantile(spark, [], 0.95) is None
    assert quantile(spark, [None, 2.0, None], 0.95) == 2.0


def test_summary(spark):
    rows = [row(s * 1000, count=10 + s % 7, errors=s % 3, latency=float(s), peak=float(s * 2)) for s in range(1, 301)]
    got = serving.experiment_summary(metrics(spark, rows)).first()
    counts = [r[2] for r in rows]
    assert got.samples == 300 and got.max_throughput == 16 and got.max_latency_ms == 600.0
    assert got.mean_throughput == pytest.approx(np.mean(counts))
    assert got.mean_latency_ms == pytest.approx(150.5)
    assert got.p95_latency_ms == pytest.approx(np.quantile([r[5] for r in rows], 0.95))
    assert got.error_rate_percentage == pytest.approx(sum(r[3] for r in rows) / sum(counts) * 100)


def test_summary_of_nothing(spark):
    got = serving.experiment_summary(metrics(spark, [])).first()
    assert (got.samples, got.p95_latency_ms, got.error_rate_percentage) == (0, None, 0.0)


def test_stored_rows_are_read_from_the_newest_days(spark, tmp_path):
    rows = [row(s * 7200000, count=s) for s in range(1, 60)]
    path = str(tmp_path / "t")
    sinks.write_by_day(metrics(spark, rows), path, 0)
    assert serving.stored_latest(spark, path).first().total_collected_count == 59
    got = serving.stored_recent(spark, path, 20)
    assert [r.total_collected_count for r in got.collect()] == list(range(59, 39, -1))
    assert len({f.split("checked_date=")[1][:10] for f in got.inputFiles()}) == 5 or "PartitionFilters" in str(
        got._jdf.queryExecution().executedPlan()
    )
    empty = str(tmp_path / "none")
    sinks.write_by_day(metrics(spark, rows), empty, 0)
    assert serving.newest_days(serving.stored(spark, empty).limit(0), 5).count() == 0


def rows_scanned(df):
    """Rows that the scan of a collected frame gave to the filter above it."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_one_markets_history_reads_few_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROW_GROUP_BYTES", 4096)
    rows = spark.range(200 * 300).select(
        F.timestamp_seconds(F.col("id") % 300 * 60).alias("checked_at"),
        F.format_string("M%04d", (F.col("id") / 300).cast("int") * 2).alias("market"),
        F.col("id").alias("collected_count"),
    )
    path = str(tmp_path / "history")
    sinks.write_by_day(rows, path, 0)
    table = serving.stored(spark, path)
    one = table.where("market = 'M0100'")
    assert one.count() == 300 and rows_scanned(one) < 3000
    # A market that is not there lies between others; its Bloom filters leave nothing to read.
    assert rows_scanned(table.where("market = 'M0101'")) == 0
    assert rows_scanned(table.where("collected_count >= 0")) == 60_000
