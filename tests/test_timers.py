import time

import pytest
from helpers import at
from pyspark.sql import functions as F
from test_streams import BASE, land, stream_of, tick_row

from tickwatch.operators.ticks import metric_events
from tickwatch.plans import views
from tickwatch.streaming import jobs, runner, sinks, timers

EVENTS = "market STRING, is_error BOOLEAN, latency_ms DOUBLE, trade_amount_krw DOUBLE"


@pytest.fixture
def ticks(spark, texts, tmp_path):
    source = tmp_path / "ticks"
    source.mkdir()
    rows = [tick_row(i, "A" if i % 3 else "Z", BASE + i * 1000, 100 + i) for i in range(400)]
    rows += [(400, BASE, "{not a tick"), tick_row(401, None, BASE, 5)]
    # The third file is minutes behind the others.
    land(texts, source, [rows[:100], rows[200:300], rows[100:200], rows[300:]])
    return stream_of(spark, source)


def run(start, ticks, folder, **how):
    query = start(ticks, sinks.batch_folder(f"{folder}/rows"), f"{folder}/checkpoint", every="500 milliseconds", **how)
    runner.wait_until_closed(query, 120)
    assert query.exception() is None
    return query


def test_buckets_close_without_clock_rows(spark, ticks, tmp_path):
    query = run(jobs.start_timed_health, ticks, tmp_path)
    rows = spark.read.parquet(f"{tmp_path}/rows").orderBy("checked_at").collect()
    assert sum(r.total_collected_count for r in rows) == 402 and sum(r.total_error_count for r in rows) == 2
    assert sum(r.total_trade_volume_krw for r in rows) == sum(100 + i for i in range(400))
    assert len({r.checked_at for r in rows}) == len(rows) and all(r.time_unit == "1s" for r in rows)
    assert all(r.unique_market_count in (1, 2) for r in rows)
    # One source, and no row in the job but the ticks.
    sources = [[s["description"] for s in p["sources"]] for p in query.recentProgress]
    assert all(len(names) == 1 and "FileStreamSource" in names[0] for names in sources)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 402


def test_market_buckets(spark, ticks, tmp_path):
    run(jobs.start_timed_market_health, ticks, tmp_path, bucket="2 seconds")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    found = rows.groupBy("market").agg(F.sum("collected_count").alias("n"), F.sum("error_count").alias("e")).collect()
    assert {tuple(r) for r in found} == {("A", 266, 0), ("Z", 134, 0), ("UNKNOWN", 2, 1)}
    assert rows.where("unix_millis(checked_at) % 2000 <> 0").count() == 0


def test_a_job_that_is_stopped_and_started_again_counts_each_tick_once(spark, ticks, tmp_path):
    write, checkpoint = sinks.batch_folder(f"{tmp_path}/rows"), f"{tmp_path}/checkpoint"
    query = jobs.start_timed_health(ticks, write, checkpoint, bucket="5 seconds", every="500 milliseconds")
    while not query.lastProgress:
        time.sleep(0.1)
    query.stop()
    query = jobs.start_timed_health(ticks, write, checkpoint, bucket="5 seconds", every="500 milliseconds")
    runner.wait_until_closed(query, 120)
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert rows.agg(F.sum("total_collected_count")).first()[0] == 402
    assert rows.select("checked_at").distinct().count() == rows.count()


class Value:
    """A state that holds one value, as the engine's does."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Handle:
    def __init__(self):
        self.timers, self.state = set(), Value()

    def getValueState(self, name, schema):
        return self.state

    def registerTimer(self, ms):
        self.timers.add(ms)


class Now:
    def __init__(self, ms):
        self.ms = ms

    getCurrentProcessingTimeInMs = getExpiryTimeInMs = lambda self: self.ms


def share(n, errors=0, latency=None):
    return {"collected": n, "errors": errors, "latency_sum": latency, "latency_max": latency, "amount": latency}


def test_steps_of_a_bucket():
    handle, buckets = Handle(), timers.Buckets(1000)
    buckets.init(handle)
    assert list(buckets.handleInputRows(("A",), [share(2, 1, 5.0), share(1, 1)], Now(5100))) == []
    assert handle.timers == {6000} and handle.state.value == (5000, 3, 2, 5.0, 5.0, 5.0)
    # Later ticks of the same bucket, then of a clock that was set back.
    assert list(buckets.handleInputRows(("A",), [share(1, 0, 7.0)], Now(5900))) == []
    assert list(buckets.handleInputRows(("A",), [share(1, 0, 1.0)], Now(4200))) == []
    assert handle.state.value == (5000, 5, 2, 13.0, 7.0, 13.0)
    # Ticks of the next bucket come with the batch in which the timer runs out: one row, by either way.
    (row,) = buckets.handleInputRows(("A",), [share(4)], Now(6500))
    assert (row.market, row.bucket_ms, row.collected, row.latency_max) == ("A", 5000, 5, 7.0)
    assert list(buckets.handleExpiredTimer(("A",), Now(6500), Now(6000))) == []
    (row,) = buckets.handleExpiredTimer(("A",), Now(9000), Now(7000))
    assert (row.bucket_ms, row.collected, row.latency_sum) == (6000, 4, None)
    assert list(buckets.handleExpiredTimer(("A",), Now(9000), Now(8000))) == [] and not handle.state.exists()


def test_shares_are_folded_by_market(spark):
    rows = [("A", False, 5.0, 2.0), ("A", False, 7.0, 3.0), ("A", True, 0.0, 0.0), (None, True, 0.0, 0.0), ("B", True, 0.0, 0.0)]
    folded = timers.folded(spark.createDataFrame(rows * 100, EVENTS).coalesce(1)).collect()
    assert sorted(map(tuple, folded), key=repr) == sorted(
        [("A", 300, 100, 1200.0, 7.0, 500.0), ("B", 100, 100, None, None, None), (None, 100, 100, None, None, None)], key=repr
    )
    assert timers.folded(spark.createDataFrame([], EVENTS)).count() == 0


def test_shares_of_several_arrow_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        rows = spark.range(100).selectExpr("concat('M', id % 3) AS market", "id % 10 = 0 AS is_error", "1.0D AS latency_ms", "2.0D AS trade_amount_krw")
        folded = {r.market: tuple(r)[1:] for r in timers.folded(rows.coalesce(1)).collect()}
    finally:
        spark.conf.set(name, before)
    assert folded == {"M0": (34, 4, 30.0, 1.0, 60.0), "M1": (33, 3, 30.0, 1.0, 60.0), "M2": (33, 3, 30.0, 1.0, 60.0)}


def test_whole_figures_of_closed_buckets(spark):
    closed = spark.createDataFrame([("A", 5000, 3, 1, 9.0, 5.0, 2.0), ("B", 5000, 1, 1, None, None, None)], timers.CLOSED)
    row = timers.whole_health(closed).first()
    assert tuple(row) == (at(6000), "1s", 4, 2, 50.0, 4.5, 5.0, 1, 2.0)
    by_market = timers.market_health(closed).orderBy("market").collect()
    assert [tuple(r) for r in by_market] == [
        (at(6000), "A", "1s", 3, 1, 1 / 3 * 100, 4.5, 5.0, 2.0), (at(6000), "B", "1s", 1, 1, 100.0, 0.0, 0.0, 0.0),
    ]


def test_an_empty_table_ends(spark, tmp_path):
    source = str(tmp_path / "none")
    views.ticks(spark, "/root/testdata/sf0.001").where("false").write.parquet(source)
    run(jobs.start_timed_health, stream_of(spark, source), tmp_path)
    events = metric_events(spark.read.parquet(source))
    assert events.count() == 0 and spark.read.parquet(f"{tmp_path}/rows").count() == 0
