import json
import os
import time

import pytest
from pyspark.sql import functions as F
from test_streams import BASE, MINUTE, land, stream_of, tick_row

from tickwatch.operators import serving
from tickwatch.schemas import MARKET_SCHEMA
from tickwatch.streaming import clocks, jobs, runner, sinks


@pytest.fixture
def ticks(spark, texts, tmp_path):
    source = tmp_path / "ticks"
    source.mkdir()
    rows = [tick_row(i, "A" if i % 3 else "Z", BASE + i * 1000, 100 + i) for i in range(900)]
    land(texts, source, [rows[:450], rows[450:]])
    return stream_of(spark, source)


@pytest.fixture
def markets(spark):
    return lambda: spark.createDataFrame([("A",)], "market STRING")


def finished(query):
    end = time.monotonic() + 120
    while not runner.is_closed(query) and not query.exception() and time.monotonic() < end:
        time.sleep(0.2)
    dropped = runner.dropped_late(query)
    query.stop()
    assert runner.is_closed(query) and not query.exception()
    return dropped


def test_health_jobs_count_every_tick(spark, texts, tmp_path):
    # The third file is minutes behind the others, and the input stops with the fourth.
    source = tmp_path / "lagging"
    source.mkdir()
    rows = [tick_row(i, "A" if i % 3 else "Z", BASE + i * 1000, 100 + i) for i in range(400)]
    land(texts, source, [rows[:100], rows[200:300], rows[100:200], rows[300:]])
    ticks = stream_of(spark, source)
    for name, start in (("all", jobs.start_health), ("market", jobs.start_market_health)):
        write, checkpoint = sinks.daily_table(str(tmp_path / name)), str(tmp_path / f"{name}-checkpoint")
        assert finished(start(ticks, write, checkpoint, every="500 milliseconds")) == 0
    whole = serving.stored(spark, str(tmp_path / "all"))
    assert whole.agg(F.sum("total_collected_count")).first()[0] == 400
    by_market = serving.stored(spark, str(tmp_path / "market")).groupBy("market").agg(F.sum("collected_count").alias("n"))
    assert {(r.market, r.n) for r in by_market.collect()} == {("A", 266), ("Z", 134)}


def test_the_arrival_clock_needs_a_stream(spark):
    with pytest.raises(ValueError, match="stream"):
        clocks.with_arrival_clock(spark.range(1))


def test_moves_job(spark, ticks, markets, tmp_path):
    write = sinks.batch_folder(str(tmp_path / "moves"))
    jobs.start_moves(ticks, markets, write, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "moves")).collect()
    # Windows end at minutes 1 to 14; the ticks end just before minute 15.
    assert len(rows) == 14 and {r.market_code for r in rows} == {"A"}
    assert all(r.created_at is not None for r in rows)
    assert max(r.window_end for r in rows).minute == (BASE // MINUTE + 14) % 60


def test_routing_job(spark, ticks, markets, tmp_path):
    out = str(tmp_path / "out")
    jobs.start_routing(ticks, markets, out, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert sinks.read_routed(spark, out, "dead_letter").count() == 900


def test_sync_job(spark, tmp_path):
    path = str(tmp_path / "markets" / "version=1")
    spark.createDataFrame([("OLD", "o", "o", *([False] * 6), True)], MARKET_SCHEMA).write.parquet(path)
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "reply.json").write_text(json.dumps([{"market": "NEW", "korean_name": "새", "english_name": "n"}]))
    path, report = jobs.sync_markets(spark, path, str(tmp_path / "feed"), str(tmp_path / "markets"), "2")
    assert tuple(report.first()) == (1, 0, 1, 1, 1)
    assert {(r.market, r.is_active) for r in spark.read.parquet(path).collect()} == {("OLD", False), ("NEW", True)}


def test_an_older_reply_does_not_hide_a_delisting(spark, tmp_path):
    path = str(tmp_path / "markets" / "version=1")
    rows = [(m, m, m, *([False] * 6), True) for m in ("A", "B")]
    spark.createDataFrame(rows, MARKET_SCHEMA).write.parquet(path)
    feed = tmp_path / "feed"
    feed.mkdir()
    for day, markets in ((1, "AB"), (2, "A")):
        reply = feed / f"{day}.json"
        reply.write_text(json.dumps([{"market": m, "korean_name": m, "english_name": m} for m in markets]))
        os.utime(reply, (1000 + day, 1000 + day))
    path, report = jobs.sync_markets(spark, path, str(feed), str(tmp_path / "markets"), "2")
    assert tuple(report.first()) == (0, 1, 1, 0, 1)
    assert {(r.market, r.is_active) for r in spark.read.parquet(path).collect()} == {("A", True), ("B", False)}
