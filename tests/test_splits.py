import json

import pytest
from pyspark.sql import functions as F
from test_streams import BASE, MINUTE, land, stream_of, tick_row

from tickwatch.operators import moves
from tickwatch.sources import kafka
from tickwatch.streaming import jobs, runner, sinks, splits


@pytest.fixture
def folders(texts, tmp_path):
    """Three folders read at once, and one that is read minute by minute, far behind."""
    for name in "abcd":
        (tmp_path / name).mkdir()
        rows = [tick_row(i, name, BASE + i * MINUTE, 100 + i) for i in range(20)]
        land(texts, tmp_path / name, [rows[at : at + 2] for at in range(0, 20, 2)] if name == "d" else [rows])
    return [tmp_path / name for name in "abcd"]


def windows(ticks, delay="1 second"):
    return moves.graded(moves.window_prices(ticks, "5 minutes", "1 minute"))


def test_no_split_makes_the_ticks_of_another_late(spark, folders):
    streams = [stream_of(spark, folder) for folder in folders]
    with splits.least_watermark(spark), runner.drop_late_at_once(spark):
        found = runner.run_available(splits.price_moves(streams), "splits")
    # One more minute is open at the end than is closed.
    table = spark.read.parquet(*map(str, folders))
    wanted = moves.price_moves(table).where(F.col("window_end") <= F.timestamp_millis(F.lit(BASE + 18 * MINUTE + 59_000)))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert found.where("market_code = 'd'").count() == found.where("market_code = 'a'").count() > 15


def test_one_watermark_over_all_loses_them(spark, folders):
    ticks = None
    for folder in folders:
        part = moves.priced_ticks(stream_of(spark, folder))
        ticks = part if ticks is None else ticks.unionByName(part)
    with runner.drop_late_at_once(spark):
        found = runner.run_available(windows(ticks.withWatermark("event_time", "1 second")), "one-watermark")
    assert found.where("market_code = 'd'").count() < found.where("market_code = 'a'").count()


def test_the_policy_is_put_back(spark):
    before = spark.conf.get(splits._POLICY)
    with splits.least_watermark(spark):
        assert spark.conf.get(splits._POLICY) == "min"
    assert spark.conf.get(splits._POLICY) == before
    with pytest.raises(ValueError, match="split"):
        splits.united([])


def test_split_moves_job(spark, folders, tmp_path):
    markets = lambda: spark.createDataFrame([("d",)], "market STRING")
    streams = [stream_of(spark, folder) for folder in folders]
    write = sinks.batch_folder(str(tmp_path / "moves"))
    jobs.start_split_moves(streams, markets, write, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "moves"))
    assert found.select("market_code").distinct().collect() == [("d",)] and found.count() > 15


def test_options_of_topic_partitions():
    options = kafka.read_options("b:1", "t", partitions=[0, 2], max_offsets_per_trigger=9)
    assert json.loads(options["assign"]) == {"t": [0, 2]} and "subscribe" not in options
    assert options["maxOffsetsPerTrigger"] == "9" and options["startingOffsets"] == "latest"
    assert kafka.read_options("b:1", "t", group_prefix="g", min_partitions=3) == {
        "kafka.bootstrap.servers": "b:1", "startingOffsets": "latest", "subscribe": "t", "groupIdPrefix": "g", "minPartitions": "3",
    }
