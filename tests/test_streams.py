import json
import os

import pytest
from helpers import at
from pyspark.sql import functions as F

from tickwatch import settings
from tickwatch.operators import metrics, moves, quality, serving
from tickwatch.operators.ticks import metric_events
from tickwatch.plans.queries import QUERIES
from tickwatch.sources.files import read_tick_lines, stream_table
from tickwatch.streaming import clocks, runner, sinks

MINUTE = 60000
BASE = 1718942400000
SCHEMA = "seq BIGINT, ingest_time TIMESTAMP, value STRING"


def land(texts, folder, batches):
    """Write each batch of (seq, ingest ms, text) rows as one file, in order."""
    for number, rows in enumerate(batches):
        target = f"{folder}/part-{number}.parquet"
        frame = texts(rows).toPandas()
        frame["ingest_time"] = frame["ingest_time"].dt.tz_localize("UTC").astype("datetime64[us, UTC]")
        frame.to_parquet(target)
        os.utime(target, (1000 + number, 1000 + number))


def tick_row(seq, code, ms, price, volume=1):
    text = json.dumps({"code": code, "trade_price": price, "trade_volume": volume, "timestamp": ms})
    return (seq, ms + 100, text)


def stream_of(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


@pytest.fixture
def late_files(texts, tmp_path):
    land(
        texts,
        tmp_path,
        [
            [tick_row(1, "A", BASE, 100.0), tick_row(2, "A", BASE + 10 * MINUTE, 110.0)],
            # Behind the watermark of minute 10: the first row's windows are all closed, the second's are not.
            [tick_row(3, "A", BASE + 1, 1.0), tick_row(4, "A", BASE + 8 * MINUTE, 105.0)],
            [tick_row(5, "A", BASE + 20 * MINUTE, 120.0), tick_row(6, "B", BASE + 30 * MINUTE, 1.0)],
        ],
    )
    return tmp_path


def test_late_rows(spark, late_files):
    stream = moves.price_moves(stream_of(spark, late_files), delay="1 second")
    with runner.drop_late_at_once(spark):
        got = {(r.window_end, r.start_price, r.end_price) for r in runner.run_available(stream, "late").collect()}
    # The late first row is lost; the second counts in the windows still open, with its own pane long closed.
    wanted = {(at(BASE + m * MINUTE), 100.0, 100.0) for m in (1, 2, 3, 4, 5)}
    wanted |= {(at(BASE + 10 * MINUTE), 105.0, 105.0)}
    wanted |= {(at(BASE + m * MINUTE), 105.0, 110.0) for m in (11, 12, 13)}
    wanted |= {(at(BASE + m * MINUTE), 110.0, 110.0) for m in (14, 15)}
    wanted |= {(at(BASE + m * MINUTE), 120.0, 120.0) for m in (21, 22, 23, 24, 25)}
    # The window that ends at minute 9 was closed by then, a second behind minute 10.
    assert got == wanted


def test_stream_conf_is_put_back(spark):
    name = "spark.sql.streaming.statefulOperator.allowMultiple"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), runner.drop_late_at_once(spark):
        assert spark.conf.get(name) == "false"
        raise RuntimeError
    assert spark.conf.get(name) == before


@pytest.fixture
def steady_files(texts, tmp_path):
    rows = [tick_row(i, "HOT" if i % 3 == 0 else f"M{i % 5}", BASE + i * 700, 100 + i % 13, i % 4) for i in range(900)]
    land(texts, tmp_path, [rows[i : i + 300] for i in (0, 300, 600)])
    return tmp_path


def closed(batch, column, last_ms):
    return sorted(tuple(r) for r in batch.where(F.col(column) <= F.timestamp_millis(F.lit(last_ms))).collect())


@pytest.mark.parametrize("rules", ["global", "market"])
def test_health_streams_match_their_batch_twins(spark, steady_files, rules):
    operator = metrics.health_metrics if rules == "global" else metrics.market_metrics
    stream = metric_events(clocks.with_ingest_clock(stream_of(spark, steady_files)), rules)
    got = sorted(tuple(r) for r in runner.run_available(operator(stream, "10 seconds"), "twin").collect())
    batch = operator(metric_events(spark.read.parquet(str(steady_files)), rules), "10 seconds")
    assert got and got == closed(batch, "checked_at", BASE + 899 * 700 + 100)


def test_moves_stream_matches_its_batch_twin(spark, steady_files):
    stream = moves.price_moves(stream_of(spark, steady_files), delay="1 second")
    got = sorted(tuple(r) for r in runner.run_available(stream, "twin").collect())
    batch = moves.price_moves(spark.read.parquet(str(steady_files)))
    assert got and got == closed(batch, "window_end", BASE + 899 * 700 - 1000)


def test_a_restarted_stream_goes_on(spark, texts, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    source.mkdir()
    rows = [tick_row(i, "A", BASE + i * 1000, 100 + i) for i in range(600)]
    for number, part in enumerate((rows[:300], rows[300:])):
        land(texts, source, [[]] * number + [part])
        stream = moves.price_moves(stream_of(spark, source), delay="1 second")
        runner.start_files(stream, out, checkpoint, available_now=True).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*stream.columns).collect())
    batch = moves.price_moves(texts(rows))
    assert got == closed(batch, "window_end", BASE + 599000 - 1000)


def test_routed_outputs_arrive_once(spark, texts, tmp_path):
    good = {"code": "KRW-A", "trade_price": 1, "timestamp": 1, "change": "RISE", "stream_type": "REALTIME"}
    messages = [json.dumps(good), json.dumps({**good, "code": "X"}), "{", json.dumps({**good, "trade_price": -1})]
    ticks = texts([(i, 0, messages[i % 4]) for i in range(40)])
    markets = spark.createDataFrame([("KRW-A",)], "market STRING")
    write = sinks.routed_outputs(lambda: markets, str(tmp_path))
    for batch_id in (0, 1, 1):
        write(ticks, batch_id)
    sizes = {o: sinks.read_routed(spark, str(tmp_path), o).count() for o in quality.OUTPUTS}
    assert sizes == {"stored": 0, "dead_letter": 40, "skipped": 20, "unstorable": 20}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_routed_stream_of_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"code":"A"}\n{broken\n')
    markets = spark.createDataFrame([("A",)], "market STRING")
    stream = read_tick_lines(spark, str(tmp_path / "in"), streaming=True)
    write = sinks.routed_outputs(lambda: markets, str(tmp_path / "out"))
    runner.start_batches(stream, write, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    dead = sinks.read_routed(spark, str(tmp_path / "out"), "dead_letter")
    assert sorted(dead.collect()) == sorted(dead.collect())
    logs = {r.error_log.split(" | ")[0] for r in dead.collect()}
    assert logs == {"Malformed JSON", "Missing Field: trade_price"}


def test_market_metric_table_layout(spark, tmp_path):
    rows = [(f"M{i % 7}", BASE + i * 3600000) for i in range(200)]
    frame = spark.createDataFrame(rows, "market STRING, ms BIGINT").withColumn("checked_at", F.timestamp_millis("ms"))
    for batch_id in (3, 3):
        sinks.write_by_day(frame, str(tmp_path / "t"), batch_id)
    back = serving.stored(spark, str(tmp_path / "t"))
    assert back.count() == 200
    day = [p for p in os.listdir(tmp_path / "t" / "batch_id=3") if p.startswith("checked_date=")]
    assert len(day) == len({ms // 86400000 for _, ms in rows})
    one = serving.stored_market_history(spark, str(tmp_path / "t"), "M3", since="2024-06-22")
    assert [r.ms for r in one.collect()] == sorted((ms for m, ms in rows if m == "M3" and ms >= 1719014400000), reverse=True)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "checked_date" in plan.split("PartitionFilters")[1][:120] and "EqualTo(market,M3)" in plan


def test_stream_table_reads_a_file_or_a_folder(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "folder.parquet"))
    part = next(p for p in os.listdir(tmp_path / "folder.parquet") if p.endswith(".parquet"))
    os.link(tmp_path / "folder.parquet" / part, tmp_path / "single.parquet")
    for name in ("folder", "single"):
        stream = stream_table(spark, str(tmp_path), name, max_files=5)
        assert runner.run_available(stream, "read").count() == 10


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert settings.shared_dir(spark) == named
    assert settings.run_dir(spark, "x").startswith(f"{named}/tickwatch/x-")
    assert settings.run_dir(spark, "x") != settings.run_dir(spark, "x")
    assert settings.as_table(spark.range(3), "numbers").count() == 3


def test_stream_queries_write_under_the_shared_folder(spark):
    result = QUERIES["monotone_watermark_echo"](spark, "/root/testdata/sf0.001")
    assert all(settings.shared_dir(spark) in path for path in result.inputFiles())


def test_console_sink_runs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"code":"SEEN"}\n')
    query = sinks.to_console(read_tick_lines(spark, str(tmp_path / "in"), streaming=True), str(tmp_path / "checkpoint"))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None and query.lastProgress["numInputRows"] in (0, 1)
