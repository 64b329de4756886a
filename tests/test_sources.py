import json
import os

import pytest
from pyspark.sql import functions as F

from tickwatch.operators.markets import flatten_feed, sync_snapshot
from tickwatch.sources import files, jdbc, kafka


def item(market, korean, **flags):
    return {
        "market": market,
        "korean_name": korean,
        "english_name": korean.upper(),
        "market_event": {"warning": False, "caution": flags},
    }


def test_market_feed_is_the_newest_reply_in_array_order(spark, tmp_path):
    replies = [[item("B", "later")], [item("A", "first"), item("B", "b"), item("A", "second", PRICE_FLUCTUATIONS=True)]]
    for number, reply in enumerate(replies):
        path = tmp_path / f"reply-{1 - number}.json"
        path.write_text(json.dumps(reply, indent=1, ensure_ascii=False))
        os.utime(path, (1000 + number, 1000 + number))
    feed = files.read_market_feed(spark, str(tmp_path))
    assert feed.count() == 3
    got = {r.market: (r.korean_name, r.price_fluc) for r in flatten_feed(feed).collect()}
    assert got == {"A": ("second", True), "B": ("b", False)}


ONE = '{"market":"A","korean_name":"a","english_name":"a"}'


@pytest.mark.parametrize(
    "reply",
    [
        '{"error": "limit"}', "[{", '[{"market": "A"}]', '[{"market": 1, "korean_name": ["x"]', "", "  \n", "null", ONE, "[]",
        f"[{ONE}] garbage", f"[{ONE}][{ONE}]", f'[{ONE}],"x":[1]', f"[{ONE}]}}", f"{ONE},{ONE}",
    ],
)
def test_a_broken_reply_fails(spark, tmp_path, reply):
    (tmp_path / "a.json").write_text(reply)
    with pytest.raises(Exception, match="feed entry without|MALFORMED|not one list|feed reply is empty"):
        files.read_market_feed(spark, str(tmp_path)).collect()


def test_an_empty_reply_may_be_allowed(spark, tmp_path):
    (tmp_path / "a.json").write_text(" [ ] \n")
    assert files.read_market_feed(spark, str(tmp_path), allow_empty=True).count() == 0


def lined(entries):
    return "".join(f"{',' if n else '['}{entry}\n" for n, entry in enumerate(entries)) + "]\n"


def test_a_reply_with_an_entry_a_line_is_read_in_splits(spark, tmp_path):
    items = [item(f"M{n % 700}", f"k{n}, [\u00e9] }}{{ \"", PRICE_FLUCTUATIONS=n % 3 == 0) for n in range(1000)]
    (tmp_path / "old.json").write_text("[")
    os.utime(tmp_path / "old.json", (1000, 1000))
    path = tmp_path / "new.json"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = []
        for reply in (lined(map(json.dumps, items)), json.dumps(items)):
            path.write_text(reply)
            feed = files.read_market_feed(spark, str(tmp_path))
            rows = feed.withColumn("task", F.spark_partition_id()).orderBy("seq").collect()
            assert [row.seq for row in rows] == [*range(1000)]
            found.append([(row.market, row.korean_name, row.market_event.caution.PRICE_FLUCTUATIONS) for row in rows])
        assert found[0] == found[1] == [(one["market"], one["korean_name"], one["market_event"]["caution"]["PRICE_FLUCTUATIONS"]) for one in items]
        path.write_text(lined(map(json.dumps, items)))
        plan = files.read_market_feed(spark, str(tmp_path))
        plan.collect()
        # No task holds the whole reply: the entries come from several files of lines.
        assert len(plan.inputFiles()) > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


TWO = '{"market":"B","korean_name":"b","english_name":"b"}'


@pytest.mark.parametrize(
    "lines",
    [
        [f"[{ONE}", f",{TWO}"], [f"[{ONE}", f",{TWO}", "]", "]"], [f"[{ONE}", f"[{TWO}", "]"], [f",{ONE}", f",{TWO}", "]"],
        [f"[{ONE}", f",{TWO}", "]", f",{TWO}"], [f"[{ONE}", f",{TWO}],[{ONE}", "]"], [f"[{ONE}", ',{"market":"B"}', "]"],
        [f"[{ONE}", ",1", "]"], [f"[{ONE}", f",{TWO},", "]"], [f"[{ONE}", f"{TWO}", "]"], ["[", "]"],
    ],
)
def test_a_broken_reply_of_lines_fails(spark, tmp_path, lines):
    (tmp_path / "a.json").write_text("\n".join(lines))
    with pytest.raises(Exception, match="feed entry without|MALFORMED|not one list|feed reply is empty"):
        files.read_market_feed(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("reply", [f"[{ONE}\n,{TWO}\n]", f"[\n{ONE},\n{TWO}\n]", f" [ {ONE}\r\n , {TWO}\r\n]\r\n", f"\n[{ONE},{TWO}\n\n]"])
def test_a_reply_may_have_any_layout(spark, tmp_path, reply):
    (tmp_path / "a.json").write_bytes(reply.encode())
    assert [(r.seq, r.market) for r in files.read_market_feed(spark, str(tmp_path)).collect()] == [(0, "A"), (1, "B")]


def test_markets_round_trip(spark, tmp_path):
    feed_dir = tmp_path / "feed"
    feed_dir.mkdir()
    (feed_dir / "a.json").write_text(json.dumps([item("A", "a")]))
    none = spark.createDataFrame([], files.MARKET_SCHEMA)
    snapshot = sync_snapshot(none, files.read_market_feed(spark, str(feed_dir)))
    path = files.write_markets(snapshot, str(tmp_path / "markets"), "20240101")
    back = files.read_markets(spark, path)
    assert [tuple(r) for r in files.market_codes(back).collect()] == [("A",)]
    plan = files.market_codes(back)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<market:string>" in plan


def test_kafka_records_become_ticks(spark):
    record = spark.createDataFrame([(b'{"code":"A"}', 7, 1500)], "value BINARY, offset BIGINT, ms BIGINT")
    ticks = kafka.from_records(record.withColumn("timestamp", F.timestamp_millis("ms")))
    assert ticks.columns == ["value", "seq", "ingest_time"]
    assert ticks.first().value == '{"code":"A"}' and ticks.first().seq == 7


def test_jdbc_append_options():
    options = jdbc.append_options("jdbc:x", "t", {"user": "u"}, jdbc.MOVES_BATCH)
    assert options == {"url": "jdbc:x", "dbtable": "t", "batchsize": "50", "user": "u"}


def test_jobs_append_with_their_batch_sizes():
    for make in (jdbc.health_appender, jdbc.market_health_appender, jdbc.moves_appender):
        assert callable(make("jdbc:x", "t", {}, connections=2))
