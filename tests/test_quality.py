import json
import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickwatch.operators import quality
from tickwatch.schemas import STORAGE
from tickwatch.streaming import sinks

GOOD = {
    "type": "ticker", "code": "KRW-A", "opening_price": 1.5, "high_price": 2, "low_price": 1, "trade_price": 1.25,
    "prev_closing_price": 1, "acc_trade_price": 12345678.1234, "change": "RISE", "change_price": 0.25,
    "signed_change_price": -0.25, "change_rate": 0.123456, "signed_change_rate": -0.123456, "ask_bid": "ASK",
    "trade_volume": 0.00000001, "acc_trade_volume": 5, "trade_date": "20240620", "trade_time": "235959",
    "trade_timestamp": 1718942400000, "timestamp": 1718942400001, "acc_ask_volume": 2, "acc_bid_volume": 3,
    "highest_52_week_price": 9, "highest_52_week_date": "2026-01-01", "lowest_52_week_price": 0.1,
    "lowest_52_week_date": "2026-01-01", "market_state": "ACTIVE", "is_trading_suspended": False,
    "delisting_date": None, "market_warning": "NONE", "acc_trade_price_24h": 1, "acc_trade_volume_24h": 1,
    "stream_type": "SNAPSHOT",
}

NEGATIVE = "Negative Value Error: price or volume is negative"


def changed(**values):
    tick = {**GOOD, **values}
    return json.dumps({k: v for k, v in tick.items() if v != "DROP"}, ensure_ascii=False)


@pytest.fixture(scope="module")
def routed(spark, texts):
    markets = spark.createDataFrame([("KRW-A", True), ("KRW-B", False), ("KRW-A", True)], "market STRING, is_active BOOLEAN")

    def run(text):
        return quality.route(texts([(1, 0, text)]), markets)

    return run


def reasons(routed, text):
    row = routed(text).select("error_log", "raw_data", quality.outcome().alias("o")).first()
    assert row.raw_data == text
    assert (row.error_log is None) == (row.o != quality.DEAD)
    return row.error_log


@pytest.mark.parametrize(
    ("text", "log"),
    [
        (changed(), None),
        (changed(trade_price=0), None),
        (changed(trade_price="1.25"), None),
        (changed(code="DROP"), "Missing Field: code"),
        (changed(code=None), "Missing Field: code"),
        (changed(trade_price=None), "Missing Field: trade_price"),
        (changed(timestamp="DROP"), "Missing Field: timestamp"),
        (changed(trade_price=-1), NEGATIVE),
        (changed(trade_volume=-1), NEGATIVE),
        (changed(trade_price="-1"), NEGATIVE),
        (changed(change="UP"), "Invalid Change Type: UP"),
        (changed(change=None), "Invalid Change Type: None"),
        (changed(change="rise"), "Invalid Change Type: rise"),
        (changed(stream_type="DROP"), "Invalid Stream Type: None"),
        ("{not-valid-json", "Malformed JSON"),
        ("[1]", "Malformed JSON"),
        (changed() + " tail", "Malformed JSON"),
        (
            "{}",
            "Missing Field: code | Missing Field: trade_price | Missing Field: timestamp"
            " | Invalid Change Type: None | Invalid Stream Type: None",
        ),
        (
            changed(code="DROP", trade_price=-100, change="X", stream_type="Y"),
            f"Missing Field: code | {NEGATIVE} | Invalid Change Type: X | Invalid Stream Type: Y",
        ),
        (
            '{"trade_price": 50000000, "timestamp": 1718942400000, "stream_type": "REALTIME", "change": "RISE"}',
            "Missing Field: code",
        ),
        (
            '{"code": "KRW-BTC", "trade_price": -100, "timestamp": 1718942400000, "stream_type": "REALTIME", "change": "RISE"}',
            NEGATIVE,
        ),
    ],
)
def test_reasons(routed, text, log):
    assert reasons(routed, text) == log


@pytest.mark.parametrize(
    ("text", "problem"),
    [
        (changed(trade_volume=None), "trade_volume: missing"),
        (changed(trade_volume="DROP"), "trade_volume: missing"),
        (changed(trade_price="abc"), "trade_price: not decimal(20,4)"),
        (changed(change_rate=12345.5), "change_rate: not decimal(10,6)"),
        (changed(high_price="1,234.5"), "high_price: not decimal(20,4)"),
        (changed(trade_price="1,234.5"), "trade_price: not decimal(20,4)"),
        (changed(low_price="1.5d", acc_bid_volume=True), "low_price: not decimal(20,4)"),
        (changed(trade_timestamp="12.7"), "trade_timestamp: not bigint"),
        (changed(is_trading_suspended="maybe"), "is_trading_suspended: not boolean"),
        (changed(ask_bid="ASKS"), "ask_bid: longer than 3"),
        (changed(type=None, market_state="x" * 41), "data_type: missing | market_state: longer than 40"),
    ],
)
def test_storage_problems(routed, text, problem):
    row = quality.unstorable(routed(text)).first()
    assert (row.raw_data, row.save_error) == (text, problem)
    assert quality.stored(routed(text)).count() == 0


def test_numeric_text_is_stored(routed):
    row = quality.stored(routed(changed(high_price="2.5", low_price="1e-1", trade_price=" 3 ", timestamp="7", trade_timestamp=8.9))).first()
    assert (float(row.high_price), float(row.low_price), float(row.trade_price)) == (2.5, 0.1, 3.0)
    assert (row.timestamp, row.trade_timestamp) == (7, 8)


def test_one_odd_value_does_not_change_the_others(routed):
    plain, odd = (quality.stored(routed(changed(**v))).drop("created_at").first() for v in ({}, {"high_price": "2"}))
    assert plain == odd


NUMBERS = [
    "1", "0", "-1", "1.5", "1e3", "1E-7", "-0.0", "0.00005", "0.00015", "0.000049999999999999999999999", "-0.00005",
    "1.23456789012345678901234567890", "9999999999999999.99995", "9999999999999999.99994", "123456789.987654321",
    "99999999999999999999999999", "0.1", "1e30", '"2.5"', '"x"', "true", "null",
]


def test_both_ways_of_reading_agree(spark, texts):
    source = random.Random(23)
    numeric = [c.field for c in STORAGE if c.type.startswith("decimal")]
    plain, odd = [], []
    for _ in range(1500):
        tick = {k: json.dumps(v) for k, v in GOOD.items()}
        for field in source.sample(numeric, 4):
            tick[field] = source.choice(NUMBERS)
        # A flag as text makes the parser object, so that the whole tick is read again.
        for rows, flag in ((plain, "false"), (odd, '"f"')):
            tick["is_trading_suspended"] = flag
            rows.append("{" + ",".join(f'"{k}":{v}' for k, v in tick.items()) + "}")
    markets = spark.createDataFrame([("KRW-A",)], "market STRING")
    results = [
        quality.route(texts([(i, 0, t) for i, t in enumerate(rows)]), markets)
        .orderBy("seq")
        .select("error_log", "save_error", F.to_json("saved"))
        .collect()
        for rows in (plain, odd)
    ]
    assert len({r.save_error for r in results[0]}) > 5
    for text, one, other in zip(plain, *results):
        assert one == other, text


def test_sign_is_taken_before_rounding(routed):
    assert reasons(routed, changed(trade_volume=-0.000000000001)) == NEGATIVE


def test_length_counts_characters(routed):
    assert quality.stored(routed(changed(market_state="한" * 40))).count() == 1


def test_stored_columns(routed):
    frame = quality.stored(routed(changed()))
    assert frame.columns == [c.column for c in STORAGE] + ["created_at"]
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    assert kinds["trade_price"] == "decimal(20,4)" and kinds["acc_ask_volume"] == "decimal(30,8)"
    assert kinds["timestamp"] == "bigint" and kinds["is_trading_suspended"] == "boolean"
    row = frame.first()
    assert (row.market_code, row.data_type) == ("KRW-A", "ticker")
    assert (row.trade_price, row.trade_volume) == (Decimal("1.25"), Decimal("0.00000001"))
    assert row.delisting_date is None and isinstance(row.created_at, datetime)


def test_nested_delisting_date_is_kept(routed):
    assert quality.stored(routed(changed(delisting_date={"day": 1}))).first().delisting_date == '{"day":1}'


def test_inactive_market_is_known_and_unknown_is_skipped(routed):
    assert quality.stored(routed(changed(code="KRW-B"))).count() == 1
    row = quality.skipped(routed(changed(code="KRW-Z"))).first()
    assert row.market_code == "KRW-Z"
    # An unknown market comes before an unfit column.
    both = routed(changed(code="KRW-Z", trade_volume=None))
    assert quality.skipped(both).count() == 1 and quality.unstorable(both).count() == 0


def test_every_tick_has_one_outcome(spark, texts):
    mixed = [changed(), changed(code="KRW-Z"), changed(trade_volume=None), changed(trade_price=-1), "{", "null", None]
    ticks = texts([(i, 0, mixed[i % len(mixed)]) for i in range(700)])
    markets = spark.createDataFrame([("KRW-A",)], "market STRING")
    frame = quality.route(ticks, markets)
    sizes = {name: output(frame).count() for name, output in quality.OUTPUTS.items()}
    assert sizes == {"stored": 100, "skipped": 100, "unstorable": 100, "dead_letter": 400}
    named = {r.o: r["count"] for r in frame.groupBy(quality.outcome().alias("o")).count().collect()}
    assert named == sizes


def test_one_pass_gives_the_same_outputs(spark, texts, tmp_path):
    mixed = [changed(), changed(code="KRW-Z"), changed(trade_volume=None), changed(trade_price=-1), "{", "null"]
    ticks = texts([(i, 0, mixed[i % len(mixed)]) for i in range(60)])
    frame = quality.route(ticks, spark.createDataFrame([("KRW-A",)], "market STRING"))
    sinks.write_routed(frame, str(tmp_path / "routed"))
    for name, output in quality.OUTPUTS.items():
        direct, read = output(frame, ("seq",)), sinks.read_routed(spark, str(tmp_path / "routed"), name, ("seq",))
        assert read.columns == direct.columns
        drop = [c for c in direct.columns if c == "created_at"]
        assert sorted(map(repr, read.drop(*drop).collect())) == sorted(map(repr, direct.drop(*drop).collect()))
        assert read.count() > 0
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan


def test_collapse(spark):
    wide = spark.createDataFrame([("A", None, "why"), ("B", 2.5, "so")], "code STRING, price DOUBLE, error_log STRING")
    got = [tuple(r) for r in quality.dead_letter_collapse(wide).collect()]
    assert got == [('{"code":"A","price":null}', "why"), ('{"code":"B","price":2.5}', "so")]


def test_a_hot_market_is_split(spark, texts):
    ticks = texts([(i, 0, changed(code="KRW-A" if i % 3 else f"KRW-{i}")) for i in range(6000)]).repartition(8)
    markets = spark.createDataFrame([(f"KRW-{i}",) for i in range(0, 6000, 3)] + [("KRW-A",)], "market STRING")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {name: spark.conf.get(name) for name in conf}
    for name, setting in conf.items():
        spark.conf.set(name, setting)
    try:
        counts = quality.route(ticks, markets).groupBy(quality.outcome().alias("o")).agg(F.count("*").alias("n"))
        assert [tuple(r) for r in counts.collect()] == [("stored", 6000)]
        assert "skew=true" in counts._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, setting in before.items():
            spark.conf.set(name, setting)


def test_ticks_of_one_market_from_one_task_reach_many(spark, texts):
    rows = [changed(trade_price=i) for i in range(600)] + [changed(code="KRW-Z", trade_price=i) for i in range(600)]
    ticks = texts([(i, 0, text) for i, text in enumerate([*rows, *["{"] * 600])]).coalesce(1)
    markets = spark.createDataFrame([("KRW-A",), ("KRW-A",), (None,)], "market STRING")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in conf}
    for name, setting in conf.items():
        spark.conf.set(name, setting)
    try:
        frame = quality.route(ticks, markets)
        found = frame.groupBy(quality.outcome().alias("o"), F.spark_partition_id().alias("p")).count().collect()
    finally:
        for name, setting in before.items():
            spark.conf.set(name, setting)
    for outcome in ("stored", "skipped", "dead_letter"):
        counts = [r["count"] for r in found if r.o == outcome]
        assert sum(counts) == 600 and max(counts) <= 400


def test_same_result_without_broadcast(spark, texts):
    ticks = texts([(i, 0, changed(code="KRW-A" if i % 3 else "KRW-Z")) for i in range(60)])
    markets = spark.createDataFrame([("KRW-A",)], "market STRING")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = quality.route(ticks, markets)
        assert "BroadcastHashJoin" not in frame._jdf.queryExecution().executedPlan().toString()
        counts = frame.groupBy(quality.outcome().alias("o")).agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.o: r.n for r in counts} == {"stored": 40, "skipped": 20}
