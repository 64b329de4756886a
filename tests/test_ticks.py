import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tickwatch.operators.ticks import (
    decode,
    metric_events,
    publish_envelope,
    publish_rejects,
    rename_long,
    to_json_value,
)

NOW = 1718942400500

MESSAGES = [
    '{"code":"A","trade_price":10,"trade_volume":2,"timestamp":1718942400000}',
    '{"code":"A","trade_price":"10.5","trade_volume":"2","timestamp":"1718942400000"}',
    '{"code":"","market":"M","trade_price":1,"trade_volume":1,"timestamp":1718942400000}',
    '{"code":"","market":"","trade_price":1,"trade_volume":1,"timestamp":1718942400000}',
    '{"trade_price":50000000,"timestamp":1718942400000,"stream_type":"REALTIME","change":"RISE"}',
    '{"trade_price":1,"trade_volume":1,"timestamp":1718942400000}',
    '{"code":"A","trade_price":-100,"trade_volume":1,"timestamp":1718942400000}',
    '{"code":"A","trade_price":0,"trade_volume":1,"timestamp":1718942400000}',
    '{"code":"A","trade_price":1,"trade_volume":-1,"timestamp":1718942400000}',
    '{"code":"A","trade_price":1,"trade_volume":0,"timestamp":1718942400000}',
    '{"code":"A","trade_price":1,"trade_volume":1,"timestamp":0}',
    '{"code":"A","trade_price":1,"trade_volume":1,"timestamp":"12.7"}',
    '{"code":"A","trade_price":1,"trade_volume":1,"timestamp":1718942400000.9}',
    '{"code":"A","trade_price":true,"trade_volume":1,"timestamp":1718942400000}',
    '{"code":"A","trade_price":"abc","trade_volume":1,"timestamp":1718942400000}',
    '{"code":"A","trade_price":null,"trade_volume":1,"timestamp":1718942400000}',
    '{"code":"A","trade_price":1,"trade_volume":1,"timestamp":1718942499999}',
    "{not-valid-json",
    '{"code":"A","trade_price":1,"trade_volume":1,"timestamp":1718942400000} tail',
    '{"code":"A","trade_price":1,"trade_volume":1,"timestamp":1718942400000',
    "{'code':'A'}",
    "[]",
    "7",
    "null",
    "",
]


def judge(text, unknown):
    """The rules, one message at a time. A value that is no object counts as broken."""
    try:
        tick = json.loads(text)
        tick.get
    except (ValueError, AttributeError):
        return (True, unknown, 0.0, 0.0)
    market = tick.get("code") or tick.get("market")
    if unknown is not None:
        market = market or unknown
    if market is not None and not isinstance(market, str):
        market = json.dumps(market)
    failed = (True, market, 0.0, 0.0)
    needed = [tick.get("trade_price"), tick.get("trade_volume"), tick.get("timestamp")]
    if None in needed or market is None:
        return failed
    try:
        price, volume, sent = float(needed[0]), float(needed[1]), int(needed[2])
    except (TypeError, ValueError):
        return failed
    if price <= 0 or volume < 0 or sent <= 0:
        return failed
    return (False, market, max(0.0, NOW - sent), price * volume)


def judged(texts, rules):
    ticks = texts([(i, NOW, m) for i, m in enumerate(MESSAGES)])
    rows = metric_events(ticks, rules).orderBy("seq").collect()
    return [(r.is_error, r.market, r.latency_ms, r.trade_amount_krw) for r in rows]


def test_global_rules(texts):
    assert judged(texts, "global") == [judge(m, None) for m in MESSAGES]


def test_market_rules(texts):
    assert judged(texts, "market") == [judge(m, "UNKNOWN") for m in MESSAGES]


# Whole numbers beyond 64 bits are left out: they count as no numbers here.
NUMBERS = [
    "1", "0", "-1", "1.5", "1e3", "1E-7", "-0.0", "1718942400000", "1718942400000.7", "12.7",
    '"1"', '"1.5"', '"-1"', '" 2 "', '"+3"', '"1e3"', '"abc"', '""', '"1.5d"', '"0x1p3"', '"1,5"', '"1718942400000"',
    "true", "false", "null", "[1]", "{}", '{"a": [1, 2]}', "NaN", "Infinity", "-Infinity", '"nan"', '"inf"',
    "1.23456789012345678901234567890", "0.1", "123456789.987654321", "99999999999999999", "9007199254740993",
]
NAMES = ['"A"', '"B"', '""', "null", '"한글"', '"a\\"b"', '"\\u00e9"']
# Values that count as false, and texts that look like them.
FALSE_LOOKING = ["0", "0.0", "-0", "0e5", "false", "[]", "{}", '"0"', '"false"', '"[]"', "7", "true"]
ENDINGS = [
    "", "", "", "", "", " ", " tail", "}", ",", "{}", ', {"code":"A"}', '],"x":[{}', '],"x":[', '],"end":true}', '],"end":true} [',
    '],"end":true,"ticks":[{"code":"A"}',
]


def random_message(source):
    parts = []
    for field, tokens in (
        ("code", NAMES + FALSE_LOOKING), ("market", NAMES), ("trade_price", NUMBERS), ("trade_volume", NUMBERS), ("timestamp", NUMBERS),
    ):
        # Plain values are likely, so that whole ticks come out valid too.
        plain = {"code": '"A"', "market": '"M"', "timestamp": "1718942400000"}.get(field, "2.5")
        for _ in range(source.choice([0, 1, 1, 1, 1, 1, 1, 2])):
            parts.append(f'"{field}": {plain if source.random() < 0.6 else source.choice(tokens)}')
    source.shuffle(parts)
    return "{" + ", ".join(parts) + "}" + source.choice(ENDINGS)


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("rules", ["global", "market"])
def test_random_messages(texts, rules):
    source = random.Random(17)
    messages, wanted = [], []
    while len(messages) < 4000:
        message = random_message(source)
        try:
            wanted.append(judge(message, None if rules == "global" else "UNKNOWN"))
        except OverflowError:  # whole number of an infinite one: no answer to compare with
            continue
        messages.append(message)
    ticks = texts([(i, NOW, m) for i, m in enumerate(messages)])
    got = metric_events(ticks, rules).orderBy("seq").collect()
    assert sum(not r.is_error for r in got) > 200
    for message, row, expected in zip(messages, got, wanted):
        found = (row.is_error, row.market, row.latency_ms, row.trade_amount_krw)
        assert all(map(same, found, expected)), (message, found, expected)


def test_missing_text_is_an_error(texts):
    row = metric_events(texts([(1, NOW, None)])).first()
    assert row.is_error and row.market is None


def test_unknown_rules(texts):
    try:
        metric_events(texts([(1, NOW, "{}")]), rules="none")
    except ValueError as error:
        assert "none" in str(error)
    else:
        raise AssertionError("must fail")


def test_latency_keeps_microseconds(spark):
    df = spark.createDataFrame(
        [('{"code":"A","trade_price":1,"trade_volume":1,"timestamp":1000}', 1001500)], "value STRING, us BIGINT"
    ).select("value", F.timestamp_micros("us").alias("ingest_time"))
    assert metric_events(df).first().latency_ms == 1.5


def test_last_of_repeated_fields_counts(texts):
    tick = decode(texts([(1, NOW, '{"code":"A","code":"B"}')]), ["code"]).first().tick
    assert tick.code == "B"


def test_envelope(texts):
    ticks = texts(
        [(1, 0, '{"cd":"X","tp":1}'), (2, 0, '{"code":"A"}'), (3, 0, "{broken"), (4, 0, '{"code":"한","cd":"Y"}')]
    )
    by_cd = [tuple(r) for r in publish_envelope(ticks).collect()]
    assert by_cd == [("X", '{"cd":"X","tp":1}'), ("unknown", '{"code":"A"}'), ("Y", '{"code":"한","cd":"Y"}')]
    by_code = [r.key for r in publish_envelope(ticks, ("code", "cd"), topic="t").collect()]
    assert by_code == ["X", "A", "한"]
    assert publish_envelope(ticks, topic="t").columns == ["key", "value", "topic"]


def test_json_keeps_text_beyond_ascii(spark):
    df = spark.createDataFrame([("비트코인", 1.5)], "name STRING, price DOUBLE")
    assert to_json_value(df).first().value == '{"name":"비트코인","price":1.5}'


def test_rename(spark):
    old = spark.createDataFrame([("KRW-A", 10.0, 1, "S")], "cd STRING, tp DOUBLE, tms BIGINT, st STRING")
    new = rename_long(old)
    assert new.columns == ["cd", "trade_price", "timestamp", "stream_type", "acc_ask_volume", "acc_bid_volume"]
    assert [float(x) for x in new.first()[4:]] == [1.0, 1.0]
    given = rename_long(spark.createDataFrame([(2.5,), (None,)], "acc_ask_volume DOUBLE"))
    assert [float(r.acc_ask_volume) for r in given.collect()] == [2.5, 1.0]


def test_texts_that_close_and_reopen_the_wrapper(texts):
    one = MESSAGES[0]
    endings = ['],"x":[{}', '],"x":[', '],"end":true}', '],"end":true} junk [', '],"end":true,"ticks":[{"code":"A"}', f",{one}"]
    odd = [one + ending for ending in endings]
    fine = [one[:-1] + ',"note":"]}","list":[1,[2]]}']
    rows = metric_events(texts([(i, NOW, t) for i, t in enumerate(odd + fine)])).orderBy("seq").collect()
    assert [r.is_error for r in rows] == [True] * len(odd) + [False]
    ticks = texts([(i, NOW, t) for i, t in enumerate([*odd, *fine, None, "{"])])
    assert [r.value for r in publish_envelope(ticks).collect()] == fine
    assert sorted(r.seq for r in publish_rejects(ticks).collect()) == [*range(len(odd)), len(odd) + 1, len(odd) + 2]


def test_a_code_that_counts_as_false_gives_way(texts):
    make = lambda code: '{"code":%s,"market":"M","trade_price":1,"trade_volume":1,"timestamp":1}' % code
    codes = ["0", "false", "[]", "{}", "0.0", '"0"', '"false"', "7"]
    rows = metric_events(texts([(i, NOW, make(c)) for i, c in enumerate(codes)])).orderBy("seq").collect()
    assert [r.market for r in rows] == ["M"] * 5 + ["0", "false", "7"]
