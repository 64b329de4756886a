import random

import pytest
from helpers import at
from pyspark.sql import functions as F
from test_markets import by_loop, entry, feed_of, line, table_of

from tickwatch.operators import compare, distinct, serving, sketches
from tickwatch.schemas import HEALTH_COLUMNS
from tickwatch.sources.buckets import MarketStore

HOUR = 3_600_000
EVENTS = "ms BIGINT, market STRING, is_error BOOLEAN"


# Sketches -----------------------------------------------------------------------


def metric_rows(spark, count, seed=1):
    source = random.Random(seed)
    rows = [(i * 1000, 1 + i % 7, i % 3, source.lognormvariate(3, 1), float(i % 11)) for i in range(count)]
    df = spark.createDataFrame(rows, "ms BIGINT, collected BIGINT, errors INT, latency DOUBLE, top DOUBLE")
    made = df.select(
        F.timestamp_millis("ms").alias("checked_at"), F.lit("1s").alias("time_unit"),
        F.col("collected").alias("total_collected_count"), F.col("errors").alias("total_error_count"),
        F.lit(0.0).alias("error_rate_percentage"), F.col("latency").alias("average_latency_ms"),
        F.col("top").alias("max_latency_ms"), F.lit(1).alias("unique_market_count"), F.lit(0.0).alias("total_trade_volume_krw"),
    )
    return made.select(*HEALTH_COLUMNS), sorted(row[3] for row in rows)


def test_summary_from_merged_spans(spark):
    rows, latencies = metric_rows(spark, 30_000)
    hourly = sketches.span_figures(rows)
    assert hourly.count() == 9
    exact, found = serving.experiment_summary(rows).first(), sketches.summary(hourly).first()
    names = [name for name in exact.asDict() if name != "p95_latency_ms"]
    assert all(found[name] == pytest.approx(exact[name], rel=1e-12) for name in names) and [*found.asDict()] == [*exact.asDict()]
    rank = sum(one <= found.p95_latency_ms for one in latencies) / len(latencies)
    assert abs(rank - 0.95) <= sketches.rank_error()
    # Spans of spans merge to the same figures.
    daily = sketches.summary(sketches.wider(hourly)).first()
    assert daily.samples == 30_000 and abs(sum(one <= daily.p95_latency_ms for one in latencies) / 30_000 - 0.95) <= sketches.rank_error()


def test_some_spans_and_none(spark):
    hourly = sketches.span_figures(metric_rows(spark, 9000)[0])
    one = sketches.summary(sketches.between(hourly, "1970-01-01 01:00:00", "1970-01-01 02:00:00")).first()
    assert one.samples == 3600
    none = sketches.summary(sketches.between(hourly, until="1969-01-01 00:00:00")).first()
    assert none.samples == 0 and none.p95_latency_ms is None and none.error_rate_percentage == 0.0


def test_a_larger_sketch_has_a_smaller_error():
    assert sketches.rank_error(800) < sketches.rank_error(400) < 0.015


# Bitmaps ------------------------------------------------------------------------


def event_rows(spark, rows):
    return spark.createDataFrame(rows, EVENTS).select(F.timestamp_millis("ms").alias("ingest_time"), "market", "is_error")


def test_numbers_are_dense(spark):
    codes = [f"M{i:05d}" for i in range(5000)]
    df = spark.createDataFrame([(c,) for c in codes * 2] + [(None,)], "market STRING").repartition(7)
    found = sorted(map(tuple, distinct.numbered(df).collect()))
    assert found == [(code, number + 1) for number, code in enumerate(codes)]
    assert distinct.numbered(df.where("false")).count() == 0


def test_distinct_counts_roll_up(spark):
    source = random.Random(4)
    rows = [(source.randrange(-HOUR, 50 * HOUR), f"M{source.randrange(70_000)}", source.random() < 0.2) for _ in range(4000)]
    rows += [(5, None, False), (HOUR, "M1", True)]
    events = event_rows(spark, rows).persist()
    seconds = distinct.market_bitmaps(events, distinct.numbered(events)).persist()
    # Numbers beyond 32,768 have a bitmap of their own.
    for span, bitmaps in ((1000, seconds), (HOUR, distinct.rolled_up(seconds, "1 hour")), (24 * HOUR, distinct.rolled_up(seconds, "1 day"))):
        wanted = {}
        for ms, market, is_error in rows:
            if market is not None and not is_error:
                wanted.setdefault(ms // span, set()).add(market)
        found = {row.checked_at: row.unique_market_count for row in distinct.distinct_counts(bitmaps).collect()}
        assert found == {at((bucket + 1) * span): len(markets) for bucket, markets in wanted.items()}


def test_markets_without_a_number_are_left_out(spark):
    events = event_rows(spark, [(5, "A", False), (6, "B", False)])
    numbers = spark.createDataFrame([("A", 40_000)], "market STRING, number BIGINT")
    (row,) = distinct.distinct_counts(distinct.market_bitmaps(events, numbers)).collect()
    assert row.unique_market_count == 1

def test_spans_with_few_markets_stay_small(spark):
    rows = [(i * 1000, f"M{m}", False) for i in range(300) for m in {i % 200, 199}]
    events = event_rows(spark, rows)
    seconds = distinct.market_bitmaps(events, distinct.numbered(events))
    assert dict(seconds.dtypes)["markets"] == "bigint" and seconds.count() <= len(rows)
    counts = distinct.distinct_counts(distinct.rolled_up(seconds, "1 hour"))
    assert [row.unique_market_count for row in counts.collect()] == [200]
    assert "SortAggregate" not in counts._jdf.queryExecution().executedPlan().toString()


def test_every_bit_of_a_bitmap(spark):
    events = event_rows(spark, [(5, f"M{n}", False) for n in range(1, 130)])
    numbers = spark.createDataFrame([(f"M{n}", n) for n in range(1, 130)], "market STRING, number BIGINT")
    bitmaps = distinct.market_bitmaps(events, numbers)
    assert sorted(map(tuple, bitmaps.select("part", "markets").collect())) == [(0, -1), (1, -1), (2, 1)]
    (row,) = distinct.distinct_counts(distinct.rolled_up(bitmaps, "1 day")).collect()
    assert row.unique_market_count == 129


# Digests ------------------------------------------------------------------------


def codes(spark, names):
    return spark.createDataFrame([(name,) for name in names], "market STRING")


def test_only_in_one_table(spark):
    left, right = [f"M{i}" for i in range(0, 3000)] + [None, "M5"], [f"M{i}" for i in range(7, 3010)]
    some, others = compare.only_in(codes(spark, left), codes(spark, right))
    assert {row.market for row in some.collect()} == {f"M{i}" for i in range(7)} | {None} and some.count() == 8
    assert sorted(row.market for row in others.collect()) == sorted(f"M{i}" for i in range(3000, 3010))
    same = compare.only_in(codes(spark, left), codes(spark, left[::-1]))
    assert [side.count() for side in same] == [0, 0]
    assert [side.count() for side in compare.only_in(codes(spark, []), codes(spark, ["A"]))] == [0, 1]


def test_rows_are_joined_in_proportion_to_the_changes(spark):
    left = codes(spark, [f"M{i}" for i in range(20_000)])
    for changes in (0, 1, 5):
        right = codes(spark, [f"M{i}" for i in range(20_000 - changes)])
        some, others = compare.narrowed(left, right, "market", ["market"])
        # A range of the last level holds a third of a row on average.
        assert some.count() - others.count() == changes and others.count() <= 3 * changes


def test_changed_values_are_found(spark):
    left = spark.range(500).selectExpr("concat('M', id) AS market", "id % 3 AS kind")
    right = left.withColumn("kind", F.when(F.col("market") == "M7", 9).otherwise(F.col("kind")).cast("bigint"))
    some, others = compare.narrowed(left, right, "market", ["market", "kind"])
    assert "M7" in {row.market for row in some.collect()} and some.count() <= 3 and others.count() == some.count()


# Buckets ------------------------------------------------------------------------


def test_syncs_against_a_loop(spark, tmp_path):
    source = random.Random(3)
    existing = [line(f"M{i}", active=source.random() < 0.7) for i in range(40)]
    store = MarketStore(spark, str(tmp_path / "markets"), 8)
    store.write(table_of(spark, existing), {})
    table = existing
    for _ in range(3):
        names = source.sample(range(60), 45)
        entries = [entry(f"M{i}", source.choice("ab"), warning=source.random() < 0.5) for i in names] + [entry(f"M{names[0]}", "last")]
        store.sync(feed_of(spark, entries))
        table = by_loop(table, entries, True)[0]
        assert sorted(map(tuple, store.read().collect())) == table
        # The same reply again changes nothing.
        versions = store.versions()
        assert store.sync(feed_of(spark, entries)) == set() and store.versions() == versions


def test_one_change_rewrites_one_bucket(spark, tmp_path):
    entries = [entry(f"M{i}") for i in range(200)]
    store = MarketStore(spark, str(tmp_path / "markets"), 16)
    assert len(store.sync(feed_of(spark, entries))) == 16
    before = store.snapshot()
    entries[17] = entry("M17", "renamed")
    (number,) = store.sync(feed_of(spark, entries))
    after = store.snapshot()
    assert {n for n in after if after[n].place != before[n].place} == {number}
    assert store.read().where("korean_name = 'renamed'").count() == 1 and store.read().count() == 200
    # The version before is still there.
    assert store.read(version=1).where("korean_name = 'renamed'").count() == 0
    # A market that is gone from the feed is one change as well, and so is one that comes.
    assert len(store.sync(feed_of(spark, entries[1:]))) == 1
    assert store.read().where("NOT is_active").count() == 1
    assert len(store.sync(feed_of(spark, [*entries[1:], entry("NEW")]))) == 1


def test_a_table_keeps_its_number_of_buckets(spark, tmp_path):
    path = str(tmp_path / "markets")
    assert MarketStore(spark, path, 4).read().count() == 0
    MarketStore(spark, path, 4).write(table_of(spark, [line("A")]), {})
    with pytest.raises(ValueError, match="4 buckets"):
        MarketStore(spark, path, 8).read()
