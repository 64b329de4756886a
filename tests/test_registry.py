import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tickwatch.plans import views
from tickwatch.plans.oracle import ORACLES
from tickwatch.plans.queries import QUERIES

SMALL = entry.SMALL
BATCH = sorted(name for name in QUERIES if not name.endswith(("_stream", "_echo", "_totals")) and name != "experiment_summary")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def ordered(names, rows):
    place = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in place) for row in rows), key=repr)


def test_each_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert {*QUERIES} <= {*entry.queries()} and {*entry.oracle_sql()} <= {*entry.queries()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    relation = duck.execute(entry.oracle_sql()[name])
    names = [column[0] for column in relation.description]
    assert sorted(result.columns) == sorted(names)
    assert ordered(result.columns, result.collect()) == ordered(names, relation.fetchall())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    # Nothing leaves the JVM, nothing is joined without a key, and a text is decoded
    # once, or a second time if plain numbers are not what it holds.
    assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoop", plan)
    assert plan.count("from_json(StructField(ticks,") <= 2


@pytest.mark.parametrize("name", [n for n in BATCH if n.startswith(("price_moves", "health", "market_metrics"))])
def test_aggregates_hash_and_do_not_sort(spark, name):
    assert "SortAggregate" not in plan_of(QUERIES[name](spark, SMALL))


def test_ticks_are_folded_before_they_are_spread(spark):
    plan = plan_of(QUERIES["price_moves"](spark, SMALL))
    # Plans read from the bottom up: the spread sits above the first exchange.
    assert plan.index("Expand") < plan.rindex("Exchange hashpartitioning")


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["price_moves"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_fault_is_there(spark):
    faults = views.clean_ticks(views.table(spark, SMALL, "events")).select("fault").distinct().count()
    assert faults == 40
