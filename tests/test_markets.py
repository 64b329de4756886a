import random

import pytest

from tickwatch.operators import markets as m
from tickwatch.schemas import CAUTION_FLAGS, FEED_ITEM_SCHEMA, MARKET_SCHEMA

FLAGS = ("warning", *CAUTION_FLAGS)


def entry(market, korean="k", english="e", warning=None, caution=None, event=True):
    nested = None
    if event:
        nested = (warning, None if caution is None else tuple(caution.get(f) for f in CAUTION_FLAGS.values()))
    return (market, korean, english, nested)


def feed_of(spark, entries):
    item = "STRUCT<" + FEED_ITEM_SCHEMA[len("STRUCT<"):-1] + ">"
    rows = [(i, e) for i, e in enumerate(entries)]
    return spark.createDataFrame(rows, f"seq BIGINT, item {item}").select("seq", "item.*")


def table_of(spark, rows):
    return spark.createDataFrame(rows, MARKET_SCHEMA)


def line(market, name="old", active=True, flag=False):
    return (market, name, name, *([flag] * len(FLAGS)), active)


def by_loop(existing, entries, reactivate):
    """Apply the feed one entry at a time, as a sequential upsert would."""
    table = {r[0]: list(r) for r in existing}
    active = {r[0] for r in existing if r[-1]}
    created = updated = 0
    for market, korean, english, event in entries:
        warning, caution = event if event else (None, None)
        flags = [bool(warning), *(bool(c) for c in (caution or [None] * len(CAUTION_FLAGS)))]
        if market in table:
            updated += 1
            kept = True if reactivate else table[market][-1]
        else:
            created += 1
            kept = True
        table[market] = [market, korean, english, *flags, kept]
    listed = {e[0] for e in entries}
    gone = [k for k, r in table.items() if r[-1] and k not in listed] if reactivate else []
    for k in gone:
        table[k][-1] = False
    counts = (created, updated, len(gone), len(listed - active), len(active - listed))
    return sorted(tuple(r) for r in table.values()), counts, listed - active, active - listed


@pytest.mark.parametrize("reactivate", [True, False])
def test_sync_against_loop(spark, reactivate):
    source = random.Random(5)
    existing = [line(f"M{i}", active=source.random() < 0.7, flag=source.random() < 0.5) for i in range(0, 60)]
    entries = []
    for i in range(30, 100):
        for copy in range(source.choice([1, 1, 3])):
            caution = {f: source.choice([True, False, None]) for f in CAUTION_FLAGS.values()}
            entries.append(
                entry(f"M{i}", f"k{copy}", f"e{copy}", source.choice([True, False, None]), caution, source.random() < 0.8)
            )
    # One market has a third of the entries.
    entries += [entry("M31", f"hot{i}") for i in range(len(entries) // 2)]
    source.shuffle(entries)
    table, counts, new, gone = by_loop(existing, entries, reactivate)

    before, feed = table_of(spark, existing), feed_of(spark, entries)
    snapshot = m.sync_snapshot(before, feed, reactivate)
    assert [f.simpleString() for f in snapshot.schema] == [f.simpleString() for f in before.schema]
    assert sorted(tuple(r) for r in snapshot.collect()) == table
    changes = m.sync_changes(before, feed, reactivate)
    assert tuple(m.sync_report(changes).first()) == counts
    listing = {(r.listing, r.market) for r in m.listing_report(changes).collect()}
    assert listing == {("new", x) for x in new} | {("delisted", x) for x in gone}
    assert {r.market for r in m.new_listings(before, feed).collect()} == new
    assert {r.market for r in m.delistings(before, feed).collect()} == gone


def test_absent_flags_are_false(spark):
    feed = feed_of(spark, [entry("A", event=False), entry("B"), entry("C", warning=True, caution={"PRICE_FLUCTUATIONS": True})])
    got = {r.market: tuple(r[f] for f in FLAGS) for r in m.flatten_feed(feed).collect()}
    none = (False,) * 6
    assert got == {"A": none, "B": none, "C": (True, True, False, False, False, False)}


def test_existing_null_attributes_survive(spark):
    existing = [("A", None, "x", *([None] * 6), True), ("B", "b", "b", *([None] * 6), False)]
    got = m.sync_changes(table_of(spark, existing), feed_of(spark, [entry("C")])).collect()
    assert {(r.market, r.action, r.is_active) for r in got} == {
        ("A", "deactivated", False),
        ("B", "unchanged", False),
        ("C", "created", True),
    }


def test_empty_sides(spark):
    none, some = table_of(spark, []), feed_of(spark, [entry("A")])
    assert tuple(m.sync_report(m.sync_changes(none, some)).first()) == (1, 0, 0, 1, 0)
    empty = feed_of(spark, [])
    assert tuple(m.sync_report(m.sync_changes(table_of(spark, [line("A")]), empty)).first()) == (0, 0, 1, 0, 1)
    assert tuple(m.sync_report(m.sync_changes(none, empty)).first()) == (0, 0, 0, 0, 0)
