import random
from decimal import Decimal

import pytest
from test_streams import BASE, MINUTE, land, stream_of, tick_row
from test_timers import Value

from tickwatch.operators import moves
from tickwatch.streaming import jobs, panes, runner, sinks


def from_panes(spark, folder, label, **how):
    moving = panes.price_moves(stream_of(spark, folder), **how)
    with runner.state_on_disk(spark):
        return sorted(map(tuple, runner.run_available(moving, label).collect()), key=repr)


def from_windows(spark, folder, label, **how):
    moving = moves.price_moves(stream_of(spark, folder), **{"delay": "1 second", **how})
    with runner.drop_late_at_once(spark):
        return sorted(map(tuple, runner.run_available(moving, label).collect()), key=repr)


def test_a_late_tick_counts_in_the_windows_still_open(spark, texts, tmp_path):
    land(
        texts,
        tmp_path,
        [
            [tick_row(1, "A", BASE, 100.0), tick_row(2, "A", BASE + 10 * MINUTE, 110.0)],
            [tick_row(3, "A", BASE + 1, 1.0), tick_row(4, "A", BASE + 8 * MINUTE, 105.0), tick_row(7, "A", BASE + 8 * MINUTE, 9.0)],
            [tick_row(5, "A", BASE + 20 * MINUTE, 120.0), tick_row(6, "B", BASE + 30 * MINUTE, 1.0)],
        ],
    )
    got = from_panes(spark, tmp_path, "late-panes")
    assert got == from_windows(spark, tmp_path, "late-windows") and len(got) == 16


@pytest.mark.parametrize("size, slide", [("5 minutes", "1 minute"), ("5 minutes", "2 minutes"), ("3 minutes", "3 minutes")])
def test_random_batches_equal_the_windows(spark, texts, tmp_path, size, slide):
    source, rows, now = random.Random(size + slide), [], 0
    for batch in range(8):
        now += source.randrange(4 * MINUTE)
        late = [source.randrange(-6 * MINUTE, 3 * MINUTE) // 1000 * 1000 for _ in range(25)]
        rows.append([tick_row(batch * 100 + i, source.choice("ABC"), BASE + now + ms, source.randrange(4)) for i, ms in enumerate(late)])
    land(texts, tmp_path, rows)
    how = {"size": size, "slide": slide, "delay": "10 seconds"}
    got = from_panes(spark, tmp_path, "some-panes", **how)
    assert got == from_windows(spark, tmp_path, "some-windows", **how) and len(got) > 10


def test_the_slide_may_not_be_longer(spark, tmp_path, texts):
    land(texts, tmp_path, [[tick_row(1, "A", BASE, 1.0)]])
    with pytest.raises(ValueError, match="slide"):
        panes.price_moves(stream_of(spark, tmp_path), "1 minute", "2 minutes")


def test_pane_moves_job(spark, texts, tmp_path):
    (tmp_path / "ticks").mkdir()
    rows = [tick_row(i, "A" if i % 3 else "Z", BASE + i * 1000, 100 + i) for i in range(900)]
    land(texts, tmp_path / "ticks", [rows[:450], rows[450:]])
    write = sinks.batch_folder(str(tmp_path / "moves"))
    markets = lambda: spark.createDataFrame([("A",)], "market STRING")
    ticks = stream_of(spark, tmp_path / "ticks")
    jobs.start_pane_moves(ticks, markets, write, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "moves")).collect()
    assert len(found) == 14 and {r.market_code for r in found} == {"A"}


class Map:
    """A state that holds a map, as the engine's does, and counts its changes."""

    def __init__(self):
        self.held, self.changes = {}, 0

    def iterator(self):
        return iter(list(self.held.items()))

    def keys(self):
        return iter(list(self.held))

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value
        self.changes += 1

    def removeKey(self, key):
        del self.held[key]


class Handle:
    def __init__(self):
        self.map, self.value, self.timers = Map(), Value(), set()

    def getMapState(self, *names):
        return self.map

    def getValueState(self, *names):
        return self.value

    def registerTimer(self, ms):
        self.timers.add(ms)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def tick(ms, arrival, price, pane_ms=60_000):
    one = ms, Decimal(arrival), price
    return ("A", ms - ms % pane_ms, *one, *one)


def test_one_change_of_state_for_a_tick():
    handle, state = Handle(), panes.Panes(5 * 60_000, 60_000)
    state.init(handle)
    assert list(state.handleInputRows(("A",), [tick(30_000, 1, 5.0)], At(0))) == []
    assert handle.map.changes == 1 and handle.timers == {60_000}
    # Pane 0 has passed, windows that hold it have not.
    assert list(state.handleInputRows(("A",), [tick(20_000, 2, 4.0), tick(100_000, 3, 6.0)], At(59_000))) == []
    assert handle.map.changes == 3
    (first,) = state.handleExpiredTimer(("A",), At(60_000), None)
    assert (first.end_ms, first.start_price, first.end_price) == (60_000, 4.0, 5.0)
    # A tick of a window that was given out changes the later ones only.
    assert list(state.handleInputRows(("A",), [tick(10_000, 4, 1.0)], At(60_000))) == []
    rows = list(state.handleExpiredTimer(("A",), At(10**6), None))
    assert [(r.end_ms // 60_000, r.start_price, r.end_price) for r in rows] == [
        (2, 1.0, 6.0), (3, 1.0, 6.0), (4, 1.0, 6.0), (5, 1.0, 6.0), (6, 6.0, 6.0),
    ]
    # Nothing is held of a market whose windows are all closed, and what comes too late opens none.
    assert not handle.map.held and not handle.value.exists()
    assert list(state.handleInputRows(("A",), [tick(10_000, 5, 1.0)], At(10**6))) == [] and not handle.map.held


def test_first_and_last_of_equal_times():
    one, other = tick(5, 2, 1.0)[2:], tick(5, 1, 2.0)[2:]
    assert panes.merged(one, other)[2::3] == (2.0, 2.0)
