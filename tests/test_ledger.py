import os
import shutil
import threading
import time

import pytest
from pyspark.sql import functions as F
from test_streams import BASE, land, stream_of, tick_row

from tickwatch.schemas import MARKET_SCHEMA
from tickwatch.sources import append
from tickwatch.streaming import ledger, runner, sinks
from tickwatch.streaming.ledger import Entry, Ledger

SCHEMA = "id BIGINT, kind STRING"


def rows(spark, batch, count=10):
    return spark.range(batch * count, batch * count + count).select("id", F.concat(F.lit("k"), F.col("id") % 2).alias("kind"))


def ids(spark, path):
    return sorted(row.id for row in ledger.read(spark, path, SCHEMA).collect())


def test_a_batch_is_added_once(spark, tmp_path):
    path = str(tmp_path / "table")
    assert ids(spark, path) == []
    assert ledger.write_batch(rows(spark, 0), path, 0) and ledger.write_batch(rows(spark, 1), path, 1)
    # The same number again, with whatever rows.
    assert not ledger.write_batch(rows(spark, 7), path, 1)
    assert ids(spark, path) == list(range(20))
    assert [(e.first, e.rows) for e in Ledger(path).entries()] == [(0, 10), (1, 10)] and Ledger(path).entries()[0].size > 0


def test_a_batch_that_died_half_way_is_not_read(spark, tmp_path):
    path = str(tmp_path / "table")
    ledger.write_batch(rows(spark, 0), path, 0)
    # Its rows are there, its entry is not, or is not whole.
    rows(spark, 1).write.parquet(f"{path}/{ledger.new_place()}")
    (tmp_path / "table" / "ledger" / ".half").write_text('{"first": 1')
    assert ids(spark, path) == list(range(10))
    ledger.write_batch(rows(spark, 1), path, 1)
    assert ids(spark, path) == list(range(20))
    assert Ledger(path).vacuum(3600) == []
    gone = Ledger(path).vacuum(-1)
    assert len(gone) == 2 and "ledger/.half" in gone and ids(spark, path) == list(range(20))


def test_rows_that_came_twice_are_removed(spark, tmp_path):
    path, place = str(tmp_path / "table"), ledger.new_place()
    ledger.write_batch(rows(spark, 0), path, 0)
    rows(spark, 0).write.parquet(f"{path}/{place}")
    assert not Ledger(path).commit(0, [place], 10)
    assert not os.path.exists(f"{path}/{place}") and ids(spark, path) == list(range(10))


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "table")
    for batch in range(6):
        ledger.write_batch(rows(spark, batch, 0 if batch == 3 else 10), path, batch, ["kind"])
    (entry,) = ledger.compact(spark, path, partition_by=["kind"])
    assert (entry.first, entry.last, entry.rows) == (0, 5, 50)
    expected = [*range(30), *range(40, 60)]
    assert ids(spark, path) == expected and len(Ledger(path).entries()) == 1
    # One file for each kind, and a batch within it changes nothing.
    files = [name for _, _, names in os.walk(f"{path}/{entry.places[0]}") for name in names if name.endswith(".parquet")]
    assert len(files) == 2
    assert not ledger.write_batch(rows(spark, 2), path, 2, ["kind"])
    ledger.write_batch(rows(spark, 6), path, 6, ["kind"])
    assert len(Ledger(path).entries()) == 2
    Ledger(path).vacuum(-1)
    assert len(os.listdir(f"{path}/data")) == 2 and ids(spark, path) == [*expected, *range(60, 70)]
    ledger.compact(spark, path, partition_by=["kind"])
    assert [(e.first, e.last) for e in Ledger(path).entries()] == [(0, 6)] and ids(spark, path) == [*expected, *range(60, 70)]


def test_readers_during_compaction_see_each_row_once(spark, tmp_path):
    path, seen, stop = str(tmp_path / "table"), [], threading.Event()
    for batch in range(4):
        ledger.write_batch(rows(spark, batch), path, batch)

    def look():
        while not stop.is_set():
            seen.append(ids(spark, path))

    reader = threading.Thread(target=look)
    reader.start()
    try:
        for batch in range(4, 7):
            ledger.compact(spark, path)
            ledger.write_batch(rows(spark, batch), path, batch)
        time.sleep(0.5)
    finally:
        stop.set()
        reader.join()
    assert seen and all(found == list(range(len(found))) and len(found) in (40, 50, 60, 70) for found in seen)


def test_which_entries_are_put_together():
    sizes = [10, 20, 500, 30, 40, 50, 900, 10]
    entries = [Entry(n, n, [], 1, size) for n, size in enumerate(sizes)]
    assert [[e.first for e in run] for run in ledger.small_runs(entries, 100)] == [[0, 1], [3, 4, 5]]
    # What goes into one compaction is bounded.
    many = [Entry(n, n, [], 1, 90) for n in range(20)]
    assert [len(run) for run in ledger.small_runs(many, 100)] == [8, 8, 4]
    assert ledger.small_runs([], 100) == []


def test_a_table_without_rows_needs_a_schema(spark, tmp_path):
    with pytest.raises(ValueError, match="columns"):
        ledger.read(spark, str(tmp_path / "none"))
    assert ledger.compact(spark, str(tmp_path / "none")) == []


def test_routed_table(spark, texts, tmp_path):
    (tmp_path / "ticks").mkdir()
    land(texts, tmp_path / "ticks", [[tick_row(i, "A", BASE, i)] for i in range(3)])
    markets = spark.createDataFrame([("A", "a", "a", *([False] * 6), True)], MARKET_SCHEMA)
    path = str(tmp_path / "table")
    write = sinks.routed_table(lambda: markets, path)
    query = runner.start_batches(stream_of(spark, tmp_path / "ticks"), write, str(tmp_path / "checkpoint"), available_now=True)
    query.awaitTermination()
    assert len(Ledger(path).entries()) == 3
    ledger.compact(spark, path, partition_by=["outcome"])
    assert ledger.read(spark, path).groupBy("outcome").count().collect() == [("dead_letter", 3)]


# The sink -----------------------------------------------------------------------


def appended(spark, source, path, checkpoint):
    append.start(stream_of(spark, source), path, checkpoint, (7, 60.0), available_now=True).awaitTermination()
    return sorted(row.seq for row in ledger.read(spark, path, "seq BIGINT, ingest_time TIMESTAMP, value STRING").collect())


def test_the_sink_adds_each_batch_once(spark, texts, tmp_path):
    source, path, checkpoint = tmp_path / "ticks", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    source.mkdir()
    land(texts, source, [[tick_row(b * 20 + i, "A", BASE, 1) for i in range(20)] for b in range(3)])
    assert appended(spark, source, path, checkpoint) == list(range(60))
    assert [(e.first, e.rows) for e in Ledger(path).entries()] == [(0, 20), (1, 20), (2, 20)]
    # The engine forgets that the last batch was done, and runs it again.
    os.remove(f"{checkpoint}/commits/2")
    for name in os.listdir(f"{checkpoint}/commits"):
        if name.startswith(".2"):
            os.remove(f"{checkpoint}/commits/{name}")
    assert appended(spark, source, path, checkpoint) == list(range(60))
    assert len([name for name in os.listdir(f"{path}/data") if name.endswith(".parquet")]) == 3


def test_a_batch_that_is_killed_half_way_leaves_each_row_once(spark, texts, tmp_path):
    source, path, checkpoint = tmp_path / "ticks", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    source.mkdir()
    land(texts, source, [[tick_row(b * 20 + i, "A", BASE, 1) for i in range(20)] for b in range(2)])
    # One task of a batch has written its file; the job dies before the batch is put into the table.
    batches = texts([tick_row(i, "A", BASE, 1) for i in range(20)]).toArrow().to_batches()
    left = append.BatchWriter(path, 7, 60.0).write(iter(batches))
    assert left.rows == 20 and left.inserts >= 3
    assert appended(spark, source, path, checkpoint) == list(range(40))
    # Two tries of one batch that both get as far as the table: the second is taken back.
    again = append.BatchWriter(path, 7, 60.0)
    again.commit([again.write(iter(batches)), None], 1)
    assert ledger.read(spark, path).count() == 40


def test_a_batch_that_is_given_up_leaves_no_file(tmp_path, texts):
    writer = append.BatchWriter(str(tmp_path / "table"), 7, 60.0)
    batches = texts([tick_row(i, "A", BASE, 1) for i in range(20)]).toArrow().to_batches()
    writer.abort([writer.write(iter(batches)), None, writer.write(iter([]))], 0)
    assert os.listdir(tmp_path / "table" / "data") == []

    def broken():
        yield batches[0]
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        writer.write(broken())
    assert os.listdir(tmp_path / "table" / "data") == []


def test_inserts_by_count_and_by_interval(texts):
    import pyarrow as pa

    now, made = [0.0], []
    inserter = append.Inserter(lambda table: made.append(table.num_rows), 5, 10.0, lambda: now[0])
    batch = pa.record_batch({"x": list(range(12))})
    inserter.add(batch)
    assert made == [5, 5]
    now[0] = 11.0
    inserter.add(batch.slice(0, 1))
    assert made == [5, 5, 3]
    inserter.add(batch.slice(0, 2))
    inserter.flush()
    inserter.flush()
    assert made == [5, 5, 3, 2] and inserter.inserts == 4


def test_options_of_the_sink():
    with pytest.raises(ValueError, match="row"):
        append.BatchAppend({"path": "/tmp/x", "rows": "0"}).streamWriter(None, False)
    with pytest.raises(ValueError, match="added"):
        append.BatchAppend({"path": "/tmp/x"}).streamWriter(None, True)


def test_a_local_folder_may_have_a_scheme(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    ledger.write_batch(rows(spark, 0), path, 0)
    assert ids(spark, path) == list(range(10)) and shutil.os.path.isdir(f"{tmp_path}/table/ledger")
