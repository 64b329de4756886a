"""A streaming sink that adds batches to a table of files, each once.

Tasks write their rows in inserts of a number of rows, or of what came within an interval,
as row groups of a file of their own. When all tasks of a batch are done, their files
become part of the table under the batch's number; what a task, or a batch, leaves behind
that dies before is never read.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickwatch.settings import importable
from tickwatch.streaming.ledger import Ledger

FORMAT = "batch_append"

# Rows of an insert, and seconds after which fewer are inserted.
HEALTH_INSERT, MARKET_HEALTH_INSERT, MOVES_INSERT = (1, 10.0), (50, 1.0), (50, 1.0)


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote."""

    place: str | None
    rows: int
    inserts: int


class Inserter:
    """Holds rows until there are enough of them, or they have waited long enough."""

    def __init__(self, insert, rows: int, seconds: float, clock=time.monotonic):
        self.insert, self.rows, self.seconds, self.clock = insert, rows, seconds, clock
        self.held: list[pa.RecordBatch] = []
        self.count, self.inserts, self.since = 0, 0, clock()

    def add(self, batch: pa.RecordBatch) -> None:
        while batch.num_rows:
            part = batch.slice(0, self.rows - self.count)
            batch = batch.slice(part.num_rows)
            self.held.append(part)
            self.count += part.num_rows
            if self.count == self.rows or self.clock() - self.since >= self.seconds:
                self.flush()

    def flush(self) -> None:
        if self.count:
            self.insert(pa.Table.from_batches(self.held).combine_chunks())
            self.held, self.count = [], 0
            self.inserts += 1
        self.since = self.clock()


class BatchWriter(DataSourceStreamArrowWriter):
    """Writes the files of a batch and puts them into the table."""

    def __init__(self, path: str, rows: int, seconds: float):
        self.path, self.rows, self.seconds = path, rows, seconds

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        ledger, place = Ledger(self.path), f"data/part-{uuid.uuid4().hex}.parquet"
        writer, total = None, 0
        try:
            for batch in iterator:
                if writer is None and batch.num_rows:
                    ledger.files.create_dir(ledger.place("data"), recursive=True)
                    writer = pq.ParquetWriter(ledger.place(place), batch.schema, filesystem=ledger.files)
                    inserter = Inserter(writer.write_table, self.rows, self.seconds)
                if batch.num_rows:
                    inserter.add(batch)
                    total += batch.num_rows
            if writer is None:
                return Written(None, 0, 0)
            inserter.flush()
            writer.close()
        except BaseException:
            if writer is not None:
                writer.close()
                ledger.remove([place])
            raise
        return Written(place, total, inserter.inserts)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        written = [message for message in messages if message is not None]
        places = [message.place for message in written if message.place]
        Ledger(self.path).commit(batchId, places, sum(message.rows for message in written))

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        Ledger(self.path).remove([message.place for message in messages if message is not None and message.place])


class BatchAppend(DataSource):
    """Options: ``path``, ``rows`` of an insert, ``seconds`` after which fewer are inserted."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("batches are only added")
        rows, seconds = int(self.options.get("rows", "1000")), float(self.options.get("seconds", "1"))
        if rows < 1:
            raise ValueError("an insert has at least one row")
        return BatchWriter(self.options["path"], rows, seconds)


def start(
    df: DataFrame,
    path: str,
    checkpoint: str,
    insert: tuple[int, float] = (1000, 1.0),
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Start adding a stream to a table, each batch once; ``ledger.read`` reads it."""
    register(df.sparkSession)
    rows, seconds = insert
    writer = df.writeStream.outputMode("append").format(FORMAT).option("path", path).option("rows", rows)
    writer = writer.option("seconds", seconds).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def register(spark: SparkSession) -> None:
    importable(spark)
    spark.dataSource.register(BatchAppend)
