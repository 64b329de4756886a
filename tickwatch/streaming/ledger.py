"""Tables of batches: which files hold the rows of which batches, and small ones put together.

A table is a folder with rows under ``data`` and entries under ``ledger``. A batch writes
its rows to places of its own and is part of the table once its entry is there, which
appears in one rename. So a batch that is run again, or that died half-way, changes
nothing. A compaction writes the rows of several neighbouring batches once more, in large
files, and then takes their place, again in one rename. A reader lists the entries once
and sees each row once, whatever is written meanwhile. What no entry names, or another one
covers, is left until ``vacuum``.

The folder may lie wherever the session and the workers can both reach it; paths with a
scheme are opened by the file system that pyarrow has for it.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_ENTRY = re.compile(r"(\d+)-(\d+)\.json")


@dataclass(frozen=True)
class Entry:
    """Rows of the batches from ``first`` to ``last``: their places under the table's folder, number and size."""

    first: int
    last: int
    places: list[str] = field(default_factory=list)
    rows: int = 0
    size: int = 0

    @property
    def name(self) -> str:
        return f"{self.first:012d}-{self.last:012d}.json"


class Ledger:
    """The entries of one table."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.files, self.root = fs.FileSystem.from_uri(self.path)

    def place(self, *names: str) -> str:
        return "/".join([self.root, *names])

    def entries(self) -> list[Entry]:
        """The entries that hold now, by batch; those within a wider one are left out."""
        listed = self.files.get_file_info(fs.FileSelector(self.place("ledger"), allow_not_found=True))
        names = [info.base_name for info in listed if _ENTRY.fullmatch(info.base_name)]
        spans = {name: tuple(map(int, _ENTRY.fullmatch(name).groups())) for name in names}
        # Wider spans first, so that one look back tells whether an entry lies within another.
        kept: list[str] = []
        for name in sorted(names, key=lambda n: (spans[n][0], -spans[n][1])):
            if not kept or spans[name][1] > spans[kept[-1]][1]:
                kept.append(name)
        return [self.read(name) for name in kept]

    def read(self, name: str) -> Entry:
        with self.files.open_input_stream(self.place("ledger", name)) as stream:
            return Entry(**json.loads(stream.read()))

    def holds(self, batch: int) -> bool:
        """Whether a batch is part of the table, by itself or within a wider entry."""
        listed = self.files.get_file_info(fs.FileSelector(self.place("ledger"), allow_not_found=True))
        found = filter(None, (_ENTRY.fullmatch(info.base_name) for info in listed))
        return any(int(one[1]) <= batch <= int(one[2]) for one in found)

    def add(self, entry: Entry) -> None:
        """Make an entry part of the table, in one rename."""
        self.files.create_dir(self.place("ledger"), recursive=True)
        waiting = self.place("ledger", f".{uuid.uuid4().hex}")
        with self.files.open_output_stream(waiting) as stream:
            stream.write(json.dumps(entry.__dict__).encode())
        self.files.move(waiting, self.place("ledger", entry.name))

    def commit(self, batch: int, places: Sequence[str], rows: int) -> bool:
        """Make the rows of a batch part of the table; False, and the rows go, if the batch is there already."""
        if self.holds(batch):
            self.remove(places)
            return False
        self.add(Entry(batch, batch, list(places), rows, self.size_of(places)))
        return True

    def size_of(self, places: Sequence[str]) -> int:
        return sum(info.size or 0 for place in places for info in self.listed(place))

    def listed(self, place: str) -> list[fs.FileInfo]:
        """The files of a place, which is a file or a folder."""
        (info,) = self.files.get_file_info([self.place(place)])
        if info.type == fs.FileType.Directory:
            inside = self.files.get_file_info(fs.FileSelector(info.path, recursive=True))
            return [one for one in inside if one.type == fs.FileType.File]
        return [info] if info.type == fs.FileType.File else []

    def remove(self, places: Sequence[str]) -> None:
        for place in places:
            (info,) = self.files.get_file_info([self.place(place)])
            if info.type == fs.FileType.Directory:
                self.files.delete_dir(info.path)
            elif info.type == fs.FileType.File:
                self.files.delete_file(info.path)

    def uri(self, place: str) -> str:
        return f"{self.path}/{place}"

    def vacuum(self, older_than_seconds: float) -> list[str]:
        """Remove what is no part of the table and was last changed so long ago; returns the places.

        The time must be longer than any reader or batch takes.
        """
        named = {place for entry in self.entries() for place in entry.places}
        live = {entry.name for entry in self.entries()}
        old = time.time() - older_than_seconds
        gone = []
        for folder, kept in (("ledger", live), ("data", named)):
            listed = self.files.get_file_info(fs.FileSelector(self.place(folder), allow_not_found=True))
            for info in listed:
                place = info.base_name if folder == "ledger" else f"data/{info.base_name}"
                changed = max([one.mtime_ns or 0 for one in self.listed(f"{folder}/{info.base_name}")], default=0) / 1e9
                if place not in kept and changed < old:
                    gone.append(f"{folder}/{info.base_name}")
        self.remove(gone)
        return gone


def new_place() -> str:
    return f"data/run={uuid.uuid4().hex}"


def read(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The rows of a table's batches as they are now; an empty frame of the schema if there are none."""
    ledger = Ledger(path)
    places = [ledger.uri(place) for entry in ledger.entries() if entry.rows for place in entry.places]
    if not places:
        if schema is None:
            raise ValueError(f"{path} holds no rows, so its columns are not known")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", ledger.uri("data")).parquet(*places).drop("run")


def write_batch(batch: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> bool:
    """Add the rows of a batch, once; False if the table has it already, and then nothing is computed."""
    ledger = Ledger(path)
    if ledger.holds(batch_id):
        return False
    place = new_place()
    batch.write.partitionBy(*partition_by).parquet(ledger.uri(place))
    # Counted from the footers of the files.
    rows = batch.sparkSession.read.schema(batch.schema).parquet(ledger.uri(place)).count()
    return ledger.commit(batch_id, [place], rows)


def appender(path: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds each batch to a table, once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, partition_by)

    return write


def small_runs(entries: Sequence[Entry], target_bytes: int) -> list[list[Entry]]:
    """Runs of neighbouring entries to put together: each smaller than the target, and more than one."""
    runs: list[list[Entry]] = [[]]
    held = 0
    for entry in entries:
        if entry.size >= target_bytes or held + entry.size > target_bytes * 8 and runs[-1]:
            runs.append([])
            held = 0
        if entry.size < target_bytes:
            runs[-1].append(entry)
            held += entry.size
    return [run for run in runs if len(run) > 1]


def compact(
    spark: SparkSession, path: str, target_bytes: int = 128 << 20, partition_by: Sequence[str] = ()
) -> list[Entry]:
    """Put small neighbouring batches together in files of about the target size; returns the new entries.

    Batches may be added meanwhile, and readers see each row once before, during and
    after it. Run it from one place at a time.
    """
    ledger, done = Ledger(path), []
    for run in small_runs(ledger.entries(), target_bytes):
        held = [entry for entry in run if entry.rows]
        place, rows, size = new_place(), 0, 0
        if held:
            places = [ledger.uri(old) for entry in held for old in entry.places]
            batch = spark.read.option("basePath", ledger.uri("data")).parquet(*places).drop("run")
            parts = max(1, -(-sum(entry.size for entry in held) // target_bytes))
            batch.repartition(parts).write.partitionBy(*partition_by).parquet(ledger.uri(place))
            rows, size = sum(entry.rows for entry in held), ledger.size_of([place])
        entry = Entry(run[0].first, run[-1].last, [place] if held else [], rows, size)
        ledger.add(entry)
        done.append(entry)
    return done
