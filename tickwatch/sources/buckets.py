"""The market table in hash buckets, of which a sync rewrites only those that change.

A snapshot names a place and a digest for each bucket. A sync compares the digest of the
feed's rows of each bucket with that of the bucket's active rows, reads and merges the
buckets that differ, and writes these anew; the next snapshot refers to the others where
they are. The next snapshot appears in one rename, and older ones stay readable.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.operators import markets as sync
from tickwatch.operators.compare import digest
from tickwatch.schemas import MARKET_ATTRIBUTES, MARKET_SCHEMA

BUCKETS = 64
_COLUMNS = ("market", *MARKET_ATTRIBUTES, "is_active")


@dataclass(frozen=True)
class Bucket:
    """Where the rows of a bucket are, and the digest of the active ones: count and two sums, as text."""

    place: str
    digest: tuple[str, str, str]


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("market"), F.lit(buckets)).cast("int")


class MarketStore:
    """The snapshots of one market table."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.files, self.root = fs.FileSystem.from_uri(self.path)

    def versions(self) -> list[int]:
        listed = self.files.get_file_info(fs.FileSelector(f"{self.root}/snapshots", allow_not_found=True))
        return sorted(int(info.base_name[:-5]) for info in listed if info.base_name.endswith(".json"))

    def snapshot(self, version: int | None = None) -> dict[int, Bucket]:
        """The buckets of a version, the newest if none is named; a bucket without rows has no place."""
        versions = self.versions()
        if not versions:
            return {}
        version = versions[-1] if version is None else version
        with self.files.open_input_stream(f"{self.root}/snapshots/{version:08d}.json") as stream:
            held = json.loads(stream.read())
        if held["buckets"] != self.buckets:
            raise ValueError(f"the table has {held['buckets']} buckets, not {self.buckets}")
        return {int(number): Bucket(one["place"], tuple(one["digest"])) for number, one in held["held"].items()}

    def read(self, version: int | None = None, numbers: set[int] | None = None) -> DataFrame:
        """The market table, or the rows of some of its buckets."""
        held = self.snapshot(version)
        places = [f"{self.path}/{one.place}" for number, one in held.items() if numbers is None or number in numbers]
        if not places:
            return self.spark.createDataFrame([], MARKET_SCHEMA)
        return self.spark.read.schema(MARKET_SCHEMA).parquet(*places)

    def digests(self, rows: DataFrame) -> dict[int, tuple[str, str, str]]:
        """The digest of each bucket's active rows; one row a bucket comes to the driver."""
        active = rows.where("is_active").groupBy(bucket_of(self.buckets).alias("bucket")).agg(*digest(_COLUMNS))
        return {row["bucket"]: (str(row["n"]), str(row["one"]), str(row["other"])) for row in active.collect()}

    def write(self, rows: DataFrame, kept: dict[int, Bucket]) -> int:
        """Write rows as the buckets they belong to, and a snapshot of them and the buckets that are kept."""
        run = f"data/{uuid.uuid4().hex}"
        dealt = rows.select(*_COLUMNS).withColumn("bucket", bucket_of(self.buckets)).repartition("bucket")
        dealt.write.partitionBy("bucket").parquet(f"{self.path}/{run}")
        listed = self.files.get_file_info(fs.FileSelector(f"{self.root}/{run}", allow_not_found=True))
        numbers = [int(info.base_name.split("=")[1]) for info in listed if info.base_name.startswith("bucket=")]
        written = self.spark.read.schema(f"{MARKET_SCHEMA}, bucket INT").parquet(f"{self.path}/{run}")
        found = self.digests(written)
        none = ("0", "None", "None")
        held = kept | {number: Bucket(f"{run}/bucket={number}", found.get(number, none)) for number in numbers}
        return self.commit(held)

    def commit(self, held: dict[int, Bucket]) -> int:
        version = (self.versions() or [0])[-1] + 1
        self.files.create_dir(f"{self.root}/snapshots", recursive=True)
        waiting = f"{self.root}/snapshots/.{uuid.uuid4().hex}"
        with self.files.open_output_stream(waiting) as stream:
            rows = {number: asdict(one) for number, one in sorted(held.items())}
            stream.write(json.dumps({"buckets": self.buckets, "held": rows}).encode())
        self.files.move(waiting, f"{self.root}/snapshots/{version:08d}.json")
        return version

    def changed_buckets(self, flat: DataFrame) -> set[int]:
        """The buckets whose active rows are not those of a flattened feed."""
        fresh = self.digests(flat.withColumn("is_active", F.lit(True)))
        held = {number: one.digest for number, one in self.snapshot().items() if one.digest[0] != "0"}
        return {number for number in fresh.keys() | held.keys() if fresh.get(number) != held.get(number)}

    def sync(self, feed: DataFrame, order: str = "seq") -> set[int]:
        """Make the table what ``markets.sync_snapshot`` makes of it; returns the buckets that were rewritten.

        A feed that changes nothing writes nothing. Only the rows of differing buckets are
        joined. Run it from one place at a time.
        """
        numbers = self.changed_buckets(sync.flatten_feed(feed, order))
        if numbers:
            mine = bucket_of(self.buckets).isin(sorted(numbers))
            rows = sync.sync_snapshot(self.read(numbers=numbers), feed.where(mine), order=order)
            kept = {number: one for number, one in self.snapshot().items() if number not in numbers}
            self.write(rows, kept)
        return numbers
