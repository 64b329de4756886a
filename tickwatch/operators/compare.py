"""Differences of two tables by digests of ranges, narrowed down where they differ.

Keys are dealt to ranges by a hash. The digest of a range is a count and two sums of
hashes, which need no order and no shuffle of rows: each task adds up its own. Where the
digests of a range are equal on both sides its rows are taken as equal; the others are
split further, and only the rows of the last ranges that differ are joined. Two sums of
64-bit hashes are equal by chance once in more cases than there are ranges to compare in
any practice; they don't guard against codes made to collide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the hash that make up a range, level by level.
LEVELS = (8, 16)


def key_range(key: str, bits: int) -> Column:
    """The number of the range a key is in, one of 2 to the power of ``bits``."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits)


def digest(columns: Sequence[str]) -> list[Column]:
    """Aggregates that tell sets of rows apart: how many there are, and two sums of hashes."""
    return [
        F.count("*").alias("n"),
        F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("one"),
        F.sum(F.xxhash64(F.lit("other"), *columns).cast("decimal(38,0)")).alias("other"),
    ]


def range_digests(rows: DataFrame, key: str, columns: Sequence[str], bits: int) -> DataFrame:
    return rows.groupBy(key_range(key, bits).alias("range")).agg(*digest(columns))


def differing_ranges(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], bits: int) -> list[int]:
    """The ranges whose digests differ; at most as many numbers as there are ranges come to the driver."""
    one, other = (range_digests(side, key, columns, bits) for side in (left, right))
    values = ["n", "one", "other"]
    both = one.select("range", F.struct(*values).alias("left")).join(
        other.select("range", F.struct(*values).alias("right")), "range", "full_outer"
    )
    return [row["range"] for row in both.where(~F.col("left").eqNullSafe(F.col("right"))).select("range").collect()]


def narrowed(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], levels: Sequence[int] = LEVELS
) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that lie in ranges which differ."""
    for bits in levels:
        ranges = differing_ranges(left, right, key, columns, bits)
        if len(ranges) == 1 << bits:
            # Nothing is left out, and a finer level would not leave out much.
            continue
        left, right = (side.where(_within(key, bits, ranges)) for side in (left, right))
    return left, right


def _within(key: str, bits: int, ranges: list[int]) -> Column:
    if not ranges:
        return F.lit(False)
    return key_range(key, bits).isin(ranges)


def only_in(
    left: DataFrame, right: DataFrame, key: str = "market", levels: Sequence[int] = LEVELS
) -> tuple[DataFrame, DataFrame]:
    """Keys that only the left side has, and keys that only the right side has, each once.

    Both sides must be cheap to read again, as tables are: they are read once a level.
    Null is a key like any other.
    """
    sides = [side.select(key).distinct() for side in (left, right)]
    some, others = narrowed(*sides, key, [key], levels)
    return some.subtract(others), others.subtract(some)
