"""Exact quantile of a distributed column."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# So many different values are few enough to be ranked in one place.
FEW = 20_000


def value_at(values: DataFrame, rank: int, accuracy: int = 10000, few: int = FEW) -> float:
    """The value at a rank (from 0) of the column ``v``, which holds no nulls.

    A mergeable sketch with a rank error of 1/accuracy brackets the rank. Rows below
    the bracket are only counted, and rows inside go on to the next pass, until at
    most ``few`` different values are left for the driver. A bracket that misses the
    rank is an error, never a wrong answer.
    """
    while True:
        folded = values.groupBy("v").agg(F.count("*").alias("n"))
        held = folded.agg(F.count("*").alias("kinds"), F.sum("n").alias("n")).first()
        if held["kinds"] <= few:
            break
        margin = 2.0 / accuracy
        bracket = [max(rank / held["n"] - margin, 0.0), min(rank / held["n"] + margin, 1.0)]
        low, high = values.agg(F.percentile_approx("v", bracket, accuracy)).first()[0]
        rank -= values.where(F.col("v") < low).count()
        values = values.where(F.col("v").between(low, high))
        if low == high and 0 <= rank < values.count():
            return low
    if rank >= 0:
        for row in sorted(folded.collect()):
            if rank < row["n"]:
                return row["v"]
            rank -= row["n"]
    raise ValueError("the sketch missed the rank")


def exact_quantile(df: DataFrame, column: str, q: float, accuracy: int = 10000, few: int = FEW) -> float | None:
    """Quantile by linear interpolation between the two nearest ranks; null without values.

    ``percentile`` would keep every distinct value in one task; a window over all rows
    would sort them in one.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    count = values.count()
    if not count:
        return None
    place = q * (count - 1)
    below = value_at(values, floor(place), accuracy, few)
    above = value_at(values, ceil(place), accuracy, few) if place % 1 else below
    return below + (above - below) * (place - floor(place))
