"""Distinct markets of any span of time from bitmaps that roll up.

Markets get dense numbers. Each narrow span keeps one bit for each market seen in it, in
bitmaps of 64 numbers; wider spans are unions of those. A count of distinct markets
can't be added up over spans, these can. A bitmap is one integer, so that a span with few
markets stays small and unions are folded in a hash table without a sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.functions.barrier import computed_once
from tickwatch.settings import as_table


def numbered(markets: DataFrame) -> DataFrame:
    """(market, number) with the numbers 1, 2, ... in the order of the codes; null has none.

    Each task numbers its own range of codes. Only the number of codes of each range comes
    to the driver.
    """
    codes = computed_once(markets, [], {"market": F.col("market")}).where(F.col("market").isNotNull()).distinct()
    ranged = codes.repartitionByRange("market").sortWithinPartitions("market")
    placed = as_table(ranged.withColumn("place", F.monotonically_increasing_id()), "codes")
    part, at = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    held = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    offsets, before = {}, 0
    for row in held:
        offsets[row["part"]] = before
        before += row["n"]
    if not offsets:
        return placed.select("market", F.col("place").alias("number"))
    pairs = [F.lit(value) for pair in offsets.items() for value in pair]
    return placed.select("market", (F.element_at(F.create_map(*pairs), part) + at + 1).cast("bigint").alias("number"))


def market_bitmaps(events: DataFrame, numbers: DataFrame, span: str = "1 second", clock: str = "ingest_time") -> DataFrame:
    """(span, part, markets): for each span the bitmaps of the markets with a valid event in it.

    Markets are folded by span before they get their numbers. Those without a number are
    left out.
    """
    valid = computed_once(events, [clock], {"market": F.when(~F.col("is_error"), F.col("market"))})
    seen = valid.where(F.col("market").isNotNull()).select(F.window(clock, span).alias("span"), "market").distinct()
    part, bit = F.shiftright(F.col("number") - 1, 6), F.expr("shiftleft(1L, CAST((number - 1) & 63 AS INT))")
    return seen.join(numbers, "market").groupBy("span", part.alias("part")).agg(F.bit_or(bit).alias("markets"))


def rolled_up(bitmaps: DataFrame, span: str) -> DataFrame:
    """The bitmaps of wider spans."""
    wide = F.window("span.start", span).alias("span")
    return bitmaps.groupBy(wide, "part").agg(F.bit_or("markets").alias("markets"))


def distinct_counts(bitmaps: DataFrame) -> DataFrame:
    """(checked_at, unique_market_count) of each span with a valid event."""
    counts = bitmaps.groupBy("span").agg(F.sum(F.bit_count("markets")).alias("unique_market_count"))
    return counts.select(F.col("span.end").alias("checked_at"), "unique_market_count")
