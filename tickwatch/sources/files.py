"""Ticks, market feeds and tables from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.schemas import FEED_ITEM_SCHEMA, MARKET_SCHEMA
from tickwatch.settings import as_table


def read_tick_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Text files with one tick per line, as ``value``."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path)


def stream_table(
    spark: SparkSession, folder: str, name: str, max_files: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """A parquet table read as a stream, be it one file or a folder of files.

    The bracket makes the path a pattern; a plain path to a single file is refused.
    Without a limit the first batch takes all files, so no row can be late. With a
    limit the files must have been written in time order.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(f"{folder}/{name}.parque[t]")


def _is_list(text: Column) -> Column:
    """Whether a text is exactly one JSON list."""
    # The list must be the one member of an object that it cannot close, as with ticks.
    digest = F.sha2(text.cast("binary"), 256)
    named = F.concat(F.lit('{"list":'), text, F.lit(',"'), digest, F.lit('":true}'))
    names = F.map_keys(F.from_json(named, "MAP<STRING, STRING>", {"allowSingleQuotes": "false"}))
    return names.eqNullSafe(F.array(F.lit("list"), digest)) & F.ltrim(text, F.lit(" \t\r\n")).startswith("[")


def _items(text: Column) -> Column:
    return F.from_json(text, f"ARRAY<{FEED_ITEM_SCHEMA}>", {"mode": "FAILFAST", "allowSingleQuotes": "false"})


def _entries_by_line(spark: SparkSession, path: str, newest: str) -> DataFrame | None:
    """(seq, item) of a reply with an entry a line, read in splits; none if it is laid out otherwise.

    The first line is ``[`` and an entry, each further one ``,`` and an entry, the last one ``]``.
    Only the number of lines of each split comes to the driver.
    """
    lines = spark.read.text(path).where(F.col("_metadata.file_path") == newest).select(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.trim("value", F.lit(" \t")).alias("line"),
    )
    one = F.concat(F.lit("["), F.expr("substr(line, 2)"), F.lit("]"))
    mark, alone = F.substring("line", 1, 1), F.ltrim(F.expr("substr(line, 2)"), F.lit(" \t")).startswith("{")
    is_entry = mark.isin("[", ",") & alone & _is_list(one) & F.json_array_length(one).eqNullSafe(F.lit(1))
    kind = F.when(F.col("line") == "]", "]").when(is_entry, mark).otherwise("?")
    placed = as_table(lines.select("block", "at", kind.alias("kind"), one.alias("one")), "feed-lines")
    marks = [F.count_if(F.col("kind") == mark).alias(mark) for mark in "[]?"]
    ends = F.min_by("kind", "at").alias("first"), F.max_by("kind", "at").alias("last")
    held = placed.groupBy("block").agg(F.count("*").alias("n"), F.min("at").alias("at"), *ends, *marks).orderBy("block").collect()
    totals = [sum(row[mark] for row in held) for mark in "[]?"]
    if not held or totals != [1, 1, 0] or (held[0]["first"], held[-1]["last"]) != ("[", "]"):
        return None
    offsets, before = [], 0
    for row in held:
        offsets += [F.lit(row["block"]), F.lit(before - row["at"])]
        before += row["n"]
    seq = F.element_at(F.create_map(*offsets), F.col("block")) + F.col("at")
    return placed.where("kind <> ']'").select(seq.cast("bigint").alias("seq"), F.explode(_items(F.col("one"))).alias("item"))


def _entries_at_once(spark: SparkSession, path: str, newest: str | None, allow_empty: bool) -> DataFrame:
    """(seq, item) of a reply of any layout, which one task holds whole."""
    landed = spark.read.text(path, wholetext=True).where(F.col("_metadata.file_path") == newest)
    reply = landed.agg(F.coalesce(F.max("value"), F.lit("")).alias("reply"))
    read = reply.select(
        F.when(_is_list(F.col("reply")), _items(F.col("reply")))
        .otherwise(F.raise_error(F.lit("feed reply is not one list")))
        .alias("items")
    )
    if not allow_empty:
        some = F.when(F.size("items") > 0, F.col("items"))
        read = read.select(F.coalesce(some, F.raise_error(F.lit("feed reply is empty"))).alias("items"))
    return read.select(F.posexplode("items").alias("position", "item")).select(F.col("position").cast("bigint").alias("seq"), "item")


def read_market_feed(spark: SparkSession, path: str, allow_empty: bool = False) -> DataFrame:
    """The newest landed feed reply, one JSON array, as entries in array order (``seq``).

    Each reply is one file, as the order of its entries decides which of two for the
    same market is the last. Of several files the one changed last, then the last by
    name, is taken: a sync compares with one reply, and an older one would hide what
    has been delisted since. It is chosen by this call, and its layout is looked at: a
    reply with an entry a line, as large ones should be landed, is read by many tasks,
    one of any other layout by a single one. A reply that is not exactly one list of
    named markets fails the read, and so does an empty one unless that is allowed:
    taken as no entries, it would delist every market.
    """
    landed = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    # Of binary files only what is selected is read, here none of their content.
    files = spark.read.format("binaryFile").load(path).select(landed.alias("landed"))
    newest = files.agg(F.max("landed").alias("landed")).first()["landed"]
    file_path = newest["file_path"] if newest else None
    entries = _entries_by_line(spark, path, file_path) if newest else None
    if entries is None:
        entries = _entries_at_once(spark, path, file_path, allow_empty)
    needed = [
        F.coalesce(F.col(f"item.{name}"), F.raise_error(F.lit(f"feed entry without {name}"))).alias(name)
        for name in ("market", "korean_name", "english_name")
    ]
    return entries.select("seq", *needed, "item.market_event")


def read_markets(spark: SparkSession, path: str) -> DataFrame:
    """The market table."""
    return spark.read.schema(MARKET_SCHEMA).parquet(path)


def write_markets(snapshot: DataFrame, folder: str, version: str) -> str:
    """Write the next market table beside the one it was made from."""
    path = f"{folder}/version={version}"
    snapshot.write.mode("overwrite").parquet(path)
    return path


def market_codes(markets: DataFrame) -> DataFrame:
    """Codes of all markets, the only column this reads."""
    return markets.select("market")
