"""Packing token sequences by bulk-synchronous best fit.

Each round sorts waiting pieces and the gaps of open sequences by size, over ranges in
parallel, and sweeps them in ascending order: a gap takes the largest waiting piece
below it. Gaps wide enough for several of the largest waiting pieces count as several.
What a range leaves over, gaps that found no piece and pieces that met no
gap, is matched between ranges by rank, from counts alone. Then gaps shrink, and the
next round begins.
"""

from __future__ import annotations

import functools
import itertools
import re
import string
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch.llm.byte_bpe import mapped
from tickwatch.llm.caches import BoundedCache
from tickwatch.llm.frames import quoted
from tickwatch.settings import as_table

CAPACITY = 4096
END_ID = 1
LONG = 1 << 20
WORDS_AT_ONCE = 1 << 18
# Rows in each file of a round's tables, which are a few numbers each.
ROWS_A_FILE = 1 << 16
# Words whose ids are kept, in each of two generations.
ENTRIES = 400_000
# Signs behind words; an apostrophe may belong to the word.
SIGNS = string.punctuation.replace("'", "")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# The tokeniser's own pieces of a lower-cased text, and the texts that are cut up here: Latin
# letters, each of which has one lower case, and usual signs, without its special tokens.
NUMBERS = r"\d²³¹¼½¾"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[^\W_{NUMBERS}]+|[{NUMBERS}]|(?:[^\s\w]|_)+")
LATIN = re.compile("[\x00-\x1b\x20-\x7f\xa1-\u012f\u0131-\u024f\u2010-\u2026\u20ac]*")
SPECIAL = "<|"
# str.split also splits at these, the tokeniser does not.
SEPARATORS = re.compile("[\x1c-\x1f]")

PAIR, PIECE_LEFT, GAP_LEFT = 0, 1, 2
SWEPT = "what int, block int, at bigint, item bigint, length int, sequence bigint, gap int"


class WordTokeniser:
    """Packed ids of a text by a tokeniser that drops white space, so that words are independent."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokeniser = Tokenizer.from_file(path)
        self.packed = BoundedCache(self.encode_word, ENTRIES)
        self.pieces = BoundedCache(self.encode_piece, ENTRIES)

    def encode_piece(self, piece: str) -> bytes:
        """Ids of one of the tokeniser's own pieces, straight from its merges."""
        plain = piece.isascii() and piece.isprintable()
        tokens = self.tokeniser.model.tokenize(piece if plain else mapped(piece.encode()))
        return struct.pack(f"<{len(tokens)}I", *[token.id for token in tokens])

    def encode_word(self, word: str) -> bytes:
        # Letters and signs behind them are split, and letters lower-cased, before any merge;
        # so the library is only asked for their lower-case runs. Letters that
        # normalise to a letter and a mark are left to it.
        letters = word.rstrip(SIGNS)
        if letters.isalpha() and unicodedata.normalize("NFC", letters).lower().isalpha():
            if len(letters) < len(word):
                return self.packed[letters] + self.packed[word[len(letters) :]]
            if word.isascii() and not word.islower():
                return self.packed[word.lower()]
        ids = self.tokeniser.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if len(text) <= LONG:
            if SPECIAL not in text and LATIN.fullmatch(text) and unicodedata.is_normalized("NFC", text):
                return b"".join(map(self.pieces.__getitem__, PIECES.findall(text.lower())))
            words = WORD.findall(text) if SEPARATORS.search(text) else text.split()
            return b"".join(map(self.packed.__getitem__, words))
        out, words = bytearray(), (found[0] for found in WORD.finditer(text))
        while part := list(itertools.islice(words, WORDS_AT_ONCE)):
            out += b"".join(map(self.packed.__getitem__, part))
        return bytes(out)

    def forget(self) -> None:
        """Let go of all words kept."""
        self.packed.forget()
        self.pieces.forget()


@functools.lru_cache(maxsize=2)
def tokeniser(path: str) -> WordTokeniser:
    """The tokeniser of a file, read once in each worker."""
    return WordTokeniser(path)


def cut_up(
    batches: Iterator[pa.RecordBatch], path: str, capacity: int, end: bytes, narrow: bool, names: list[str]
) -> Iterator[pa.RecordBatch]:
    """Pieces of the texts of one task, each batch an id and a text.

    Words and texts are let go when it ends: a worker that waits for its next task,
    of which an executor may have several, holds no more than the tokeniser.
    """
    own = tokeniser(path)
    try:
        for batch in batches:
            # Some hundred texts at a time, as ids take more room than text.
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows, pieces, starts, sizes, ids = [], [], [], [], []
                for row, text in enumerate(part.column(1)):
                    packed = own.encode(text.as_py() or "") + end
                    for number, begin in enumerate(range(0, len(packed), 4 * capacity)):
                        piece = packed[begin : begin + 4 * capacity]
                        rows.append(row)
                        pieces.append(number)
                        starts.append(begin // 4)
                        sizes.append(len(piece) // 4)
                        ids.append(np.frombuffer(piece, "<u4").astype("<u2").tobytes() if narrow else piece)
                columns = [
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
    finally:
        batch = part = columns = text = rows = pieces = starts = sizes = ids = packed = piece = None
        own.forget()
        pa.default_memory_pool().release_unused()


def token_pieces(
    df: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    narrow: bool = False,
) -> DataFrame:
    """Token ids of each whole text and an end id, cut into pieces only where longer than ``capacity``.

    Returns the id column, ``piece`` (from 0), ``start`` (ids before it), ``length`` and
    ``ids`` (packed, four little-endian bytes an id). Null counts as the empty text,
    whose one piece is the end id. Each row has pieces of its own, repeated rows too. An
    empty table gives no pieces; very long texts are encoded part by part and held as ids.
    ``narrow`` ids take two bytes, for as long as they are stored and shuffled; ``widened``
    gives the usual ones. A vocabulary must have room in them.
    """
    source = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))
    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType())]
    schema = T.StructType([T.StructField(id_col, source.schema["id"].dataType), *[T.StructField(*f) for f in fields]])
    end = struct.pack("<I", end_id)
    if narrow and tokeniser(path).tokeniser.get_vocab_size() > 1 << 16:
        raise ValueError("the vocabulary has more ids than two bytes have")

    names = schema.fieldNames()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut_up(batches, path, capacity, end, narrow, names)

    return source.mapInArrow(cut, schema)


def widened(ids: Column) -> Column:
    """Narrow ids with four bytes each."""

    @F.arrow_udf("binary")
    def wide(packed: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(one.as_py(), "<u2").astype("<u4").tobytes() for one in packed], pa.binary())

    return wide(ids)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Match within one range of ascending sizes: each gap takes the last waiting piece.

    What is left over is numbered: gaps in the order they came, pieces by size.
    """
    names = ["what", "block", "at", "item", "length", "sequence", "gap"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    waiting, gaps, block = [], 0, None
    for batch in batches:
        rows = []
        parts = (batch.column(name).to_pylist() for name in ("block", "size", "is_gap", "id"))
        for block, size, is_gap, number in zip(*parts):
            if not is_gap:
                waiting.append((number, size))
            elif waiting:
                item, length = waiting.pop()
                rows.append((PAIR, block, None, item, length, number, size))
            else:
                rows.append((GAP_LEFT, block, gaps, None, None, number, size))
                gaps += 1
        yield table(rows)
    for at in range(0, len(waiting), 10_000):
        part = enumerate(waiting[at : at + 10_000], at)
        yield table([(PIECE_LEFT, block, number, item, length, None, None) for number, (item, length) in part])


def ranges_between(left: dict[int, dict[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Which left-over gaps of a block take which left-over pieces of lower blocks, as ranges of ranks.

    ``left`` has the counts of both for each block. A range is (first pair number, gap
    block, first gap, piece block, first piece), its pieces falling in rank; there are
    no more ranges than twice the blocks. Length is found from the next range's number.
    """
    waiting: list[list[int]] = []
    ranges, number = [], 0
    for block in sorted(left):
        gaps, taken = left[block].get(GAP_LEFT, 0), 0
        while taken < gaps and waiting:
            below, pieces = waiting[-1]
            size = min(gaps - taken, pieces)
            ranges.append((number, size, block, taken, below, pieces - 1))
            number, taken = number + size, taken + size
            waiting[-1][1] -= size
            if not waiting[-1][1]:
                waiting.pop()
        if pieces := left[block].get(PIECE_LEFT, 0):
            waiting.append([block, pieces])
    return ranges


RANGES = pa.schema(
    {
        "number": pa.int64(),
        "size": pa.int64(),
        "gap_block": pa.int32(),
        "first_gap": pa.int64(),
        "piece_block": pa.int32(),
        "first_piece": pa.int64(),
    }
)


def matched(spark: SparkSession, swept: DataFrame) -> DataFrame:
    """Pairs of a piece and its gap, those within ranges and those between them."""
    counts: dict[int, dict[int, int]] = {}
    for row in swept.where(F.col("what") != PAIR).groupBy("block", "what").count().collect():
        counts.setdefault(row["block"], {})[row["what"]] = row["count"]
    pairs = swept.where(F.col("what") == PAIR).select("item", "length", "sequence", "gap")
    ranges = ranges_between(counts)
    if not ranges:
        return pairs
    # At most two rows a block; as an Arrow table they need no Python workers of their own.
    known = pa.Table.from_pylist([dict(zip(RANGES.names, one)) for one in ranges], RANGES)
    known = F.broadcast(spark.createDataFrame(known))
    gap_at = F.col("at") - F.col("first_gap")
    gaps = swept.where(F.col("what") == GAP_LEFT).join(known, F.col("block") == F.col("gap_block"))
    gaps = gaps.where(gap_at.between(0, F.col("size") - 1))
    gaps = gaps.select((F.col("number") + gap_at).alias("pair"), "sequence", "gap")
    piece_at = F.col("first_piece") - F.col("at")
    pieces = swept.where(F.col("what") == PIECE_LEFT).join(known, F.col("block") == F.col("piece_block"))
    pieces = pieces.where(piece_at.between(0, F.col("size") - 1))
    pieces = pieces.select((F.col("number") + piece_at).alias("pair"), "item", "length")
    return pairs.unionByName(pieces.join(gaps, "pair").drop("pair"))


def slots(gaps: DataFrame, largest: int) -> DataFrame:
    """Each gap cut into as many slots as pieces of the largest size fit in it, the last one with what is left over.

    So a gap takes several pieces in a round once all that wait are small.
    """
    count = F.greatest(F.lit(1), F.floor(F.col("gap") / largest)).cast("int")
    spread = gaps.select("sequence", "gap", count.alias("count"), F.explode(F.sequence(F.lit(1), count)).alias("slot"))
    rest = F.col("gap") - (F.col("count") - 1) * largest
    return spread.select("sequence", F.when(F.col("slot") < F.col("count"), largest).otherwise(rest).cast("int").alias("gap"))


def best_fit(items: DataFrame, capacity: int) -> DataFrame:
    """Give items (``item``, ``length`` up to ``capacity``) their ``sequence_id`` and ``offset``."""
    spark = items.sparkSession
    whole = items.where(F.col("length") == capacity)
    placed = [whole.select("item", "length", (-1 - F.col("item")).alias("sequence_id"))]
    waiting = items.where(F.col("length") < capacity).select("item", F.col("length").cast("int").alias("length"))
    gaps = spark.createDataFrame([], "sequence bigint, gap int")
    opened, widest = 0, 0

    def as_files(df: DataFrame, label: str) -> DataFrame:
        # As many files as rows need, not one for each shuffle partition: on local disks Spark
        # forks the executor several times for each file it opens.
        return as_table(df.repartition(-(-max(sizes["count"], opened) // ROWS_A_FILE)), label)

    while True:
        sizes = waiting.agg(
            F.count(F.lit(1)).alias("count"),
            F.sum("length").alias("sum"),
            F.min("length").alias("least"),
            F.max("length").alias("largest"),
            F.sum((F.col("length") * 2 > capacity).cast("int")).alias("large"),
        ).first()
        if not sizes["count"]:
            break
        if widest < sizes["least"]:
            # No gap takes any piece: open as many sequences as the rest cannot do without.
            new = max(-(-sizes["sum"] // capacity), sizes["large"])
            gaps = spark.range(opened, opened + new).select(F.col("id").alias("sequence"), F.lit(capacity).alias("gap"))
            opened, widest = opened + new, capacity
        largest = sizes["largest"]
        if largest > widest:
            largest = waiting.where(F.col("length") <= widest).agg(F.max("length")).first()[0]
        usable = gaps.where(F.col("gap") >= sizes["least"])
        events = waiting.select(F.col("length").alias("size"), F.lit(False).alias("is_gap"), F.col("item").alias("id"))
        open_slots = slots(usable, largest).select(F.col("gap").alias("size"), F.lit(True).alias("is_gap"), F.col("sequence").alias("id"))
        order = ["size", "is_gap", "id"]
        ranged = events.unionByName(open_slots).repartitionByRange(*order).sortWithinPartitions(*order)
        ranged = ranged.select("size", "is_gap", "id", F.spark_partition_id().alias("block"))
        swept = as_files(ranged.mapInArrow(sweep, SWEPT), "swept")
        pairs = as_files(matched(spark, swept), "pairs")
        placed.append(pairs.select("item", F.col("length").cast("bigint").alias("length"), F.col("sequence").alias("sequence_id")))
        left = swept.where(F.col("what") == PIECE_LEFT).select("item", "length")
        used = pairs.groupBy("sequence").agg(F.sum("length").alias("used"))
        gap = (F.col("gap") - F.coalesce("used", F.lit(0))).cast("int")
        waiting = as_files(left.join(pairs.select("item"), "item", "left_anti"), "waiting")
        gaps = as_files(usable.join(used, "sequence", "left").select("sequence", gap.alias("gap")).where("gap > 0"), "gaps")
        widest = gaps.agg(F.max("gap")).first()[0] or 0
    # A sequence has no more pieces than its capacity.
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "item").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    return functools.reduce(DataFrame.unionByName, placed).select("item", "sequence_id", offset.alias("offset"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset``: pieces lie in few sequences of at most ``capacity``, without gaps between them.

    Every row is a piece of its own, also a repeated one. Lengths are 1 to
    ``capacity``; others, and null, fail. Ties between equal sizes go by an internal
    row number. Same-named columns of the input are replaced; an empty table gives an
    empty result.
    """
    kept = [name for name in pieces.columns if name.lower() not in ("sequence_id", "offset")]
    length = F.col(quoted(length_col)).cast("bigint")
    fits = F.when(length.between(1, capacity), length).otherwise(
        F.raise_error(F.concat(F.lit("no length to pack: "), F.coalesce(length.cast("string"), F.lit("null"))))
    )
    row = F.struct(F.lit(0).alias("none"), *[F.col(quoted(name)).alias(name) for name in kept]).alias("row")
    items = as_table(pieces.select(row, fits.alias("length"), F.monotonically_increasing_id().alias("item")), "pieces")
    found = best_fit(items.select("item", "length"), capacity)
    joined = items.select("row", F.col("item").alias("piece_item")).join(found, F.col("piece_item") == F.col("item"))
    return joined.select(
        *[F.col("row")[name].alias(name) for name in kept],
        F.col("sequence_id").cast("bigint").alias("sequence_id"),
        F.col("offset").cast("bigint").alias("offset"),
    )
