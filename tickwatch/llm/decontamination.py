"""Benchmark passages in documents, found by Wu-Manber search over words.

A text is a run of words: ASCII letters, lower-cased, digits, and everything beyond ASCII.
Each benchmark item gives windows of consecutive words. For each window length there is
one search: a table says for every block of two words how far the end of any window is
away at least, so that most positions of a document are skipped; where a window may end,
the windows with that last block are looked up by their first block, and the words are
compared directly.

Windows are dealt to shards of a bounded number, and one shard at a time is sent to the
tasks. A benchmark of usual size is one shard, and the documents are read once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.frames import quoted, unused, with_struct
from tickwatch.settings import as_table

WINDOW = 10
# Words to a block of the shift table.
BLOCK = 2
# Windows that are sent to the tasks at once: about 60 MB in each worker.
SHARD_WINDOWS = 100_000

COLUMNS = ["n_words", "spans", "items"]
FOUND = "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

# Bytes of words map to themselves or their lower case, all others to a blank. Beyond
# ASCII every byte of a character is above 0x7F.
WORD_BYTES = bytes(
    byte if byte > 0x7F else ord(chr(byte).lower()) if chr(byte).isalnum() else 0x20 for byte in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text; null has none."""
    return text.translate(WORD_BYTES).split() if text else []


class WuManber:
    """Finds windows of one length in a run of words."""

    def __init__(self, length: int, windows: Iterable[tuple[list[bytes], str | None]]):
        self.length, self.block = length, min(BLOCK, length)
        self.shifts: dict[tuple[bytes, ...], int] = {}
        # Windows with their items, by last block and then by first block.
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], dict[tuple[bytes, ...], set]]] = {}
        same: dict[bytes, bytes] = {}
        for words, item in windows:
            window = tuple(same.setdefault(word, word) for word in words)
            for end in range(self.block, length + 1):
                block = window[end - self.block : end]
                self.shifts[block] = min(self.shifts.get(block, length), length - end)
            prefixes = self.buckets.setdefault(window[-self.block :], {})
            prefixes.setdefault(window[: self.block], {}).setdefault(window, set()).add(item)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, set]]:
        """(start, end, items) of every occurrence, by place."""
        length, block, shifts, buckets = self.length, self.block, self.shifts, self.buckets
        unknown = length - block + 1
        end, last = length, len(words)
        while end <= last:
            suffix = tuple(words[end - block : end])
            step = shifts.get(suffix, unknown)
            if step:
                end += step
                continue
            start = end - length
            windows = buckets[suffix].get(tuple(words[start : start + block]))
            items = windows and windows.get(tuple(words[start:end]))
            if items:
                yield start, end, items
            end += 1


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans as disjoint runs, by place."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


class Shard:
    """The searches for all window lengths of a shard."""

    def __init__(self, windows: list[tuple[bytes, str | None]]):
        by_length: dict[int, list] = {}
        for text, item in windows:
            words = text.split(b" ")
            by_length.setdefault(len(words), []).append((words, item))
        self.searches = [WuManber(length, found) for length, found in sorted(by_length.items())]

    def __call__(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        words = words_of(text)
        spans, items = [], set()
        for search in self.searches:
            for start, end, found in search.search(words):
                spans.append((start, end))
                items |= found
        items.discard(None)
        return len(words), merged(spans), sorted(items)


# The shard that this worker made last, by its name.
_made: dict[str, Shard] = {}


def shard_of(name: str, sent: Broadcast) -> Shard:
    if name not in _made:
        _made.clear()
        _made[name] = Shard(sent.value)
    return _made[name]


def windows_of(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(text, item) of all different windows: the words joined by blanks, and the item's id as text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1)):
                words, at = words_of(text.as_py()), 0
                # A very long item goes out in several batches.
                while words and (at == 0 or at + window <= len(words)):
                    ends = range(at + window, min(len(words), at + window + SHARD_WINDOWS) + 1) or [len(words)]
                    texts = [b" ".join(words[max(0, end - window) : end]) for end in ends]
                    items = pa.array([item.as_py()] * len(texts), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), items], ["text", "item"])
                    at += len(texts)

    columns = F.col(quoted(item_col)).cast("string").alias("item"), F.col(quoted(text_col)).cast("binary").alias("text")
    return benchmark.select(*columns).mapInArrow(cut, "text binary, item string").distinct()


def searched(sent: Broadcast, text: Column) -> Column:
    """What one shard finds in each text."""
    name = uuid.uuid4().hex

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        one = shard_of(name, sent)
        counts, spans, items = [], [], []
        for text in texts:
            count, at, which = one(text.as_py())
            counts.append(count)
            spans.append([{"start": start, "end": end} for start, end in at])
            items.append(which)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))], COLUMNS
        )

    return found(text)


def joined_spans(both: Column) -> Column:
    """Spans of several shards as disjoint runs, by place."""
    kind = "array<struct<start: bigint, end: bigint>>"

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        meets = (F.size(done) > 0) & (span["start"] <= last["end"])
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(both), F.array().cast(kind), add)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shard_windows: int = SHARD_WINDOWS,
) -> DataFrame:
    """Add ``n_words``, ``spans`` and ``items`` to documents.

    ``spans`` are the disjoint runs [start, end) of words that lie in an occurrence of a
    window of ``window`` item words, by place; an item of fewer words, but not none, is one
    window. ``items`` are the different ids of the items found, as text, sorted. Null and
    empty texts have no words and no spans, and a null or empty item no windows. Windows of
    an item without an id are found, but it is not listed. Items that share a window, or an
    id, count each; repeated documents are judged each for itself. Whole texts are searched,
    however long; one text at a time is held as words. An empty benchmark finds nothing. Same-named columns of the
    input are replaced.

    At most about ``shard_windows`` windows are sent to the tasks at once. Beyond that the
    documents are searched shard by shard and written between two.
    """
    spark = docs.sparkSession
    windows = as_table(windows_of(benchmark, item_col, item_text_col, window), "windows")
    shards = max(1, -(-windows.count() // shard_windows))
    dealt = windows.withColumn("shard", F.pmod(F.xxhash64("text", "item"), F.lit(shards)))
    (earlier,) = unused(docs, "earlier")
    for number in range(shards):
        part = dealt.where(F.col("shard") == number).select("text", "item").toArrow()
        sent = spark.sparkContext.broadcast(list(zip(part["text"].to_pylist(), part["item"].to_pylist())))
        if number:
            docs = as_table(docs, "searched")
            docs = docs.withColumn(earlier, F.struct("spans", "items"))
        docs = with_struct(docs, searched(sent, F.col(quoted(text_col)).cast("binary")), COLUMNS)
        if number:
            docs = docs.withColumns(
                {
                    "spans": joined_spans(F.concat(f"{earlier}.spans", "spans")),
                    "items": F.array_sort(F.array_union(f"{earlier}.items", "items")),
                }
            ).drop(earlier)
    return docs


def without_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents that ``find`` judged, without those that hold a benchmark passage; the added columns go."""
    return df.where(F.size("spans") == 0).drop(*COLUMNS)
