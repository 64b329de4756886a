"""Cross-entropy difference of two matched bigram models over one vocabulary.

The vocabulary is a public byte-level BPE, which encodes every text. Both models
count bigrams of its tokens, one in the target documents, one in all, and are
smoothed alike (Witten-Bell). Counts are a table with a row for each bigram found,
as many as the documents have. Documents meet it in chunks of bounded size: a chunk
counts each of its bigrams once, asks for what they cost, and sums that up by document.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.llm import byte_bpe
from tickwatch.llm.frames import quoted, unused, with_struct
from tickwatch.settings import as_buckets, as_table

COLUMNS = ["n_tokens", "target_loss", "background_loss", "score"]
MODELS = ["target", "background"]
# Tokens of the documents that one worker holds at once, and takes apart at once; a longer document is taken whole.
CHUNK = 1 << 22
SLICE = 1 << 18
ROWS_AT_ONCE = 1 << 16


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str, vocabulary: int | None = None) -> byte_bpe.Codec:
    """The codec of the first tokens of a vocabulary, a BPE itself, or of all of them."""
    whole = byte_bpe.codec(path, pattern)
    if vocabulary is None:
        return whole
    return byte_bpe.Codec({token: rank for token, rank in whole.ranks.items() if rank < vocabulary}, pattern)


def packed_type(vocabulary: int) -> str:
    """Little-endian bytes of a token id."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def tokens(df: DataFrame, path: str, pattern: str, vocabulary: int | None, text_col: str, names: list[str]) -> DataFrame:
    """Add packed token ids, the chunk of each row, which is a run of rows of one task, and its place there; null is the empty text."""

    @F.arrow_udf("ids binary, chunk bigint, place bigint")
    def dealt(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = codec(path, pattern, vocabulary)
        kind = packed_type(len(one.ranks))
        chunk, place, held = TaskContext.get().partitionId() << 32, 0, 0
        for texts in batches:
            found, chunks, places = [], [], []
            for text in texts:
                ids = np.frombuffer(one.encode(text.as_py() or ""), "<u4").astype(kind).tobytes()
                # Each row counts as one byte more, so that empty ones fill a chunk as well.
                if held and held + len(ids) + 1 > 2 * CHUNK:
                    chunk, place, held = chunk + 1, 0, 0
                found.append(ids)
                chunks.append(chunk)
                places.append(place)
                place, held = place + 1, held + len(ids) + 1
            columns = [pa.array(found, pa.binary()), pa.array(chunks, pa.int64()), pa.array(places, pa.int64())]
            yield pa.StructArray.from_arrays(columns, ["ids", "chunk", "place"])

    made = dealt.asNondeterministic()(F.col(quoted(text_col)).cast("string"))
    return with_struct(df, made, dict(zip(["ids", "chunk", "place"], names)))


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts with few tokens together."""
    first, held = 0, 0
    for n, ids in enumerate(texts):
        if held and held + len(ids) > 2 * SLICE:
            yield first, n
            first, held = n, 0
        held += len(ids)
    if first < len(texts):
        yield first, len(texts)


def bigrams(texts: list[bytes], vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """The text and the number of each token after the one before it; the start of a text is a token of its own."""
    kind = np.dtype(packed_type(vocabulary))
    sizes = np.array([len(ids) // kind.itemsize for ids in texts], np.int64)
    current = np.frombuffer(b"".join(texts), kind).astype(np.int64)
    before = np.empty_like(current)
    before[1:] = current[:-1]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = vocabulary
    return np.repeat(np.arange(len(sizes)), sizes), before * vocabulary + current


def added(numbers: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Sorted numbers, each once, and their summed counts."""
    if not len(numbers):
        return [numbers, *counts]
    order = np.argsort(numbers)
    numbers = numbers[order]
    starts = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
    return [numbers[starts], *(np.add.reduceat(one[order], starts) for one in counts)]


def chunk_counts(rows: DataFrame, targets: DataFrame, vocabulary: int) -> DataFrame:
    """``chunk``, ``bigram`` and its counts there in target documents and in all; a chunk is one group.

    Input: ``chunk``, ``place`` and ``ids`` of rows; ``chunk`` and ``place`` of target rows.
    """

    def slice_counts(texts: list[bytes], wanted: np.ndarray) -> list[np.ndarray]:
        owner, found = bigrams(texts, vocabulary)
        # The last bit says whether the document is a target.
        found = np.sort(found * 2 + wanted[owner])
        numbers, target = found >> 1, found & 1
        if not len(found):
            return [numbers, target, target]
        starts = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
        return [numbers[starts], np.add.reduceat(target, starts), np.diff(np.append(starts, len(found)))]

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = left.column("ids").to_pylist()
        flags = np.isin(left.column("place").to_numpy(), right.column("place").to_numpy()).astype(np.int64)
        each = [slice_counts(texts[a:b], flags[a:b]) for a, b in slices(texts)]
        columns = added(*map(np.concatenate, zip(*each))) if each else [np.zeros(0, np.int64)] * 3
        same = np.full(len(columns[0]), left.column("chunk")[0].as_py() if texts else 0, np.int64)
        made = pa.table({name: pa.array(column, pa.int64()) for name, column in zip(["chunk", "bigram", *MODELS], [same, *columns])})
        # In small batches, as the JVM holds each whole.
        return pa.Table.from_batches(made.to_batches(ROWS_AT_ONCE), made.schema)

    schema = "chunk bigint, bigram bigint, target bigint, background bigint"
    return rows.groupBy("chunk").cogroup(targets.groupBy("chunk")).applyInArrow(counted, schema)


def losses(counts: DataFrame, vocabulary: int) -> DataFrame:
    """Bits that each ``bigram`` costs in both models, by Witten-Bell smoothing of bigrams with tokens, and of those with the even spread.

    A token is the last or the first one of at most as many bigrams as there are tokens.
    """
    size = F.lit(vocabulary).cast("bigint")
    split = counts.withColumn("before", F.expr(f"bigram div {vocabulary}L")).withColumn("token", F.col("bigram") % size)

    def sums(prefix: str) -> list[Column]:
        made = [(F.sum(name).alias(f"{prefix}_{name}"), F.count_if(F.col(name) > 0).alias(f"{prefix}_{name}_kinds")) for name in MODELS]
        return [column for pair in made for column in pair]

    single = split.groupBy("token").agg(*[F.sum(name).alias(name) for name in MODELS])
    whole = single.agg(*sums("all")).first()
    lows = []
    for name in MODELS:
        kinds, total = whole[f"all_{name}_kinds"], whole[f"all_{name}"] or 0
        low = (F.col(name) + F.lit(kinds / vocabulary)) / F.lit(total + kinds) if kinds else F.lit(1 / vocabulary)
        lows.append(low.alias(f"low_{name}"))
    joined = split.join(split.groupBy("before").agg(*sums("after")), "before").join(single.select("token", *lows), "token")
    made = []
    for name in MODELS:
        kinds, low = F.col(f"after_{name}_kinds"), F.col(f"low_{name}")
        weight = F.col(f"after_{name}") + kinds
        mixed = F.when(weight > 0, (F.col(name) + kinds * low) / weight).otherwise(low)
        made.append((-F.log2(mixed)).cast("float").alias(f"{name}_loss"))
    return joined.select("bigram", *made)


def summed(rows: DataFrame, costs: DataFrame, vocabulary: int) -> DataFrame:
    """``chunk``, ``place`` and ``found``, the result columns, of each row; a chunk is one group.

    Input: ``chunk``, ``place`` and ``ids`` of rows; ``chunk``, ``bigram`` and both losses of its bigrams.
    """

    def means(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = left.column("ids").to_pylist()
        numbers = right.column("bigram").to_numpy()
        order = np.argsort(numbers)
        numbers = numbers[order]
        tables = [right.column(f"{name}_loss").to_numpy()[order] for name in MODELS]
        sizes, each = np.zeros(len(texts), np.int64), [np.zeros(len(texts)) for _ in MODELS]
        for a, b in slices(texts):
            owner, wanted = bigrams(texts[a:b], vocabulary)
            places = np.searchsorted(numbers, wanted)
            sizes[a:b] = np.bincount(owner, minlength=b - a)
            for mean, table in zip(each, tables):
                mean[a:b] = np.bincount(owner, table[places], b - a) / np.maximum(sizes[a:b], 1)
        columns = [pa.array(sizes), *(pa.array(one, mask=sizes == 0) for one in (*each, each[0] - each[1]))]
        found = pa.StructArray.from_arrays(columns, COLUMNS)
        return pa.table({"chunk": left.column("chunk"), "place": left.column("place"), "found": found})

    schema = "chunk bigint, place bigint, found struct<n_tokens bigint, target_loss double, background_loss double, score double>"
    return rows.groupBy("chunk").cogroup(costs.groupBy("chunk")).applyInArrow(means, schema)


def score(
    df: DataFrame,
    target: str,
    path: str,
    pattern: str,
    text_col: str = "text",
    vocabulary: int | None = None,
) -> DataFrame:
    """Add ``n_tokens``, the mean loss per token under both models, and ``score``, target minus background.

    ``target`` names a boolean column that marks the target documents; null is not one.
    Documents with low scores resemble the target more than the whole. Null and empty
    texts have no tokens and null losses. Counts are of all documents; repeated rows
    count as often as they stand. Same-named columns of the input are replaced; an
    empty table gives an empty result. Without target documents, their model is the
    even spread. The tokens are the first ``vocabulary`` ones, or all. Rows with their
    token ids and the counts of all bigrams are written to the shared folder; one row
    of sums comes to the driver.
    """
    names = unused(df, "ids", "chunk", "place")
    size = vocabulary or vocabulary_size(path, pattern)
    return score_ids(tokens(df, path, pattern, vocabulary, text_col, names), target, names, size)


def vocabulary_size(path: str, pattern: str) -> int:
    return len(codec(path, pattern).ranks)


def score_ids(df: DataFrame, target: str | Callable[[DataFrame], DataFrame], names: list[str], vocabulary: int) -> DataFrame:
    """``score`` of rows with the columns of ``tokens``, which go by these names and are left out of the result.

    ``target`` may also be a function that takes the rows and gives those of the target,
    each at most once; it may join them without their ids, which are not shuffled.
    """
    ids, chunk, place = names
    (found,) = unused(df, "found")
    encoded = as_buckets(df, "lm-tokens", chunk)
    rows = encoded.select(F.col(chunk).alias("chunk"), F.col(place).alias("place"), F.col(ids).alias("ids"))
    chosen = target(encoded.drop(ids)) if callable(target) else encoded.where(F.col(quoted(target)).cast("boolean"))
    targets = chosen.select(F.col(chunk).alias("chunk"), F.col(place).alias("place"))
    partial = as_table(chunk_counts(rows, targets, vocabulary), "lm-chunks")
    counts = as_table(partial.groupBy("bigram").agg(*[F.sum(name).alias(name) for name in MODELS]), "lm-counts")
    # A bigram stands once for each chunk, however often its documents have it.
    costs = partial.select("chunk", "bigram").join(losses(counts, vocabulary), "bigram")
    results = summed(rows, costs, vocabulary).toDF(chunk, place, found)
    return with_struct(encoded.join(results, [chunk, place]), F.col(found), COLUMNS).drop(*names, found)
