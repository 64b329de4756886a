"""Reversible line dedup: exact reference counts, and cuckoo filters that spare most lines a lookup.

An index knows which document holds which line key. It grows by documents inserted
and shrinks by documents deleted; each step writes a new version and leaves the
older ones readable. Its tables are

- ``references``: one row for each key and document that holds it,
- ``counts``: documents and largest document id of each key,
- ``filters``: one cuckoo filter for each shard of the key space, of the keys that
  enough documents hold.

A key is a line, stripped and lower-cased in ASCII, as a 128-bit digest in two halves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch.llm.cuckoo import CuckooFilter, Full
from tickwatch.llm.frames import quoted, unused, with_struct
from tickwatch.settings import as_table

LEAST_CHARS = 20
LEAST_DOCS = 3
# Parts of a shard that are probed apart, so that a line in very many documents is no hot spot.
SALTS = 16
SHARDS = 64
REFERENCES_PER_SHARD = 4_000_000
KEY = ["k1", "k2"]


def line_keys(text: str | None, least_chars: int) -> list[tuple[bytes, bytes]]:
    """The lines of a text, each with the bytes its key is made of, or none if those are too short."""
    lines = (text or "").encode().split(b"\n")
    keys = [line.strip().lower() for line in lines]
    # Four bytes at most make a code point.
    long = [len(key) >= 4 * least_chars or len(key) >= least_chars and len(key.decode()) >= least_chars for key in keys]
    return [(line, key if enough else None) for line, key, enough in zip(lines, keys, long)]


def halves(keys: list[bytes]) -> np.ndarray:
    digests = b"".join(xxhash.xxh3_128_digest(key) for key in keys)
    return np.frombuffer(digests, "<i8").reshape(-1, 2)


def references_of(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """One row for each document and key it holds; documents without an id hold none."""
    source = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(name, T.LongType()) for name in KEY]])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for row, text in enumerate(batch.column(1)):
                own = {key for _, key in line_keys(text.as_py(), least_chars) if key is not None}
                keys += own
                rows += [row] * len(own)
            made = halves(keys)
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(made[:, 0]), pa.array(made[:, 1])], ["doc_id", *KEY])

    return source.where(F.col("doc_id").isNotNull()).mapInArrow(extract, schema).distinct()


def counts_of(references: DataFrame) -> DataFrame:
    return references.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("top_doc"))


def shard_of(shards: int) -> Column:
    return F.pmod("k1", F.lit(shards)).cast("int")


def filters_of(keys: DataFrame, shards: int) -> DataFrame:
    """A new filter for each shard that has keys."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(group.k1.to_numpy(), group.k2.to_numpy())
        return pd.DataFrame({"shard": [int(group.shard.iloc[0])], "filter": [made.dump()]})

    keys = keys.select(shard_of(shards).alias("shard"), *KEY)
    return keys.groupBy("shard").applyInPandas(build, "shard int, filter binary")


def changed_filters(filters: DataFrame, changes: DataFrame, kept: DataFrame, shards: int) -> DataFrame:
    """The filters after keys have come (``change`` 1) and gone (-1); ``kept`` are all keys they then hold.

    A filter that has no room left, or is new, is built from its exact keys.
    """

    def change(old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        shard = int((rows if len(rows) else old).shard.iloc[0])
        if not len(old):
            return pd.DataFrame({"shard": [shard], "filter": [None]})
        made = CuckooFilter.load(old["filter"].iloc[0])
        gone, come = rows[rows.change < 0], rows[rows.change > 0]
        made.delete(gone.k1.to_numpy(), gone.k2.to_numpy())
        try:
            made.insert(come.k1.to_numpy(), come.k2.to_numpy())
        except Full:
            return pd.DataFrame({"shard": [shard], "filter": [None]})
        return pd.DataFrame({"shard": [shard], "filter": [made.dump()]})

    changes = changes.select(shard_of(shards).alias("shard"), *KEY, "change")
    changed = filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, "shard int, filter binary")
    changed = as_table(changed, "line-filters")
    full = changed.where(F.col("filter").isNull()).select("shard")
    again = kept.join(F.broadcast(full), shard_of(shards) == F.col("shard"), "left_semi")  # one row a shard
    return changed.where(F.col("filter").isNotNull()).unionByName(filters_of(again, shards))


def possibly_repeated(references: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The references whose key the filter of its shard holds.

    Shards are split by document, so that one key in very many documents is spread;
    each part begins with a copy of the filter and streams through.
    """
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    rows = references.select(shard_of(shards).alias("shard"), salt.alias("salt"), "doc_id", *KEY, F.lit(None).cast("binary").alias("filter"))
    nothing = [F.lit(None).cast(references.schema[name].dataType).alias(name) for name in ("doc_id", *KEY)]
    copies = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), *nothing, "filter")
    order = ["shard", "salt", F.col("filter").isNull()]
    both = rows.unionByName(copies).repartition(F.col("shard"), F.col("salt")).sortWithinPartitions(*order)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, part = None, None
        for batch in batches:
            shard, salt = (batch.column(name).to_numpy() for name in ("shard", "salt"))
            starts = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1])])
            for start, end in zip(starts, [*starts[1:], len(shard)]):
                piece = batch.slice(start, end - start)
                if (here := (shard[start], salt[start])) != part:
                    blob = piece.column("filter")[0].as_py()
                    current, part = CuckooFilter.load(blob) if blob else None, here
                    piece = piece.slice(1) if blob else piece
                if current is None or not len(piece):
                    continue
                k1, k2 = (piece.column(name).to_numpy() for name in KEY)
                found = piece.filter(pa.array(current.holds(k1, k2)))
                yield found.select(["doc_id", *KEY])

    return both.mapInArrow(probe, references.schema)


class LineIndex:
    """One version of the index. ``insert`` and ``delete`` return the next one."""

    def __init__(self, references: DataFrame, counts: DataFrame, filters: DataFrame, shards: int, **rules):
        self.references, self.counts, self.filters, self.shards = references, counts, filters, shards
        self.rules = {"id_col": "doc_id", "text_col": "text", "least_chars": LEAST_CHARS, "least_docs": LEAST_DOCS, **rules}

    @classmethod
    def of(cls, docs: DataFrame, **rules) -> LineIndex:
        """An index of the given documents; rules are the names and bounds of ``dedup``."""
        self = cls(None, None, None, SHARDS, **rules)
        self.references = as_table(self.lines(docs), "line-references")
        self.shards = max(SHARDS, -(-self.references.count() // REFERENCES_PER_SHARD))
        self.counts = as_table(counts_of(self.references), "line-counts")
        self.filters = as_table(filters_of(self.repeated(), self.shards), "line-filters")
        return self

    def lines(self, docs: DataFrame) -> DataFrame:
        return references_of(docs, self.rules["id_col"], self.rules["text_col"], self.rules["least_chars"])

    def repeated(self) -> DataFrame:
        return self.counts.where(F.col("n_docs") >= self.rules["least_docs"])

    def next(self, references: DataFrame, touched: DataFrame) -> LineIndex:
        """The version with other references, of which only the touched keys need counting again."""
        touched = touched.select(*KEY).distinct()
        references = as_table(references, "line-references")
        recounted = counts_of(references.join(touched, KEY, "left_semi"))
        counts = as_table(self.counts.join(touched, KEY, "left_anti").unionByName(recounted), "line-counts")
        after = LineIndex(references, counts, self.filters, self.shards, **self.rules)
        before, now = self.repeated().select(*KEY), after.repeated().select(*KEY)
        before, now = before.join(touched, KEY, "left_semi"), now.join(touched, KEY, "left_semi")
        come = now.join(before, KEY, "left_anti").withColumn("change", F.lit(1))
        gone = before.join(now, KEY, "left_anti").withColumn("change", F.lit(-1))
        filters = changed_filters(self.filters, come.unionByName(gone), after.repeated(), self.shards)
        after.filters = as_table(filters, "line-filters")
        return after

    def insert(self, docs: DataFrame) -> LineIndex:
        """Documents inserted twice count once."""
        new = as_table(self.lines(docs).join(self.references, ["doc_id", *KEY], "left_anti"), "line-references")
        return self.next(self.references.unionByName(new), new)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Forget documents by their ids; unknown ids are ignored."""
        ids = docs.select(F.col(quoted(self.rules["id_col"])).alias("doc_id")).distinct()
        gone = as_table(self.references.join(ids, "doc_id", "left_semi"), "line-references")
        return self.next(self.references.join(ids, "doc_id", "left_anti"), gone)

    def dropped(self) -> DataFrame:
        """The keys each document loses: held by enough documents, of which it is not the largest.

        Filters spare lines that are not repeated the exact lookup; a few false hits end there.
        """
        hits = possibly_repeated(self.references, self.filters, self.shards)
        held = hits.join(self.repeated(), KEY).where(F.col("doc_id") != F.col("top_doc"))
        return held.groupBy("doc_id").agg(F.collect_list(F.struct(*KEY)).alias("keys"))

    def dedup(self, docs: DataFrame) -> DataFrame:
        """Documents of the index without the lines they lose; see the module's ``dedup``."""
        id_col, text_col, least = self.rules["id_col"], self.rules["text_col"], self.rules["least_chars"]
        drop_id, drop_keys = held = unused(docs, "drop_id", "drop_keys")
        lost = self.dropped().select(F.col("doc_id").alias(drop_id), F.col("keys").alias(drop_keys))
        joined = docs.join(lost, F.col(quoted(id_col)) == F.col(drop_id), "left")

        @F.arrow_udf("text string, n_lines bigint, n_dropped bigint")
        def rewritten(texts: pa.Array, drops: pa.Array) -> pa.Array:
            kept, lines, dropped = [], [], []
            for text, drop in zip(texts, drops):
                text = text.as_py() or ""
                lines.append(text.count("\n") + 1)
                if drop.as_py() is not None:
                    own = line_keys(text, least)
                    gone = {(key["k1"], key["k2"]) for key in drop.as_py()}
                    made = iter(halves([key for _, key in own if key is not None]).tolist())
                    stay = [line for line, key in own if key is None or tuple(next(made)) not in gone]
                    text = b"\n".join(stay).decode()
                    dropped.append(len(own) - len(stay))
                else:
                    dropped.append(0)
                kept.append(text)
            return pa.StructArray.from_arrays(
                [pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                ["text", "n_lines", "n_dropped"],
            )

        names = {"text": text_col, "n_lines": "n_lines", "n_dropped": "n_dropped"}
        done = with_struct(joined, rewritten(F.col(quoted(text_col)).cast("string"), F.col(drop_keys)), names)
        return done.drop(*held)


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """Drop repeated lines, and add ``n_lines`` (before) and ``n_dropped``.

    A line whose key has ``least_chars`` code points and is held by ``least_docs``
    documents stays only in the document with the largest id, there as often as it
    stands. The other lines stay in order; a text that loses all is empty. Null counts
    as the empty text, which is one empty line. Rows with the same id are one document.
    Rows without an id keep all their lines, which count for no other. Same-named
    columns of the input are replaced. An empty table gives an empty result.
    """
    rules = {"id_col": id_col, "text_col": text_col, "least_chars": least_chars, "least_docs": least_docs}
    return LineIndex.of(docs, **rules).dedup(docs)


def open_index(spark: SparkSession, folder: str) -> LineIndex:
    """Read back an index that ``save`` wrote."""
    rules = spark.read.json(f"{folder}/rules").first().asDict()
    tables = [spark.read.parquet(f"{folder}/{name}") for name in ("references", "counts", "filters")]
    return LineIndex(*tables, rules.pop("shards"), **rules)


def save(index: LineIndex, folder: str) -> None:
    """Write a version of the index to a folder of its own."""
    for name in ("references", "counts", "filters"):
        getattr(index, name).write.parquet(f"{folder}/{name}")
    spark = index.references.sparkSession
    rules = {**index.rules, "shards": index.shards}
    schema = ", ".join(f"{name} {'string' if isinstance(value, str) else 'bigint'}" for name, value in rules.items())
    spark.createDataFrame([tuple(rules.values())], schema).write.json(f"{folder}/rules")
