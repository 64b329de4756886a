"""Near-duplicate documents by MinHash with sequential Bayesian verification.

Documents with equal shingle sets are one class. Class representatives that agree in
a band of their signatures are candidates. Signatures are compared in batches; after
each, a pair is dropped if the posterior probability that it is similar enough has
fallen below the chosen miss probability. Survivors are confirmed on their full sets.

A band's candidates are not written out as pairs. First each block of a band gives a
spanning forest of its likeliest links, whose links are confirmed and joined to
components. After that, only documents that lie in different components are left to
compare: a document asks about another component, whose full sets it meets in blocks.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch.llm.caches import BoundedCache
from tickwatch.llm.components import components
from tickwatch.llm.frames import quoted
from tickwatch.settings import as_table

# A pair at similarity 0.8 shares none of 24 bands of 4 with a probability of 3 in a million.
HASHES, BANDS, ROWS = 128, 24, 4
BATCH = 32
MISS = 1e-6
# Members of a band that are compared in one task at a time.
BLOCK = 512
PAIRS_AT_ONCE = 1 << 16
SHINGLES_AT_ONCE = 1 << 11
# Bits that mark the ids of documents to look up, a megabyte of them. Ids that share a bit are
# looked up in vain, so the map saves less work the more ids are asked for; no link depends on it.
BITS = 1 << 23


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def word_hashes() -> BoundedCache:
    return BoundedCache(xxhash.xxh3_64_intdigest, 200_000)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; shorter texts are one shingle, empty ones none."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(word_hashes().__getitem__, found), np.uint64, len(found))
    width = min(words, len(hashed))
    count = len(hashed) - width + 1
    shingles = np.full(count, width, np.uint64)
    for at in range(width):
        shingles = mix(shingles * np.uint64(0x9E3779B97F4A7C15) + hashed[at : at + count])
    return np.unique(shingles)


@functools.lru_cache(maxsize=1)
def multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    factors = rng.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
    return factors[:, None], rng.integers(0, 1 << 63, HASHES, np.uint64)[:, None]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits of the smallest value that each of the hash functions takes."""
    factors, terms = multipliers()
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), SHINGLES_AT_ONCE):
        part = shingles[None, at : at + SHINGLES_AT_ONCE]
        np.minimum(least, (part * factors + terms).min(1), out=least)
    return least.astype(np.uint16)


def least_matches(similarity: float, miss: float) -> list[tuple[int, int]]:
    """For each number of hashes compared, how many must match for a pair to go on.

    With a uniform prior, the posterior probability of at least the similarity after m
    of n matches is that of at most m successes in n + 1 trials.
    """
    bounds = []
    for n in range(BATCH, HASHES + 1, BATCH):
        posterior, m = 0.0, -1
        while posterior < miss:
            m += 1
            posterior += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        bounds.append((n, m))
    return bounds


def surviving(signatures: np.ndarray, left: np.ndarray, right: np.ndarray, bounds) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that no batch has ruled out, and in how many hashes they match."""
    places, matches = [], []
    for at in range(0, len(left), PAIRS_AT_ONCE):
        one, other = left[at : at + PAIRS_AT_ONCE], right[at : at + PAIRS_AT_ONCE]
        alive, count = np.arange(len(one)), np.zeros(len(one), np.int32)
        for end, least in bounds:
            cut = slice(end - BATCH, end)
            count = count + (signatures[one[alive], cut] == signatures[other[alive], cut]).sum(1, dtype=np.int32)
            stay = count >= least
            alive, count = alive[stay], count[stay]
            if not len(alive):
                break
        places.append(alive + at)
        matches.append(count)
    return np.concatenate(places or [[]]).astype(int), np.concatenate(matches or [[]]).astype(int)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """``id``, size and digest of the shingle set, and the signature, of every document."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema["id"].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("k1", T.LongType()),
            T.StructField("k2", T.LongType()),
            T.StructField("signature", T.BinaryType()),
        ]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), words)
                sizes.append(len(shingles))
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
            columns.append(pa.array(signatures, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.mapInArrow(sketch, schema)


def buckets_of(signatures: np.ndarray) -> np.ndarray:
    """The bucket of each band: a hash of its values and its number."""
    bands = np.ascontiguousarray(signatures[:, : BANDS * ROWS]).view(np.uint64).reshape(-1, BANDS)
    numbers = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(mix(bands + numbers) + numbers).view(np.int64)


def banded(classes: DataFrame) -> DataFrame:
    """One row for each class and band: ``bucket``, a hash of the band and its values, and ``id``."""
    schema = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("id", classes.schema["id"].dataType)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, HASHES)
            buckets = buckets_of(values)
            ids = batch.column("id").take(pa.array(np.repeat(np.arange(len(values)), BANDS)))
            yield pa.RecordBatch.from_arrays([pa.array(buckets.ravel()), ids], names=schema.fieldNames())

    return classes.select("id", "signature").mapInArrow(cut, schema)


def by_group(
    rows: DataFrame, keys: list[str], work: Callable[[pa.Table], list[pa.Table]], schema: T.StructType
) -> DataFrame:
    """Send rows of equal keys to one task and give ``work`` one table of whole groups after another.

    Groups stream through in order; a table holds one large group or many small ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(key).to_numpy() for key in keys]
            changes = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
            new = bool(held) and any(c[0] != held[-1].column(k)[-1].as_py() for c, k in zip(columns, keys))
            if new or len(changes):
                end = int(changes[-1]) if len(changes) else 0
                whole = [*held, batch.slice(0, end)]
                for made in work(pa.Table.from_batches(whole)):
                    yield from made.to_batches()
                held = [batch.slice(end)]
            else:
                held.append(batch)
        if held:
            for made in work(pa.Table.from_batches(held)):
                yield from made.to_batches()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def groups_of(table: pa.Table, keys: list[str]) -> Iterator[tuple[int, int]]:
    columns = [table.column(key).to_numpy() for key in keys]
    changes = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
    bounds = [0, *changes.tolist(), table.num_rows]
    return zip(bounds[:-1], bounds[1:])


def signatures_of(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, HASHES)


def spanning_forest(weights: np.ndarray) -> list[tuple[int, int]]:
    """Links of a heaviest spanning forest of a symmetric matrix, where 0 is no link."""
    size = len(weights)
    outside, best, parent = np.ones(size, bool), np.zeros(size, weights.dtype), np.zeros(size, int)
    links = []
    for _ in range(size):
        node = int(np.where(outside, best, -1).argmax())
        if best[node] > 0:
            links.append((int(parent[node]), node))
        outside[node] = False
        closer = outside & (weights[node] > best)
        best[closer], parent[closer] = weights[node][closer], node
    return links


def forests(members: DataFrame, bounds, id_type: T.DataType) -> DataFrame:
    """Likeliest links in each block of each bucket (``matches`` > 0), and one centre of each tree (``matches`` 0)."""
    schema = T.StructType(
        [
            T.StructField("bucket", T.LongType()),
            T.StructField("a", id_type),
            T.StructField("b", id_type),
            T.StructField("matches", T.IntegerType()),
        ]
    )

    def work(table: pa.Table) -> list[pa.Table]:
        signatures = signatures_of(table)
        spans = list(groups_of(table, ["bucket", "block"]))
        # All pairs of a block of bounded size; of small blocks many at once.
        corners = [np.triu_indices(end - start, 1) for start, end in spans]
        left = np.concatenate([c[0] + start for c, (start, _) in zip(corners, spans)])
        right = np.concatenate([c[1] + start for c, (start, _) in zip(corners, spans)])
        places, matches = surviving(signatures, left, right, bounds)
        left, right = left[places], right[places]
        starts = np.array([start for start, _ in spans])
        owner = np.searchsorted(starts, left, "right") - 1
        a, b, weight = [], [], []
        for span in np.unique(owner):
            start, end = spans[span]
            mine = slice(*np.searchsorted(owner, [span, span + 1]))
            weights = np.zeros((end - start,) * 2, np.int32)
            one, other = left[mine] - start, right[mine] - start
            weights[one, other] = weights[other, one] = matches[mine]
            links = spanning_forest(weights)
            a += [start + x for x, _ in links]
            b += [start + y for _, y in links]
            weight += [int(weights[x, y]) for x, y in links]
            tree = np.arange(end - start)
            for x, y in links:
                tree[y] = tree[x]
            for root in np.unique(tree[[x for x, _ in links]]):
                nodes = np.flatnonzero(tree == root)
                centre = start + int(nodes[weights[nodes].sum(1).argmax()])
                a.append(centre)
                b.append(centre)
                weight.append(0)
        ids, buckets = table.column("id"), table.column("bucket")
        rows = [pa.array(a, pa.int64()), pa.array(b, pa.int64())]
        columns = [buckets.take(rows[0]), ids.take(rows[0]), ids.take(rows[1]), pa.array(weight, pa.int32())]
        return [pa.Table.from_arrays(columns, names=schema.fieldNames())]

    return by_group(members, ["bucket", "block"], work, schema)


def block_of(count: Column) -> Column:
    blocks = F.ceil(count / BLOCK).cast("bigint")
    return F.pmod(F.xxhash64("id"), blocks).cast("int")


def likely_links(members: DataFrame, bounds, id_type: T.DataType) -> DataFrame:
    """Links of the spanning forests of all blocks, and of the forests over their centres where a bucket has several blocks."""
    found, level = [], members
    while True:
        made = as_table(forests(level.withColumn("block", block_of(F.col("members"))), bounds, id_type), "forests")
        found.append(made.where("matches > 0").select("a", "b", "matches"))
        split = level.where(F.col("members") > BLOCK).select("bucket", "id", "signature")
        if split.isEmpty():
            break
        centres = made.where("matches = 0").select("bucket", F.col("a").alias("id")).distinct()
        counts = centres.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        level = as_table(split.join(centres, ["bucket", "id"]).join(counts, "bucket"), "centres")
    return functools.reduce(DataFrame.unionByName, found)


def open_questions(
    members: DataFrame, labels: DataFrame, bounds, id_type: T.DataType, likeliest: bool
) -> DataFrame:
    """(``id``, ``component``): members of a bucket, and other components in it with a member that signatures do not rule out.

    With ``likeliest`` a member only asks about the component of its best match in a
    block, which joins most of those that belong together before all others are asked.

    The most frequent component of a bucket stays in its blocks; a copy of every other
    member goes to each block. So equal components are never compared, and a bucket is
    spread over tasks however many members it has.
    """
    named = members.join(labels, members["id"] == labels["node"], "left")
    named = named.select("bucket", "id", "signature", "members", F.coalesce("component", "id").alias("component"))
    shares = named.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("share"))
    main = shares.groupBy("bucket").agg(
        F.max(F.struct("share", "component"))["component"].alias("main"), F.count(F.lit(1)).alias("parts")
    )
    mixed = named.join(main.where("parts > 1").select("bucket", "main"), "bucket")
    mixed = mixed.withColumn("stray", F.col("component") != F.col("main")).drop("main")
    held = mixed.withColumn("block", block_of(F.col("members"))).withColumn("copy", F.lit(False))
    blocks = F.sequence(F.lit(0), (F.ceil(F.col("members") / BLOCK) - 1).cast("int"))
    copies = mixed.where("stray").withColumn("block", F.explode(blocks)).withColumn("copy", F.lit(True))
    schema = T.StructType([T.StructField("id", id_type), T.StructField("component", id_type)])

    def work(table: pa.Table) -> list[pa.Table]:
        signatures = signatures_of(table)
        ids, parts = table.column("id").to_numpy(), table.column("component").to_numpy()
        copy, stray = table.column("copy").to_numpy(), table.column("stray").to_numpy()
        buckets, bands = table.column("bucket").to_numpy(), buckets_of(signatures)
        asked: set[tuple[int, int]] = set()
        lefts, rights, waiting = [], [], 0

        def flush() -> None:
            nonlocal lefts, rights, waiting
            left, right = np.concatenate(lefts), np.concatenate(rights)
            # A pair that shares several buckets is looked at in that of its first band alone.
            first = (bands[left] == bands[right]).argmax(1)
            mine = bands[left, first] == buckets[left]
            left, right = left[mine], right[mine]
            places, matches = surviving(signatures, left, right, bounds)
            left, right = left[places], right[places]
            if likeliest:
                order = np.lexsort((-matches, left))
                left, right = left[order], right[order]
                first = np.r_[True, left[1:] != left[:-1]][: len(left)]
                left, right = left[first], right[first]
            asked.update(zip(ids[left].tolist(), parts[right].tolist()))
            lefts, rights, waiting = [], [], 0

        for start, end in groups_of(table, ["bucket", "block"]):
            span = np.arange(start, end)
            inside = span[~copy[span]]
            for one in span[copy[span]]:
                # Of two strays, each of which meets the other's copy, the larger id asks.
                other = inside[(parts[inside] != parts[one]) & (~stray[inside] | (ids[inside] < ids[one]))]
                lefts.append(np.full(len(other), one))
                rights.append(other)
                waiting += len(other)
                if waiting >= PAIRS_AT_ONCE:
                    flush()
        if lefts:
            flush()
        types = [table.schema.field("id").type] * 2
        columns = [pa.array([row[k] for row in asked], types[k]) for k in range(2)]
        return [pa.Table.from_arrays(columns, names=schema.fieldNames())]

    columns = ["bucket", "block", "id", "signature", "component", "copy", "stray"]
    rows = held.select(columns).unionByName(copies.select(columns))
    return by_group(rows, ["bucket", "block"], work, schema).distinct()


def answered(
    questions: DataFrame, labels: DataFrame, docs: DataFrame, words: int, percent: int, id_type: T.DataType
) -> DataFrame:
    """Links of asking members to the components they ask about, on full sets, one for each block of a component.

    A component meets a question in blocks of bounded size; the pairs between them are
    never written out.
    """
    questions = as_table(questions, "questions")
    about = questions.select("component").distinct()
    nodes = labels.join(about, "component", "left_semi").select("component", F.col("node").alias("id"))
    nodes = as_table(nodes.unionByName(about.select("component", F.col("component").alias("id"))), "asked-nodes")
    sizes = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    held = nodes.join(sizes, "component").withColumn("block", block_of(F.col("members")))
    held = held.select("component", "block", "id", F.lit(False).alias("asks"))
    blocks = F.sequence(F.lit(0), (F.ceil(F.col("members") / BLOCK) - 1).cast("int"))
    asking = questions.join(sizes, "component").select("component", F.explode(blocks).alias("block"), "id", F.lit(True).alias("asks"))
    sets = shingle_sets(docs, nodes.select("id").unionByName(questions.select("id")), words)
    rows = held.unionByName(asking).join(sets, "id")
    schema = T.StructType([T.StructField("a", id_type), T.StructField("b", id_type)])

    def work(table: pa.Table) -> list[pa.Table]:
        ids, asks = table.column("id"), table.column("asks").to_numpy()
        a, b = [], []
        for start, end in groups_of(table, ["component", "block"]):
            mine = np.arange(start, end)
            inside = mine[~asks[mine]]
            if not len(inside):
                continue
            found = [np.frombuffer(table.column("shingles")[int(at)].as_py(), np.uint64) for at in inside]
            sizes = np.array([len(one) for one in found])
            starts, whole = np.r_[0, np.cumsum(sizes)[:-1]], np.concatenate(found)
            for at in mine[asks[mine]].tolist():
                own = np.frombuffer(table.column("shingles")[at].as_py(), np.uint64)
                place = np.minimum(np.searchsorted(own, whole), len(own) - 1)
                common = np.add.reduceat((own[place] == whole).astype(np.int64), starts)
                similar = 100 * common >= percent * (sizes + len(own) - common)
                if similar.any():
                    a.append(at)
                    b.append(int(inside[similar.argmax()]))
        return [pa.Table.from_arrays([ids.take(pa.array(one, pa.int64())) for one in (a, b)], names=["a", "b"])]

    return by_group(rows, ["component", "block"], work, schema)


def shingle_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id`` and packed shingles of the documents with the given ids.

    A bitmap of fixed size holds the hashes of the ids; sets are only made of documents
    that it may mean, so that sets are shuffled to the ids and texts stay where they are.
    """
    id_type = docs.schema["id"].dataType
    place = F.pmod(F.xxhash64("id"), F.lit(BITS)) + 1
    wanted = ids.distinct()
    marks = wanted.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    # At most BITS / 8 bytes, however many ids there are.
    bitmap = np.zeros(BITS, bool)
    for row in marks.collect():
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        start = (row["bucket"] - 1) * len(bits)
        bitmap[start : start + len(bits)] = bits
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap))
    schema = T.StructType([T.StructField("id", id_type), T.StructField("shingles", T.BinaryType())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(shared.value)
        for batch in batches:
            meant = np.flatnonzero(known[batch.column(1).to_numpy()])
            for part in np.array_split(meant, len(meant) // 512 + 1):
                rows = pa.array(part, pa.int64())
                sets = [shingle_set(text.as_py(), words).tobytes() for text in batch.column(2).take(rows)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array(sets, pa.binary())], names=["id", "shingles"]
                )

    texts = docs.where(F.col("id").isNotNull()).select("id", (place - 1).alias("place"), "text")
    made = texts.mapInArrow(make, schema).where(F.octet_length("shingles") > 0)
    # Rows that repeat a document give its set once.
    return as_table(made.join(wanted, "id", "left_semi").dropDuplicates(["id", "shingles"]), "shingles")


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough: 100 times the intersection reaches ``percent`` times the union."""
    pairs = as_table(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    sets = shingle_sets(docs, pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))), words)

    @F.arrow_udf("boolean")
    def similar(one: pa.Array, other: pa.Array) -> pa.Array:
        found = []
        for x, y in zip(one, other):
            x, y = (np.frombuffer(z.as_py(), np.uint64) for z in (x, y))
            common = len(np.intersect1d(x, y, assume_unique=True))
            found.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.array(found, pa.bool_())

    first = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("one")), "a")
    both = first.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("other")), "b")
    return both.where(similar("one", "other")).select("a", "b")


def near_duplicates(
    df: DataFrame,
    words: int = 5,
    percent: int = 80,
    miss: float = MISS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The id, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Words are runs without white space, lower-cased in ASCII. Documents are linked if
    their sets of distinct ``words``-word shingles have a Jaccard similarity of
    ``percent`` or more; a component's id is its smallest document id, and that
    document is kept. A text of fewer words is one shingle; a null text or one without
    words has none, is linked with nothing, and kept. Rows without an id are kept and
    have no component. Repeated rows are one document; rows that share an id but not
    the text are judged each by its own. Whole texts are compared, all links between
    components of different texts are looked for, and none is kept below ``percent``.
    An empty table gives an empty result. Ids are integers.
    """
    docs = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))
    id_type = docs.schema["id"].dataType
    bounds = least_matches(percent / 100, miss)
    sketch = as_table(sketches(docs, words), "sketches")
    judged = sketch.where(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    firsts = judged.groupBy("k1", "k2").agg(F.min("id").alias("id"))
    classes = as_table(judged.join(firsts, ["k1", "k2", "id"], "left_semi").select("id", "signature").distinct(), "classes")

    buckets = as_table(banded(classes), "buckets")
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = as_table(buckets.join(shared, "bucket").join(classes, "id"), "members")

    likely = confirmed(likely_links(members, bounds, id_type), docs, words, percent)
    likely = as_table(likely, "links")
    labels = components(likely)
    links = likely
    for likeliest in (True, False):
        questions = open_questions(members, labels, bounds, id_type, likeliest)
        found = as_table(answered(questions, labels, docs, words, percent, id_type), "links")
        links = links.unionByName(found)
        labels = components(links)

    named = firsts.join(labels, firsts["id"] == labels["node"], "left")
    named = named.select("k1", "k2", F.coalesce("component", "id").alias("component"))
    found = sketch.join(named, ["k1", "k2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return found.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
