"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

Rotations are learned on a bounded sample. The signs of the rotated vectors are the
codes, and each code is cut into substrings with an index of their own. A code within
a Hamming radius has a substring within the radius divided by their number, so that
probing all values that near retrieves every such code. Those are ranked by their
floats.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch.llm.frames import quoted
from tickwatch.settings import as_table

SAMPLE = 20_000
BITS = 256
# Bits of a substring: its index has one list for each value.
WIDTH = 8
# Share of a sample's true neighbours that the radius must reach.
REACH = 0.98
# Vectors and queries that meet in one task.
CODES_IN_BLOCK = 8192
QUERIES_IN_BLOCK = 4096
QUERIES_AT_ONCE = 128
# Vectors of the sample whose neighbours set the radius.
ASKED = 400
# Probing is left out where it would rule out less than this share of the codes.
LEAST_RULED_OUT = 0.5
ROUNDS = 30

WEIGHTS = np.array([bin(value).count("1") for value in range(1 << WIDTH)], np.uint8)


@dataclass(frozen=True)
class Model:
    """What turns vectors into codes, and how far from a query's code to look."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One byte for each substring."""
        return np.packbits((vectors - self.mean) @ self.rotation > 0, axis=1)


def learned_rotation(centred: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Principal axes, rotated so that signs lose as little as they can (iterative quantisation)."""
    axes = np.linalg.svd(centred, full_matrices=False)[2].T
    projected = centred @ axes
    turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(projected @ turn > 0, 1.0, -1.0).T @ projected)
        turn = (left @ right).T
    return axes @ turn


def words(codes: np.ndarray) -> np.ndarray:
    """Codes as whole 64-bit words, padded with zeros."""
    padded = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), np.uint8)
    padded[:, : codes.shape[1]] = codes
    return padded.view(np.uint64)


def distances(codes: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Differing bits of each asked code (rows) and each held code (columns), both as words."""
    away = np.zeros((len(asked), len(codes)), np.uint16)
    for part in range(codes.shape[1]):
        away += np.bitwise_count(asked[:, part, None] ^ codes[None, :, part])
    return away


def learn(
    sample: np.ndarray, k: int, bits: int = BITS, reach: float = REACH, seed: int = 7, asked: int = ASKED
) -> Model:
    """Fit rotations on a sample, and the radius that reaches the given share of its own neighbours of ``asked`` of it.

    Neighbours in all rows are nearer than in a sample, so the radius errs to the safe side.
    """
    rng = np.random.default_rng(seed)
    mean = sample.mean(0)
    turns, count = [], 0
    while count < bits:
        turns.append(learned_rotation(sample - mean, rng))
        count += turns[-1].shape[1]
    model = Model(mean, np.hstack(turns)[:, :bits], bits)
    codes = words(model.codes(sample))
    far = []
    for at in range(min(len(sample), asked)):
        scores = sample @ sample[at]
        scores[at] = -np.inf
        nearest = np.argpartition(-scores, min(k, len(scores) - 1))[:k]
        far.append(distances(codes[nearest[nearest != at]], codes[at : at + 1])[0])
    radius = int(np.quantile(np.concatenate(far), reach)) if len(sample) > 1 else bits
    return Model(mean, model.rotation, radius)


class MultiIndex:
    """The codes of one block, listed by the value of each substring."""

    def __init__(self, codes: np.ndarray):
        self.words = words(codes)
        self.parts = codes.shape[1]
        self.lists = np.argsort(codes, axis=0, kind="stable").astype(np.int32)
        ordered = np.take_along_axis(codes, self.lists, 0)
        values = np.arange((1 << WIDTH) + 1)
        self.starts = [np.searchsorted(ordered[:, part], values) for part in range(self.parts)]

    def probed(self, code: np.ndarray, radius: int) -> np.ndarray | None:
        """Places with a substring so near that their code may lie within the radius; None if probing rules out little.

        A code within the radius has a substring within the radius divided by their number.
        """
        near = WEIGHTS[np.arange(1 << WIDTH)] <= radius // self.parts
        if (1 - near.mean()) ** self.parts < LEAST_RULED_OUT:
            return None
        found = np.zeros(len(self.words), bool)
        probes = np.flatnonzero(near)
        for part, value in enumerate(code):
            starts = self.starts[part]
            for probe in probes ^ value:
                found[self.lists[starts[probe] : starts[probe + 1], part]] = True
        return np.flatnonzero(found)

    def within(self, asked: np.ndarray, radius: int, least: int) -> np.ndarray:
        """Whether each code (columns) lies within the radius of each asked one; within a wider one where fewer than ``least`` do.

        Whole codes are compared at once, of the probed places only where probing rules out enough.
        """
        wanted, least = words(asked), min(least, len(self.words))
        if self.probed(asked[0], radius) is None:
            away = distances(self.words, wanted)
        else:
            away = np.full((len(asked), len(self.words)), np.iinfo(np.uint16).max, np.uint16)
            for row, code in enumerate(asked):
                places = self.probed(code, radius)
                away[row, places] = distances(self.words[places], wanted[row : row + 1])[0]
        inside = away <= radius
        for row in np.flatnonzero(inside.sum(axis=1) < least):
            whole = distances(self.words, wanted[row : row + 1])[0]
            inside[row] = whole <= np.partition(whole, least - 1)[least - 1]
        return inside


def best_of(
    vectors: np.ndarray, names: np.ndarray, wanted: np.ndarray, inside: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Names and scores of the ``k`` best vectors among those inside for each wanted one, ties to the smaller name.

    Scores of a product of matrices choose a few more than ``k``, by more than their
    rounding; the scores given are sums of products, one vector at a time.
    """
    rough = np.where(inside, wanted @ vectors.T, -np.inf)
    room = 1e-9 * (np.linalg.norm(wanted, axis=1) * np.linalg.norm(vectors, axis=1).max())
    least = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(wanted), -np.inf)
    found = []
    for row, query in enumerate(wanted):
        places = np.flatnonzero(inside[row] & (rough[row] >= least[row] - room[row]))
        scores = (vectors[places] * query).sum(1)
        best = np.lexsort((names[places], -scores))[:k]
        found.append((names[places][best], scores[best]))
    return found


def usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & whole & F.exists(vector, lambda x: x != 0)


def search(
    df: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample: int = SAMPLE,
    bits: int = BITS,
) -> DataFrame:
    """The ``k`` nearest rows found for each row that ``queries`` selects, by inner product in double precision.

    Returns query_id, rank (from 1), the neighbour under the name of the id column, and score; ties go
    to the smaller id. A query's own id is no neighbour. Vectors that are null, zero, hold
    null or non-finite components, have no id, or have another length than most, take no
    part. A row that is repeated counts once. Fewer candidates than ``k`` are all returned;
    an empty table gives none. The model is fitted on at most ``sample`` vectors, chosen
    by a hash of their ids, and its radius on the neighbours that ``ASKED`` of them have
    among these; every row is indexed. Other columns are not looked at.
    """
    vector = F.col(quoted(vector_col)).cast("array<double>")
    # Zeros lose their sign, so that equal vectors are equal bits.
    plain = F.transform(vector, lambda x: x + F.lit(0.0))
    source = df.select(F.col(quoted(id_col)).alias("id"), plain.alias("vector"), queries.alias("asks"))
    clean = source.where(F.col("id").isNotNull() & usable(F.col("vector")))
    lengths = clean.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    kind = source.schema["id"].dataType.simpleString()
    empty = f"query_id {kind}, rank int, {quoted(id_col)} {kind}, score double"
    if not lengths:
        return df.sparkSession.createDataFrame([], empty)
    clean = clean.where(F.size("vector") == lengths[0]["n"])

    # Equal vectors are one class: all score alike, so that k + 1 smallest ids are enough of them.
    of_class = Window.partitionBy("vector").orderBy("id")
    firsts = clean.select("id", "vector").distinct().withColumn("at", F.row_number().over(of_class)).where(F.col("at") <= k + 1)
    classes = firsts.groupBy("vector").agg(F.min("id").alias("class"), F.sort_array(F.collect_list("id")).alias("ids"))
    classes = as_table(classes.withColumn("place", F.xxhash64("class")), "vector-classes")
    asking = clean.where(F.col("asks")).select("id", "vector").distinct()
    members = as_table(asking.join(classes.select("vector", "class"), "vector").select("id", "class"), "queries")

    rows = classes.orderBy("place").limit(sample).select("vector").toPandas()
    model = learn(np.array(rows["vector"].tolist(), float), k, bits)
    n_classes, n_asked = classes.count(), members.select("class").distinct().count()
    code_blocks, query_blocks = -(-n_classes // CODES_IN_BLOCK), max(1, -(-n_asked // QUERIES_IN_BLOCK))

    def spread(rows: DataFrame, blocks: int, mine: str, others: int, theirs: str) -> DataFrame:
        """Deal rows into blocks, with a copy of each block for each block of the other side."""
        own = F.pmod(F.xxhash64(F.lit(mine), "class"), F.lit(blocks)).cast("int").alias(mine)
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(theirs)
        # Named anew, as both sides come from one table.
        return rows.select(F.col("class").alias("class"), F.col("vector").alias("vector"), own, every)

    asked = members.select("class").distinct().join(classes.select("class", "vector"), "class")
    left = spread(asked, query_blocks, "query_block", code_blocks, "code_block")
    right = spread(classes, code_blocks, "code_block", query_blocks, "query_block")

    def meet(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        made = {"query_class": [], "class": [], "score": []}
        if len(asked) and len(held):
            vectors, wanted = np.array(held["vector"].tolist()), np.array(asked["vector"].tolist())
            index, codes = MultiIndex(model.codes(vectors)), model.codes(wanted)
            names = held["class"].to_numpy()
            for at in range(0, len(wanted), QUERIES_AT_ONCE):
                some = slice(at, at + QUERIES_AT_ONCE)
                inside = index.within(codes[some], model.radius, k + 1)
                best = best_of(vectors, names, wanted[some], inside, k + 1)
                for name, (theirs, scores) in zip(asked["class"].iloc[some], best):
                    made["query_class"] += [name] * len(theirs)
                    made["class"] += theirs.tolist()
                    made["score"] += scores.tolist()
        return pd.DataFrame(made)

    keys = ["query_block", "code_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        meet, f"query_class {kind}, class {kind}, score double"
    )
    # The best classes over all blocks, then their ids, best first; one spare for the query itself.
    best_first = Window.partitionBy("query_class").orderBy(F.desc("score"), "class")
    top = found.withColumn("at", F.row_number().over(best_first)).where(F.col("at") <= k + 1)
    ids = top.join(classes.select("class", "ids"), "class").select("query_class", "score", F.explode("ids").alias("id"))
    best_first = Window.partitionBy("query_class").orderBy(F.desc("score"), "id")
    ids = ids.withColumn("at", F.row_number().over(best_first)).where(F.col("at") <= k + 1)
    lists = ids.groupBy("query_class").agg(F.sort_array(F.collect_list(F.struct("at", "id", "score"))).alias("found"))
    answered = members.join(lists, members["class"] == lists["query_class"])
    others = F.slice(F.filter("found", lambda one: one["id"] != F.col("id")), 1, k)
    listed = answered.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "one"))
    return listed.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("one.id").alias(id_col),
        F.col("one.score").alias("score"),
    )
