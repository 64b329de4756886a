"""Centroid clustering of whole-number vectors by equal-average equal-variance search.

Centroids are sorted by the mean of their components. A vector starts at its own mean and
scans outward to both sides. For n components, means m and deviations s (the square root
of the summed squared differences from the mean)

    distance >= n * (m1 - m2)^2 + (s1 - s2)^2,

so a side ends where the first term alone passes the best distance so far, and a centroid
whose two terms together pass it is left out. What remains is compared in whole numbers.
Sums, means and distances are exact: as doubles that hold whole numbers below 2^53 for
components of ordinary size, as Python integers for the few vectors beyond it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.frames import quoted, unused
from tickwatch.settings import as_table

CLUSTERS, ROUNDS, SIZE, SCALE = 40, 5, 64, 256
# Vectors compared at once.
BLOCK = 4096
# Tasks that add up what the others counted, before the driver adds their sums.
ADDERS = 16
LONGEST = (1 << 63) - 1


def ordinary(size: int) -> int:
    """The largest component for which doubles hold squared distances of so many components without rounding."""
    return math.isqrt((1 << 53) // size) // 2


class Centroids:
    """Centroids of whole numbers, sorted by mean, with what the search needs of each."""

    def __init__(self, vectors: list[list[int]]):
        self.vectors = vectors
        totals = [sum(v) for v in vectors]
        order = sorted(range(len(vectors)), key=lambda number: (totals[number], number))
        self.numbers = np.array(order, dtype=np.int64)
        self.exact = [vectors[number] for number in order]
        self.exact_totals = [totals[number] for number in order]
        self.spreads = [spread(v, t) for v, t in zip(self.exact, self.exact_totals)]
        self.ordinary = all(abs(x) <= ordinary(len(v)) for v in vectors for x in v)
        if self.ordinary and vectors:
            self.matrix = np.array(self.exact, dtype=np.float64)
            self.totals = self.matrix.sum(axis=1)
            self.roots = np.sqrt(np.array(self.spreads, dtype=np.int64))

    def nearest(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row of ordinary vectors."""
        many, (rows, size) = len(self.numbers), block.shape
        totals = block.sum(axis=1)
        whole, squares = totals.astype(np.int64), np.einsum("ij,ij->i", block, block)
        roots = np.sqrt(size * squares.astype(np.int64) - whole * whole)
        right = np.searchsorted(self.totals, totals)
        left = right - 1
        best = np.full(rows, np.inf)
        number = np.full(rows, many, dtype=np.int64)
        active = np.arange(rows)
        while len(active):
            lo, hi, mine = left[active], right[active], totals[active]
            gap_lo = np.where(lo >= 0, mine - self.totals[np.maximum(lo, 0)], np.inf)
            gap_hi = np.where(hi < many, self.totals[np.minimum(hi, many - 1)] - mine, np.inf)
            go_left = gap_lo <= gap_hi
            gap = np.minimum(gap_lo, gap_hi)
            limit = size * best[active]
            # A little room for rounding: more is compared then, never less.
            near = gap * gap * (1 - 1e-9) <= limit
            near &= np.isfinite(gap)
            active, go_left, gap, limit = active[near], go_left[near], gap[near], limit[near]
            if not len(active):
                break
            at = np.where(go_left, left[active], right[active])
            left[active] -= go_left
            right[active] += ~go_left
            between = roots[active] - self.roots[at]
            asked = (gap * gap + between * between) * (1 - 1e-6) - 1e-6 <= limit
            rows_asked, at = active[asked], at[asked]
            away = block[rows_asked] - self.matrix[at]
            distance, which = np.einsum("ij,ij->i", away, away), self.numbers[at]
            better = (distance < best[rows_asked]) | ((distance == best[rows_asked]) & (which < number[rows_asked]))
            best[rows_asked[better]], number[rows_asked[better]] = distance[better], which[better]
        return number, best

    def nearest_exact(self, vector: list[int]) -> tuple[int, int]:
        """Number and squared distance of the nearest centroid, for components of any size."""
        size, total = len(vector), sum(vector)
        own = spread(vector, total)
        root = math.isqrt(own)
        best: tuple[int, int] | None = None
        for at in self.outward(total):
            gap = (self.exact_totals[at] - total) ** 2
            if best is not None:
                if gap > size * best[0]:
                    break
                # Whole roots lie less than one below the deviations.
                between = max(0, abs(math.isqrt(self.spreads[at]) - root) - 1)
                if gap + between * between > size * best[0]:
                    continue
            distance = sum((x - y) ** 2 for x, y in zip(vector, self.exact[at]))
            best = min(best or (distance, LONGEST), (distance, int(self.numbers[at])))
        return best[1], best[0]

    def outward(self, total: int) -> Iterator[int]:
        """Places of the centroids by the difference of their total."""
        right = sum(1 for other in self.exact_totals if other < total)
        left = right - 1
        while left >= 0 or right < len(self.exact_totals):
            if right == len(self.exact_totals) or (
                left >= 0 and total - self.exact_totals[left] <= self.exact_totals[right] - total
            ):
                yield left
                left -= 1
            else:
                yield right
                right += 1


def spread(vector: list[int], total: int) -> int:
    """The number of components times the summed squared differences from the mean."""
    return len(vector) * sum(x * x for x in vector) - total * total


def whole(value: float, scale: int) -> int:
    """floor(scale * value), the product as a double; where that has no room, exactly."""
    scaled = scale * value
    return math.floor(scaled) if math.isfinite(scaled) else scale * int(value)


def whole_vectors(embedding: pa.Array, size: int, scale: int) -> tuple[np.ndarray, dict[int, list[int]]]:
    """Vectors as whole numbers: a matrix of doubles, and by row the vectors that are too large for it.

    Their rows of the matrix are zero.
    """
    values = embedding.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)
    with np.errstate(over="ignore"):
        block = np.floor(values * scale)
    large = {
        int(row): [whole(value, scale) for value in values[row].tolist()]
        for row in np.flatnonzero((np.abs(block) > ordinary(size)).any(axis=1))
    }
    block[list(large)] = 0
    return block, large


def assigned(
    centroids: Centroids, embedding: pa.Array, size: int, scale: int
) -> Iterator[tuple[slice, list[int], list[int], np.ndarray, dict[int, list[int]]]]:
    """For blocks of rows: which rows, clusters, distances, the vectors, and the large ones by row of the block."""
    for start in range(0, len(embedding), BLOCK):
        part = embedding.slice(start, BLOCK)
        block, large = whole_vectors(part, size, scale)
        if centroids.ordinary:
            number, best = centroids.nearest(block)
            clusters, distances = number.tolist(), [int(d) for d in best.tolist()]
            exact = large
        else:
            clusters, distances = [0] * len(part), [0] * len(part)
            exact = {row: large.get(row) or [int(x) for x in block[row].tolist()] for row in range(len(part))}
        for row, vector in exact.items():
            clusters[row], distances[row] = centroids.nearest_exact(vector)
        yield slice(start, start + len(part)), clusters, distances, block, large


SUMS = "cluster int, n bigint, sums array<string>"


def sums_batch(sums: dict[int, list]) -> pa.RecordBatch:
    """Count and exact sums of each cluster; digits, since sums know no bound."""
    arrays = [
        pa.array(list(sums), pa.int32()),
        pa.array([n for n, _ in sums.values()], pa.int64()),
        pa.array([[str(x) for x in total] for _, total in sums.values()], pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["cluster", "n", "sums"])


def add(sums: dict[int, list], cluster: int, n: int, total: list[int]) -> None:
    held = sums.setdefault(cluster, [0, [0] * len(total)])
    held[0] += n
    held[1] = [x + y for x, y in zip(held[1], total)]


def cluster_sums(kept: DataFrame, centroids: Centroids, size: int, scale: int) -> dict[int, list]:
    """Count and componentwise sum of the vectors of each cluster.

    Each task adds up its own vectors, a few tasks add up theirs, and the driver adds those
    few sums; a hot cluster is one row from each task, as any other.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for _, clusters, _, block, large in assigned(centroids, batch.column(0), size, scale):
                clusters = np.array(clusters)
                ordinary = np.ones(len(clusters), bool)
                ordinary[list(large)] = False
                for cluster in np.unique(clusters).tolist():
                    mine = block[ordinary & (clusters == cluster)]
                    add(sums, cluster, len(mine), [int(x) for x in mine.sum(axis=0).tolist()])
                for row, vector in large.items():
                    add(sums, int(clusters[row]), 1, vector)
        yield sums_batch(sums)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                add(sums, row["cluster"], row["n"], list(map(int, row["sums"])))
        yield sums_batch(sums)

    sums: dict[int, list] = {}
    for row in kept.select("embedding").mapInArrow(count, SUMS).repartition(ADDERS).mapInArrow(total, SUMS).collect():
        add(sums, row.cluster, row.n, list(map(int, row.sums)))
    return sums


def is_usable(embedding: Column, size: int) -> Column:
    """Exactly so many components, none null or non-finite."""
    odd = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.size(embedding) == size) & ~odd


def first_centroids(kept: DataFrame, clusters: int, seed: str, size: int, scale: int) -> list[list[int]]:
    """The vectors whose ids hash lowest, as whole numbers; at most ``clusters`` rows come to the driver."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    lowest = kept.where(F.col("vec_id").isNotNull()).orderBy(hashed, "embedding").limit(clusters)
    return [[whole(float(x), scale) for x in row.embedding] for row in lowest.select("embedding").collect()]


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    df: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    scale: int = SCALE,
    seed: str = "2",
    vector_col: str = "embedding",
    id_col: str = "vec_id",
) -> tuple[DataFrame, list[list[int]]]:
    """Rows of usable vectors with ``cluster`` and ``distance``, and the final centroids.

    Usable are vectors of exactly ``size`` components, none null or non-finite; other rows
    go. Components become floor(scale * x). The first centroids are the vectors whose id
    hashes lowest; if there are fewer vectors than ``clusters``, all of them. A repeated id
    gives as many of them as it has vectors, the smaller vector first; rows without an id
    are clustered but are no first centroid. Each of ``rounds`` rounds replaces a centroid
    by the floor of its vectors' mean, and leaves one without vectors as it is; ties of
    distance go to the smaller number. Equal vectors are always in one cluster.
    ``distance`` is squared, and null beyond 64 bits. An empty table gives no rows and no
    centroids; without any id there is no centroid, and no rows come back. Other columns
    stay; same-named ones are replaced.

    Only sums of clusters and centroids come to the driver: at most 16 rows a cluster.
    """
    names = {"vec_id": F.col(quoted(id_col)), "embedding": F.col(quoted(vector_col))}
    kept = df.select(*[column.alias(name) for name, column in names.items()])
    kept = kept.where(is_usable(F.col("embedding"), size))
    centroids = Centroids(first_centroids(kept, clusters, seed, size, scale))
    if centroids.vectors:
        for _ in range(rounds):
            vectors = list(centroids.vectors)
            for number, (n, total) in cluster_sums(kept, centroids, size, scale).items():
                vectors[number] = [x // n for x in total]
            centroids = Centroids(vectors)

    @F.arrow_udf("cluster int, distance bigint")
    def nearest(embeddings: pa.Array) -> pa.Array:
        numbers, distances = [], []
        for _, some, away, _, _ in assigned(centroids, embeddings, size, scale):
            numbers += some
            distances += [d if d <= LONGEST else None for d in away]
        return pa.StructArray.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(distances, pa.int64())], ["cluster", "distance"]
        )

    (found,) = unused(df, "found")
    rest = [F.col(quoted(name)) for name in df.columns if name.lower() not in ("cluster", "distance")]
    usable = df.where(is_usable(F.col(quoted(vector_col)), size) & F.lit(bool(centroids.vectors)))
    judged = usable.withColumn(found, nearest(F.col(quoted(vector_col))))
    return judged.select(*rest, f"{found}.cluster", f"{found}.distance"), centroids.vectors


def with_inertia(assigned_rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Add ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; the rows are written to the shared folder first.

    One row a cluster is joined, which is few whatever the number of vectors.
    """
    rows = as_table(assigned_rows, "assigned")
    sums = {row.cluster: row.inertia for row in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    inertia = sum(filter(None, sums.values()))
    figures = [(number, sums.get(number), inertia, digest(centroid)) for number, centroid in enumerate(centroids)]
    named = rows.sparkSession.createDataFrame(
        figures, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return rows.join(F.broadcast(named), "cluster")
