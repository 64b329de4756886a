import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickwatch.llm import neighbours, queries

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, note STRING"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "n") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_query(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return found


def brute(vectors, ids, query, k):
    scored = sorted(((-float(np.dot(v, vectors[query])), i) for v, i in zip(vectors, ids) if i != ids[query]))
    return [(n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 32))
    vectors = (centres[rng.integers(0, 8, 1500)] + rng.normal(size=(1500, 32))).astype(np.float32).astype(float)
    got = by_query(neighbours.search(frame(spark, vectors), F.col("vec_id") % 20 == 0, k=20))
    assert len(got) == 75
    hits = 0
    for query, rows in got.items():
        wanted = brute(vectors, range(1500), query, 20)
        assert [r[0] for r in rows] == list(range(1, 21))
        assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        assert all(r[2] == pytest.approx(float(np.dot(vectors[r[1]], vectors[query])), abs=1e-9) for r in rows)
        hits += len({r[1] for r in rows} & {r[1] for r in wanted})
    assert hits / (75 * 20) >= 0.9


def test_copies_ties_and_vectors_that_take_no_part(spark):
    base = [[1, 0], [1, 0], [0, 1], [1, 0], [0.5, 0.5], None, [0, 0], [None, 1], [float("nan"), 1], [float("inf"), 1], [1], [-0.0, 1]]
    got = by_query(neighbours.search(frame(spark, base), F.col("vec_id").isin(0, 4, 5, 6, 11), k=4))
    assert got == {
        0: [(1, 1, 1.0), (2, 3, 1.0), (3, 4, 0.5), (4, 2, 0.0)],
        4: [(1, 0, 0.5), (2, 1, 0.5), (3, 2, 0.5), (4, 3, 0.5)],
        11: [(1, 2, 1.0), (2, 4, 0.5), (3, 0, 0.0), (4, 1, 0.0)],
    }


def test_a_large_group_of_copies(spark):
    rng = np.random.default_rng(4)
    vectors = [[1.0] * 8] * 300 + rng.normal(size=(50, 8)).round(3).tolist()
    got = by_query(neighbours.search(frame(spark, vectors), F.col("vec_id").isin(0, 10, 299, 320), k=5))
    assert [r[1] for r in got[0]] == [1, 2, 3, 4, 5]
    assert [r[1] for r in got[10]] == [0, 1, 2, 3, 4] and [r[1] for r in got[299]] == [0, 1, 2, 3, 4]


def test_few_rows_none_and_repeats(spark):
    one = [[1.0, 2.0]]
    assert by_query(neighbours.search(frame(spark, one), F.lit(True))) == {}
    twice = frame(spark, one * 3, [7, 7, 8])
    assert by_query(neighbours.search(twice, F.lit(True))) == {7: [(1, 8, 5.0)], 8: [(1, 7, 5.0)]}
    assert neighbours.search(twice.limit(0), F.lit(True)).count() == 0
    assert neighbours.search(frame(spark, [None, [0.0]], [1, None]), F.lit(True)).count() == 0


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 256, (400, 4), np.uint8)
    index = neighbours.MultiIndex(codes)
    for radius in (0, 3, 5, 9, 13):
        inside = index.within(codes[:40], radius, 1)
        for code, found in zip(codes, inside):
            wanted = np.flatnonzero(np.unpackbits(codes ^ code, axis=1).sum(1) <= radius)
            assert np.flatnonzero(found).tolist() == wanted.tolist()
    assert index.within(codes[:1], 0, 50).sum() >= 50


def test_probing_is_used_where_it_rules_out_codes():
    rng = np.random.default_rng(6)
    index = neighbours.MultiIndex(rng.integers(0, 256, (2000, 8), np.uint8))
    code = rng.integers(0, 256, 8, np.uint8)
    assert len(index.probed(code, 7)) < 200 and index.probed(code, 30) is None
    # Codes of eleven bytes are padded to whole words.
    codes = rng.integers(0, 256, (50, 11), np.uint8)
    away = neighbours.distances(neighbours.words(codes), neighbours.words(codes[:3]))
    assert away.tolist() == [[int(np.unpackbits(a ^ b).sum()) for b in codes] for a in codes[:3]]


def test_best_of_breaks_ties_by_name():
    vectors = np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0], [2.0, 0.0]])
    names, inside = np.array([9, 4, 1, 7]), np.array([[True, True, True, False]])
    ((found, scores),) = neighbours.best_of(vectors, names, np.array([[1.0, 0.0]]), inside, 2)
    assert found.tolist() == [4, 9] and scores.tolist() == [1.0, 1.0]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_recall_of_the_registered_query(spark, folder):
    sf_dir = entry.SMALL.replace("sf0.001", folder)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").toPandas().sort_values("vec_id")
    ids, vectors = rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), float)
    got = by_query(queries.QUERIES["op9_neighbours"](spark, sf_dir))
    asked = [at for at, i in enumerate(ids) if i % 20 == 0]
    assert sorted(got) == ids[asked].tolist()
    hits, hundredth = [], []
    for at in asked:
        wanted = {i for _, i, _ in brute(vectors, ids, at, 20)}
        hits.append(len(wanted & {i for _, i, _ in got[ids[at]]}))
        hundredth += hits[-1:] if ids[at] % 100 == 0 else []
        assert all(score == pytest.approx(float(np.dot(vectors[ids.searchsorted(i)], vectors[at])), abs=1e-12) for _, i, score in got[ids[at]])
    assert np.mean(hits) / 20 >= 0.9 and np.mean(hundredth) / 20 >= 0.9


def test_columns_with_clashing_names(spark):
    rows = [(i, [1.0, float(i)], "r", "s", 0) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, rank STRING, score STRING, class INT")
    found = neighbours.search(df, F.col("vec_id") == 1, k=2)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert [tuple(r) for r in found.orderBy("rank").collect()] == [(1, 1, 3, 4.0), (1, 2, 2, 3.0)]
