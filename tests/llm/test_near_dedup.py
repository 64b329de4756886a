import itertools
import random

import pytest
from samples import ODD, words_of
from pyspark.sql import functions as F

from tickwatch.llm import near_dedup
from tickwatch.llm.components import components


def shingles(text, words):
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def brute(rows, words):
    sets = {i: shingles(text, words) for i, text in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            a, b = sorted((root(a), root(b)))
            label[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def edited(text, times, source):
    words = text.split()
    for _ in range(times):
        words[source.randrange(len(words))] = f"new{source.randrange(10_000)}"
    return " ".join(words)


def near_copies(seed):
    """Groups of copies with few and many edits, a chain, a shared passage, and strangers."""
    source = random.Random(seed)
    texts = []
    for group in range(6):
        text = words_of(120, seed * 100 + group)
        texts += [edited(text, source.randrange(14), source) for _ in range(12)] + [text, text]
    chain = words_of(100, seed + 7)
    for _ in range(10):
        chain = edited(chain, 5, source)
        texts.append(chain)
    passage = words_of(60, seed + 8)
    texts += [passage + " " + words_of(source.randrange(5, 80), 500 + n, 5000) for n in range(40)]
    source.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("words", [2, 5])
def test_components_equal_brute_force(documents, words):
    rows = [*near_copies(words), *[(1000 + n, text) for n, text in enumerate(ODD)]]
    assert found(near_dedup.near_duplicates(documents(rows), words=words)) == brute(rows, words)


def test_large_bands_are_split_over_blocks(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    rows = near_copies(3)
    assert found(near_dedup.near_duplicates(documents(rows), words=2)) == brute(rows, 2)


def test_odd_rows(documents):
    text = words_of(50, 1)
    rows = documents([(None, text), (1, text), (1, text), (2, text), (2, words_of(50, 2)), (5, None), (6, None)])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id, r.kept) for r in near_dedup.near_duplicates(rows).collect())
    assert got == [(False, 1, 1, True), (False, 1, 1, True), (False, 2, 1, False), (False, 2, 2, True), (False, 5, 5, True),
                   (False, 6, 6, True), (True, 0, None, True)]
    assert near_dedup.near_duplicates(rows.limit(0)).count() == 0


def test_bounds_follow_the_posterior():
    bounds = near_dedup.least_matches(0.8, 1e-6)
    assert [n for n, _ in bounds] == [32, 64, 96, 128]
    # No chance to be dropped for a pair whose matches are as many as expected.
    assert all(m < 0.8 * n for n, m in bounds)
    strict = near_dedup.least_matches(0.8, 0.01)
    assert all(a < b for (_, a), (_, b) in zip(bounds, strict))


def test_signatures_estimate_similarity():
    one = near_dedup.shingle_set(words_of(3000, 5, 100_000), 1)
    other = one[: int(len(one) * 0.8)]
    agree = (near_dedup.signature(one) == near_dedup.signature(other)).mean()
    assert abs(agree - 0.8) < 0.15


def test_components_of_a_long_path_and_a_star(spark):
    path = [(n, n + 1) for n in range(0, 200)]
    star = [(1000, 1000 + n) for n in range(1, 50)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (None, 3), (201, 200)], "a BIGINT, b BIGINT")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{n: 0 for n in range(1, 202)}, **{1000 + n: 1000 for n in range(1, 50)}}
    assert components(edges.where(F.lit(False))).count() == 0
