import random
from collections import defaultdict

import numpy as np
import pytest
from samples import ODD

from tickwatch.llm import line_dedup
from tickwatch.llm.cuckoo import CuckooFilter

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows):
    holders = defaultdict(set)
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= 20:
                    holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = lambda line: i is not None and len(holders[key(line)]) >= 3 and max(holders[key(line)]) != i
        kept = [line for line in lines if not gone(line)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def corpus(count, seed):
    source = random.Random(seed)
    pool = [f"Line number {n} that is long enough" for n in range(12)] + ["short", "é" * 19, "é" * 20, " Padded line of some length\t"]
    varied = lambda line: line.upper() if source.random() < 0.2 else line
    return [(i, "\n".join(varied(source.choice(pool)) for _ in range(source.randrange(6)))) for i in range(count)]


def test_dedup_equals_brute_force(documents):
    rows = [*corpus(60, 1), *[(100 + n, text) for n, text in enumerate(ODD)], (None, "Line number 1 that is long enough")]
    rows += [(7, rows[7][1]), (7, "Line number 2 that is long enough\nother")]
    assert found(line_dedup.dedup(documents(rows))) == brute(rows)


def test_the_index_is_reversible(documents, spark, tmp_path):
    first, second = corpus(40, 2), [(100 + i, text) for i, text in corpus(40, 3)]
    index = line_dedup.LineIndex.of(documents(first))
    grown = index.insert(documents(second)).insert(documents(second[:5]))
    assert found(grown.dedup(documents(first + second))) == brute(first + second)
    gone = [row for row in first + second if row[0] % 3 == 0]
    left = [row for row in first + second if row[0] % 3]
    shrunk = grown.delete(documents(gone + [(999, "unknown")]))
    assert found(shrunk.dedup(documents(left))) == brute(left)
    back = shrunk.delete(documents(second))
    wanted = [row for row in first if row[0] % 3]
    assert found(back.dedup(documents(wanted))) == brute(wanted)
    line_dedup.save(shrunk, str(tmp_path / "index"))
    again = line_dedup.open_index(spark, str(tmp_path / "index"))
    assert found(again.dedup(documents(left))) == brute(left)


def test_every_filter_holds_its_keys_after_changes(documents):
    rows = corpus(50, 4)
    index = line_dedup.LineIndex.of(documents(rows)).insert(documents([(100 + i, t) for i, t in corpus(30, 5)]))
    filters = {r.shard: CuckooFilter.load(r["filter"]) for r in index.filters.collect()}
    for r in index.repeated().collect():
        assert filters[r.k1 % index.shards].holds(np.array([r.k1]), np.array([r.k2])).all()


def test_empty_and_other_columns(documents):
    df = documents([(1, "a")]).withColumnRenamed("source", "N_LINES")
    made = line_dedup.dedup(df)
    assert [c for c in made.columns if c.lower() == "n_lines"] == ["n_lines"] and made.first().n_lines == 1
    assert line_dedup.dedup(df.limit(0)).count() == 0


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 63), 1 << 63, (20_000, 2), np.int64)
    inside, outside = keys[:10_000], keys[10_000:]
    made = CuckooFilter.of(inside[:, 0], inside[:, 1])
    assert made.holds(inside[:, 0], inside[:, 1]).all()
    assert made.holds(outside[:, 0], outside[:, 1]).mean() < 0.01
    made.delete(inside[:5000, 0], inside[:5000, 1])
    loaded = CuckooFilter.load(made.dump())
    assert loaded.holds(inside[5000:, 0], inside[5000:, 1]).all()
    assert loaded.holds(inside[:5000, 0], inside[:5000, 1]).mean() < 0.01
    with pytest.raises(KeyError):
        CuckooFilter.of(np.empty(0, np.int64), np.empty(0, np.int64)).delete(inside[:1, 0], inside[:1, 1])
