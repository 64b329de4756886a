import random
import struct

import corpus_pipeline
import duckdb
import pytest
import test_line_dedup
import test_near_dedup
import test_packing
import test_pii
import test_quality_rules
from samples import ODD
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tickwatch.llm import quality
from tickwatch.llm.oracle import ORACLES
from tickwatch.llm.queries import QUERIES

SMALL = entry.SMALL


def corpus():
    source = random.Random(5)
    common = quality.COMMON_WORDS["en"][:10] * 4 + [f"noun{chr(97 + n)}{chr(97 + m)}" for n in range(12) for m in range(12)]
    texts = []
    for n in range(40):
        lines = [" ".join(source.choice(common) for _ in range(12)) for _ in range(8)]
        texts.append("\n".join(lines))
    texts += [t + f"\nplease write to user{n}@mail.example.com or 10.0.0.{n}" for n, t in enumerate(texts[:10])]
    texts += [test_near_dedup.edited(t, 2, source) for t in texts[:15]]
    notice = "This line stands below very many of the documents"
    texts = [t + "\n" + notice if n % 3 == 0 else t for n, t in enumerate(texts)]
    texts += ["| ".join("CELL!!" for _ in range(60)), "few words only", *ODD]
    return list(enumerate(texts))


def test_pipeline_equals_brute_force_stages(spark, documents):
    docs = documents(corpus())
    kept = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    judged = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    failed = {i for i, t in corpus() if (b := test_quality_rules.base(t))[0] < 50 or 2 * b[4] > b[0]}
    assert set(kept) == judged and not failed & judged and set(range(40)) <= judged

    lines = corpus_pipeline.repeated_lines(spark, documents(kept.items()), "")
    assert lines.columns == docs.columns and all(r.n_chars == len(r.text) for r in lines.collect())
    wanted = {i: text for i, text, *_ in test_line_dedup.brute(list(kept.items()))}
    assert {r.doc_id: r.text for r in lines.collect()} == wanted and wanted != kept

    single = corpus_pipeline.near_duplicates(spark, documents(wanted.items()), "")
    labels = test_near_dedup.brute(list(wanted.items()), 5)
    stay = {i: wanted[i] for i, (_, _, first) in labels.items() if first}
    assert {r.doc_id: r.text for r in single.collect()} == stay and len(stay) < len(wanted)

    clean = {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, documents(stay.items()), "").collect()}
    assert set(clean) == set(stay) and not any(test_pii.brute(text) for text in clean.values())
    assert all(clean[i] == stay[i] for i in stay if not test_pii.brute(stay[i]))

    rows = corpus_pipeline.packed_sequences(spark, documents(clean.items()), "").collect()
    test_packing.check(rows, 4096)
    tokeniser = Tokenizer.from_file(test_packing.PATH)
    for r in rows:
        ids = [*tokeniser.encode(clean[r.doc_id], add_special_tokens=False).ids, 1]
        assert bytes(r.ids) == struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length])
    assert {r.doc_id for r in rows} == set(clean)


def test_stages_take_empty_tables(spark, documents):
    none = documents([(1, "x")]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").count() == 0


def test_run_over_a_folder(spark, documents, tmp_path):
    documents(corpus()).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {name[: name.index("_") + 1] for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    relation = duck.execute(ORACLES[name])
    names = [column[0] for column in relation.description]
    got = QUERIES[name](spark, SMALL).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(relation.fetchall(), key=repr)
