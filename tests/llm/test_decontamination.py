import random
import re

import pytest
from samples import ODD, words_of

from tickwatch.llm import decontamination
from tickwatch.llm.decontamination import WuManber, merged

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=10):
    """(number of words, set of hit words, sorted ids of items) of each text."""
    windows = {}
    for item, text in items:
        words = split(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[at : at + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        words, hit, found = split(text), set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                if which := windows.get(tuple(words[at : at + size])):
                    hit |= set(range(at, at + size))
                    found |= which
        out.append((len(words), hit, sorted(str(item) for item in found if item is not None)))
    return out


def check(spark, documents, texts, items, **how):
    docs = documents(list(enumerate(texts)))
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    rows = decontamination.find(docs, benchmark, **how).collect()
    assert len(rows) == len(texts)
    expected = brute(texts, items, how.get("window", 10))
    for row in rows:
        n_words, hit, found = expected[row.doc_id]
        covered = [word for span in row.spans for word in range(span.start, span.end)]
        assert (row.n_words, covered, row["items"]) == (n_words, sorted(hit), found), texts[row.doc_id]


ITEMS = [
    (7, words_of(40, 1)),
    (70, words_of(25, 2) + " " + words_of(12, 1)),
    (8, "Short one"),
    (9, "w1"),
    (None, words_of(15, 3)),
    (10, None),
    (11, ""),
    (12, " .,! "),
    (13, words_of(40, 1)),
    (7, words_of(11, 4)),
    (14, "Ünï, Ünï; Ünï 漢字"),
    (15, "ab " * 30),
]


def texts_with_passages(seed):
    source, texts = random.Random(seed), list(ODD)
    for _ in range(120):
        parts = []
        for _ in range(source.randrange(6)):
            words = split(source.choice(ITEMS)[1]) or ["x"]
            at = source.randrange(len(words))
            parts.append(source.choice([" ", ", ", "\n"]).join(words[at : at + source.randrange(1, 30)]).upper())
            parts.append(words_of(source.randrange(12), source.randrange(9)))
        texts.append(" ".join(parts))
    return texts


def test_words_equal_the_pattern():
    source = random.Random(5)
    for _ in range(300):
        text = "".join(chr(source.choice([source.randrange(256), source.randrange(0x3000), 0x1F600])) for _ in range(40))
        assert [w.decode() for w in decontamination.words_of(text.encode())] == split(text)
    assert decontamination.words_of(None) == decontamination.words_of(b"") == []


@pytest.mark.parametrize("length", [1, 2, 3, 7])
def test_search_equals_all_places(length):
    source = random.Random(length)
    words = [source.choice([b"a", b"b", b"c"]) for _ in range(4000)]
    windows = {tuple(source.choice([b"a", b"b", b"c"]) for _ in range(length)) for _ in range(12)}
    found = list(WuManber(length, [(list(w), str(i)) for i, w in enumerate(windows)]).search(words))
    numbers = {w: str(i) for i, w in enumerate(windows)}
    places = [(at, at + length, tuple(words[at : at + length])) for at in range(len(words) - length + 1)]
    assert found == [(at, end, {numbers[w]}) for at, end, w in places if w in numbers]


def test_positions_are_skipped():
    words = [f"v{n}".encode() for n in range(10_000)]
    asked = []

    class Counted(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    search = WuManber(10, [([f"x{n}".encode() for n in range(10)], "1")])
    search.shifts = Counted(search.shifts)
    assert not list(search.search(words)) and len(asked) <= 10_000 / 9 + 1


def test_merged_spans():
    assert merged([(5, 9), (0, 3), (3, 4), (6, 7), (20, 21)]) == [(0, 4), (5, 9), (20, 21)]


def test_documents_equal_brute_force(spark, documents):
    check(spark, documents, texts_with_passages(1), ITEMS)
    check(spark, documents, texts_with_passages(2), ITEMS, window=3)


def test_many_shards_equal_brute_force(spark, documents):
    check(spark, documents, texts_with_passages(3), ITEMS, shard_windows=30)


def test_a_very_long_text_and_item(spark, documents):
    text = words_of(60_000, 11, words=5000)
    check(spark, documents, [text, text[1000:1100]], [(1, words_of(3000, 12, words=5000)), (2, text[5000:9000])])


def test_windows_of_an_item_over_several_batches(spark, monkeypatch):
    items = spark.createDataFrame([(1, words_of(95, 1)), (2, "a b"), (3, words_of(10, 2))], "item_id BIGINT, text STRING")
    whole = set(map(tuple, decontamination.windows_of(items, "item_id", "text", 10).collect()))
    assert len(whole) == 86 + 1 + 1


def test_empty_tables(spark, documents):
    check(spark, documents, ["a b"], [])
    check(spark, documents, [], ITEMS)


def test_clashing_columns_give_way(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y", "z")], "doc_id BIGINT, text STRING, N_Words STRING, items STRING, earlier STRING")
    row = decontamination.find(docs, spark.createDataFrame([(1, "b")], "item_id BIGINT, text STRING")).first()
    assert row.asDict(True) == {
        "doc_id": 1, "text": "a b", "earlier": "z", "n_words": 2, "spans": [{"start": 1, "end": 2}], "items": ["1"],
    }


def test_documents_without_passages_stay(spark, documents):
    docs = documents([(1, "clean text"), (2, None), (3, "x short one")])
    found = decontamination.find(docs, spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING"))
    left = decontamination.without_spans(found)
    assert left.columns == docs.columns and sorted(row.doc_id for row in left.collect()) == [1, 2]
