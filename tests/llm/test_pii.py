import re

from samples import ODD

from tickwatch.llm import pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value // 10 + value % 10
    return total % 10 == 0


def brute(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            good = (
                True,
                kind != 1 or max(map(int, match[0].split("."))) <= 255,
                kind != 2 or (14 <= len(digits) <= 19 and luhn(digits)),
                kind != 3 or 10 <= len(digits) <= 15,
            )
            if all(good):
                found.append((match.start(), kind, match.end()))
    return sorted(found)


TEXTS = [
    "mail a.b@c.de, x@y, @z.de, q@w.e.r. a@b.c@d.e é@f.gh 1+2%@h-i.jk..",
    "1.2.3.4 999.1.1.1.1 1.2.3.4.5.6.7.8 000255.1.1.01 1.2.3 12.34.56.789",
    "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111111111111112 0000000000000000 1-2 3  4111111111111111",
    "+1 (017) 555-7713 +49.30.1234567 +1 +12 (3) +1234567890123456 ++1 234 567 8901 +1 555 123 4567+1 555 123 4568",
    "1" * 3000 + "." + "2" * 3000, "@" * 200, "a" * 3000 + "@", "a@" + "b." * 1000,
]


def test_base_spans_equal_the_patterns():
    import random

    source = random.Random(3)
    alphabet = list("ab1 29.@+-() 0%é\n")
    texts = TEXTS + ["".join(source.choice(alphabet) for _ in range(80)) for _ in range(3000)]
    for text in texts:
        assert pii.base_spans(text) == brute(text), text[:100]


def test_contexts_find_what_the_patterns_miss(documents):
    rows = [(n, f"please ring me on mobile +1 555 010 {1000 + n} soon") for n in range(12)]
    rows += [(100, "please ring me on mobile 555-0199-22 soon"), (101, "chapter 555-0199-22 of the book"), (102, "mobile home")]
    rows += [(200 + n, f"on page {5000000 + n} of it") for n in range(12)]
    found = {r.id: [tuple(s) for s in r.learned] for r in pii.found_spans(documents(rows)).collect()}
    assert found[100] == [(25, pii.PHONE, 36)]
    assert [i for i, spans in found.items() if spans] == [100]


def test_redaction(documents):
    rows = [(1, "to a@b.cd or 1.2.3.4!"), (1, "other 5.6.7.8"), (None, "me@x.yz"), (3, None), (4, ""), (5, "me@x.yz"), (5, "me@x.yz")]
    made = pii.redact(documents(rows))
    assert made.columns == documents(rows).columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.text is None) for r in made.collect())
    assert got == [
        (False, 1, "other <IP>", False), (False, 1, "to <EMAIL> or <IP>!", False), (False, 3, "", True), (False, 4, "", False),
        (False, 5, "<EMAIL>", False), (False, 5, "<EMAIL>", False), (True, 0, "<EMAIL>", False),
    ]


def test_odd_texts_stay_and_empty_tables(documents):
    rows = list(enumerate(ODD))
    assert {r.doc_id: r.text for r in pii.redact(documents(rows)).collect()} == dict(rows)
    assert pii.redact(documents(rows).limit(0)).count() == 0


def test_overlapping_spans_are_replaced_as_one(documents):
    text = "call +30569309025904 now"
    assert [kind for _, kind, _ in pii.base_spans(text)] == [pii.PHONE, pii.CARD]
    assert pii.redact(documents([(1, text)])).first().text == "call <PHONE> now"


def test_numbers_in_several_words_are_found_whole(documents):
    rows = [(n, f"please ring me on mobile +1 (743) 555-{1000 + n} soon") for n in range(12)]
    starts = [f"4111111111111{n:02d}" for n in range(12)]
    digits = [start + next(str(d) for d in range(10) if luhn(start + str(d))) for start in starts]
    cards = [" ".join(card[at : at + 4] for at in range(0, 16, 4)) for card in digits]
    rows += [(50 + n, f"we charged visa {card} twice") for n, card in enumerate(cards)]
    wanted = {
        100: ("please ring me on mobile ", "(743) 555-3824", " soon", "PHONE"),
        101: ("please ring me on mobile ", "06 12 34 56 78", " later", "PHONE"),
        102: ("we charged visa ", "4111 1111 1111 1112", " twice", "CARD"),
        103: ("to 1.2.3.4 and mobile (", "743 555 3824", ") again", "PHONE"),
    }
    rows += [(n, left + number + right) for n, (left, number, right, _) in wanted.items()]
    rows += [(200, "chapter 06 12 34 56 78 of the book")]
    found = {r.id: [tuple(s) for s in r.learned] for r in pii.found_spans(documents(rows)).collect()}
    expected = {
        n: [(len(left), pii.KINDS.index(kind.lower()), len(left + number))] for n, (left, number, _, kind) in wanted.items()
    }
    assert {n: spans for n, spans in found.items() if spans} == expected
    redacted = {r.doc_id: r.text for r in pii.redact(documents(rows)).collect()}
    assert redacted[100] == "please ring me on mobile <PHONE> soon" and redacted[102] == "we charged visa <CARD> twice"
    assert redacted[103] == "to <IP> and mobile (<PHONE>) again"


def test_numbers_side_by_side_are_still_found(documents):
    rows = [(n, f"please ring me on mobile +1 555 010 {1000 + n} soon") for n in range(12)]
    rows += [(100, "ring mobile 555-0199-22 555-0199-23 555-0199-24 now")]
    found = {r.id: [tuple(s) for s in r.learned] for r in pii.found_spans(documents(rows)).collect()}
    assert found[100] == [(12, pii.PHONE, 23)]


def ringing(count):
    return [(n, f"please ring me on mobile +1 555 010 {1000 + n} soon") for n in range(count)]


def test_identifiers_may_be_of_any_length(documents):
    rows = [(n, f"write to user{n}@host.org now") for n in range(12)]
    long = "b" * 300 + "@" + "host" * 50
    rows += [(100, f"write to {long} now"), (101, "write to b@h now"), (102, "write to you now")]
    found = {r.id: [tuple(s) for s in r.learned] for r in pii.found_spans(documents(rows)).collect()}
    assert found[100] == [(9, pii.EMAIL, 9 + len(long))] and found[101] == [(9, pii.EMAIL, 12)] and found[102] == []


def test_long_seeds_that_begin_alike_are_different_values(documents):
    rows = [(n, f"write to {'a' * 130}{n}@host.org now") for n in range(12)] + [(100, "write to bob@host now")]
    found = {r.id: [tuple(s) for s in r.learned] for r in pii.found_spans(documents(rows)).collect()}
    assert found[100] == [(9, pii.EMAIL, 17)]


def test_contexts_are_whole_words():
    long = "w" * 500
    text = f"one {long}     {' ' * 200}\n x@y {' ' * 300}{long}er end"
    at = text.index("x@y")
    told = pii.told_apart(long)
    assert pii.contexts(text, at, at + 3) == [f"< {told}", f"< one {told}", f"> {pii.told_apart(long + 'er')}"]
    assert pii.contexts("x@y", 0, 3) == [] and told != pii.told_apart(long + "er") and len(told) == 65


def brute_learned(texts, rules):
    """Spans learned by plain dictionaries over all texts."""
    seen = []
    for number, text in enumerate(texts):
        base = pii.base_spans(text or "")
        for s, kind, e in base:
            seen.append({"doc": number, "kind": kind, "value": text[s:e], "shapes": [], "patterns": pii.contexts(text, s, e), "shared": []})
        seen += [{"doc": number, **one} for one in pii.unknowns(text or "", base)]
    edges = {(p, o["value"], o["kind"], tuple(o["shapes"])) for o in seen for p in o["patterns"]}
    values, seeds = {}, {}
    for pattern, _, kind, _ in edges:
        values[pattern] = values.get(pattern, 0) + 1
        if kind is not None:
            seeds[pattern, kind] = seeds.get((pattern, kind), 0) + 1
    known = {key: n for key, n in seeds.items() if n >= rules.least_seeds}
    scored = {key: n / (values[key[0]] + rules.doubt) for key, n in known.items()}
    for _ in range(rules.rounds - 1):
        beliefs = {}
        for pattern, value, kind, shapes in edges:
            for (other, guess), sure in scored.items():
                if kind is None and other == pattern and guess in shapes:
                    beliefs[value, guess] = max(beliefs.get((value, guess), 0), sure)
        gained = {}
        for pattern, value, kind, _ in edges:
            for (other, guess), belief in beliefs.items():
                if kind is None and other == value:
                    gained[pattern, guess] = gained.get((pattern, guess), 0) + belief
        scored = {key: (n + gained.get(key, 0.0)) / (values[key[0]] + rules.doubt) for key, n in known.items()}
    sure = {key: found for key, found in scored.items() if found >= rules.confidence}
    best = {}
    for one in (o for o in seen if o["kind"] is None):
        fits = [(-found, kind) for (p, kind), found in sure.items() if p in one["patterns"] + one["shared"] and kind in one["shapes"]]
        if fits:
            best.setdefault((one["doc"], one["outer"]), []).append((one["run"], (one["start"], min(fits)[1], one["end"])))
    learned = {}
    for (doc, _), spans in best.items():
        runs = [span for run, span in spans if run]
        learned.setdefault(doc, []).extend(runs or [span for _, span in spans])
    return {doc: sorted(spans) for doc, spans in learned.items()}


def test_whole_result_equals_brute_force(documents):
    import random

    source = random.Random(9)
    lefts = ["ring me on mobile", "call tel", "write to", "my ip is", "charged visa", "see page", "no"]
    texts = [text for _, text in ringing(8)] + ODD
    for _ in range(250):
        left = source.choice(lefts)
        n = source.randrange(60)
        value = {
            0: [f"+1 555 010 {1000 + n}", f"555-01{n:02d}-22", f"(743) 555 38{n:02d}"], 1: [f"+49 30 1234 {n:03d}", f"030 1234 {n:03d}"],
            2: [f"u{n}@host.org", f"u{n}@host"], 3: [f"10.0.0.{n}", f"fe80:0:0:{n}:1"], 4: ["4111 1111 1111 1111", f"4111 1111 1111 11{n:02d}"],
            5: [f"{5000000 + n}"], 6: ["word", f"{n}"],
        }[lefts.index(left)]
        texts.append(f"{source.choice(['please', 'so', ''])} {left} {source.choice(value)} {source.choice(['soon', 'now', ''])}".strip())
    rules = pii.Rules(confidence=0.5, least_seeds=3)
    found = {r.id: r for r in pii.found_spans(documents(list(enumerate(texts))), rules).collect()}
    learned = brute_learned(texts, rules)
    assert sum(map(len, learned.values())) > 20
    for number, text in enumerate(texts):
        assert [tuple(s) for s in found[number].base] == brute(text or "")
        assert [tuple(s) for s in found[number].learned] == learned.get(number, []), text


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "me@x.yz", "k", "b", 3)], "doc_id BIGINT, text STRING, text_key STRING, base STRING, id INT")
    assert [tuple(s) for s in pii.found_spans(df).first().base] == [(0, pii.EMAIL, 7)]
    assert tuple(pii.redact(df).first()) == (1, "<EMAIL>", "k", "b", 3)
