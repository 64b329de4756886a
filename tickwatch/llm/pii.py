"""Personal data: fixed patterns, and identifiers learned from the contexts of what those find.

Seeds are the spans of the fixed patterns. The words around them are lexical patterns.
Patterns and the values they stand beside form a graph; a pattern is as sure of a kind
as the values beside it, an unknown value as sure as its surest pattern. After some
rounds, sure patterns with enough seeds mark unknown identifiers of a fitting shape.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch.llm.frames import quoted, unused, with_struct
from tickwatch.settings import as_table

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that fails inside a run of digits fails from each of its digits alike.
IP_TEXT = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD_TEXT = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE_TEXT = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
MARK = re.compile(r"[0-9@]")
NUMBER_SHAPE = re.compile(r"[0-9(+][0-9().+/\x20-]*")
# A longest run of digits and what may stand between them, over several words.
RUN = re.compile(r"(?<!\w)[(+]*[0-9](?:[\x20()./-]*[0-9])*(?!\w)")
IP_SHAPE = re.compile(r"[0-9A-Fa-f]*(?:[.:][0-9A-Fa-f]*){3,}")
EDGES = "\"'`.,;:!?()[]{}<>|*#&$%=/\\"
# Longer values and words are told apart by digests, which take no more room.
LONGEST = 64
# How far to look for a neighbouring word at first.
NEAR = 64

SPAN = T.ArrayType(T.StructType([T.StructField(name, T.IntegerType()) for name in ("start", "kind", "end")]))


@dataclass(frozen=True)
class Rules:
    """How sure a pattern must be, and how many different seeds it must have."""

    confidence: float = 0.8
    least_seeds: int = 5
    # Counted as further values of no kind beside each pattern.
    doubt: float = 1.0
    rounds: int = 3


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the e-mail pattern, found from their signs outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start, following = at, at + 1
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = following = domain.end()
        at = text.find("@", following)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    found = [(start, EMAIL, end) for start, end in emails(text)]
    if DIGIT.search(text):
        for match in IP_TEXT.finditer(text):
            parts = [part.lstrip("0") for part in match[0].split(".")]
            if all(len(part) < 4 and int(part or 0) < 256 for part in parts):
                found.append((match.start(), IP, match.end()))
        for match in CARD_TEXT.finditer(text):
            digits = match[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and passes_luhn(digits):
                found.append((match.start(), CARD, match.end()))
        if "+" in text:
            for match in PHONE_TEXT.finditer(text):
                if 10 <= len(DIGIT.findall(match[0])) <= 15:
                    found.append((match.start(), PHONE, match.end()))
    return sorted(found)


def shapes(value: str) -> list[int]:
    """The kinds that an unknown identifier may be of by its looks."""
    if "@" in value and len(value) > 1:
        return [EMAIL]
    digits = len(DIGIT.findall(value))
    fitting = [IP] if IP_SHAPE.fullmatch(value) else []
    if NUMBER_SHAPE.fullmatch(value):
        fitting += [CARD] * (12 <= digits <= 19) + [PHONE] * (7 <= digits <= 15)
    return fitting


def unknown_spans(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Words with a digit or an at sign that look like identifiers and touch no base span."""
    starts, done = [span[0] for span in taken], 0
    longest = []
    for _, _, end in taken:
        longest.append(max(end, longest[-1] if longest else 0))
    for mark in MARK.finditer(text):
        if mark.start() < done:
            continue
        start, end = mark.start(), mark.end()
        while start > done and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        done = end
        word = text[start:end]
        start += len(word) - len(word.lstrip(EDGES))
        value = word.strip(EDGES)
        end = start + len(value)
        before = bisect_right(starts, end - 1)
        if not (before and longest[before - 1] > start) and shapes(value):
            yield start, end


def unknown_runs(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, tuple[int, int]]]:
    """(start, end, where its contexts lie) of numbers written in several words that look like identifiers, in the text between base spans."""
    if not DIGIT.search(text):
        return
    done = 0
    for first, _, last in [*taken, (len(text), None, len(text))]:
        for match in RUN.finditer(text, done, max(done, first)):
            start, end = match.span()
            # Brackets around the run are neither part of it nor a word beside it.
            while text[start] == "(" and ")" not in text[start:end]:
                start += 1
            around = match.start(), end + text[end : end + start - match.start()].count(")")
            value = text[start:end]
            if " " in value and shapes(value):
                yield start, end, around
        done = max(done, last)


def unknowns(text: str, taken: list[tuple[int, int, int]]) -> Iterator[dict]:
    """All unknown identifiers: words, and runs over words with the contexts outside the whole run.

    ``outer`` is where the run around a word begins. A pattern that a run has from one of
    its own words is ``shared``: there the word counts as the pattern's value, not the run too.
    """

    def one(start: int, end: int, outer: int, run: bool, patterns: list[str], shared: list[str]) -> dict:
        value = text[start:end]
        made = {"kind": None, "start": start, "end": end, "value": told_apart(value), "shapes": shapes(value)}
        return {**made, "patterns": patterns, "shared": shared, "outer": outer, "run": run}

    runs = list(unknown_runs(text, taken))
    begins, inner = [run[0] for run in runs], [set() for _ in runs]
    for start, end in unknown_spans(text, taken):
        patterns, outer = contexts(text, start, end), start
        at = bisect_right(begins, start) - 1
        if at >= 0 and end <= runs[at][1]:
            outer = begins[at]
            inner[at].update(patterns)
        yield one(start, end, outer, False, patterns, [])
    for (start, end, around), known in zip(runs, inner):
        patterns = contexts(text, *around)
        yield one(start, end, start, True, [p for p in patterns if p not in known], [p for p in patterns if p in known])


def told_apart(value: str) -> str:
    """A value itself or, if it is long, a digest of all of it."""
    return value if len(value) <= LONGEST else "#" + hashlib.sha256(value.encode("utf-8", "replace")).hexdigest()


def words_before(text: str, end: int) -> list[str]:
    """The last two whole words before a place, however long they are and whatever blanks lie between."""
    size = NEAR
    while True:
        at = max(0, end - size)
        words = text[at:end].split()
        # With a third word, or a blank before them, the last two are whole.
        if at == 0 or len(words) > 2 or (len(words) == 2 and text[at].isspace()):
            return words[-2:]
        size *= 4


def word_after(text: str, start: int) -> list[str]:
    """The first whole word after a place, if there is one."""
    size = NEAR
    while True:
        words = text[start : start + size].split()
        if start + size >= len(text) or len(words) > 1 or (words and text[start + size - 1].isspace()):
            return words[:1]
        size *= 4


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span: the word before, the two before, the word after; digits are all alike."""
    plain = lambda word: told_apart(DIGIT.sub("0", word.lower().strip(EDGES) or word))
    left = [plain(word) for word in words_before(text, start)]
    right = [plain(word) for word in word_after(text, end)]
    found = ["< " + " ".join(left[-1:]), "< " + " ".join(left)] if left else []
    return list(dict.fromkeys(found + ["> " + word for word in right]))


def marked(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``text_key`` of each row, its base spans, and each seed or unknown identifier with its patterns."""
    text = F.col(quoted(text_col)).cast("string")
    source = df.select(F.col(quoted(id_col)).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    seen = T.StructType(
        [
            T.StructField("kind", T.IntegerType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("value", T.StringType()),
            T.StructField("shapes", T.ArrayType(T.IntegerType())),
            T.StructField("patterns", T.ArrayType(T.StringType())),
            T.StructField("shared", T.ArrayType(T.StringType())),
            T.StructField("outer", T.IntegerType()),
            T.StructField("run", T.BooleanType()),
        ]
    )
    schema = T.StructType(
        [
            *source.schema.fields[:2],
            T.StructField("base", SPAN),
            T.StructField("seen", T.ArrayType(seen)),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_type

    base_type, seen_type = to_arrow_type(SPAN), to_arrow_type(T.ArrayType(seen))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, seens = [], []
            for text in batch.column(2):
                text = text.as_py() or ""
                base = base_spans(text)
                rows = [
                    {"kind": kind, "start": s, "end": e, "value": told_apart(text[s:e]), "shapes": [], "patterns": contexts(text, s, e)}
                    for s, kind, e in base
                ]
                rows.extend(unknowns(text, base))
                bases.append([{"start": s, "kind": kind, "end": e} for s, kind, e in base])
                seens.append(rows)
            columns = [batch.column(0), batch.column(1), pa.array(bases, base_type), pa.array(seens, seen_type)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return source.mapInArrow(mark, schema)


def sure_patterns(occurrences: DataFrame, rules: Rules) -> DataFrame:
    """``pattern``, ``kind`` and ``confidence`` of the patterns with enough seeds, after all rounds.

    Different values count once beside a pattern, however many copies of a document there are.
    """
    edges = occurrences.select("pattern", "value", "kind", "shapes").distinct()
    edges = as_table(edges, "pattern-values")
    totals = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"))
    seeds = edges.where(F.col("kind").isNotNull()).select("pattern", "value", "kind")
    support = seeds.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= rules.least_seeds)
    known = as_table(support.join(totals, "pattern"), "patterns")
    open_edges = edges.where(F.col("kind").isNull()).select("pattern", "value", "shapes")
    scored = known.withColumn("confidence", F.col("seeds") / (F.col("values") + rules.doubt))
    for _ in range(rules.rounds - 1):
        reached = open_edges.join(scored, "pattern").where(F.array_contains("shapes", F.col("kind")))
        beliefs = reached.groupBy("value", "kind").agg(F.max("confidence").alias("belief"))
        shared = open_edges.select("pattern", "value").join(as_table(beliefs, "beliefs"), "value")
        gained = shared.groupBy("pattern", "kind").agg(F.sum("belief").alias("gained"))
        scored = known.join(gained, ["pattern", "kind"], "left").withColumn(
            "confidence", (F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("values") + rules.doubt)
        )
        scored = as_table(scored.drop("gained"), "scores")
    return scored.where(F.col("confidence") >= rules.confidence).select("pattern", "kind", "confidence")


def found_spans(df: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text_key``, ``base`` and ``learned`` spans (start, kind, end; code points) of every row.

    One row for each row of the input, repeated rows too, in no order; spans are sorted.
    Null and empty texts have none. Texts, identifiers and the words around them may be of
    any length. An unknown identifier is a word, or a number over several words, that looks
    like one: with an at sign, as an address of four parts or more, or with the digits of a
    phone (7 to 15) or card (12 to 19). Of several kinds the surest counts, of equally sure
    ones that listed first. Rows without an id are told apart by their texts; only the id
    and the text are read, so no other column can clash. An empty table gives no rows.
    """
    rows = as_table(marked(df, id_col, text_col), "marked")
    one = rows.select("id", "text_key", F.explode("seen").alias("one")).select("id", "text_key", "one.*")
    patterns = sure_patterns(one.withColumn("pattern", F.explode("patterns")), rules)
    unknown = one.where(F.col("kind").isNull()).drop("kind")
    hits = unknown.withColumn("pattern", F.explode(F.concat("patterns", "shared"))).join(patterns, "pattern")
    hits = hits.where(F.array_contains("shapes", F.col("kind")))
    # The surest kind of each span; ties go to the kind listed first.
    surest = F.max(F.struct("confidence", (-F.col("kind")).alias("last")))
    best = hits.groupBy("id", "text_key", "outer", "run", "start", "end").agg((-surest["last"]).alias("kind"))
    # A run stands for the words in it.
    span = F.struct("start", "kind", "end")
    runs = best.groupBy("id", "text_key", "outer").agg(
        F.max(F.when(F.col("run"), span)).alias("whole"), F.collect_set(span).alias("words")
    )
    chosen = F.when(F.col("whole").isNotNull(), F.array("whole")).otherwise(F.col("words"))
    learned = runs.groupBy("id", "text_key").agg(F.sort_array(F.flatten(F.collect_list(chosen))).alias("learned"))
    learned = learned.select(F.col("id").alias("its_id"), F.col("text_key").alias("its_key"), "learned")
    same = (F.col("text_key") == F.col("its_key")) & F.col("id").eqNullSafe(F.col("its_id"))
    joined = rows.drop("seen").join(learned, same, "left").drop("its_id", "its_key")
    return joined.withColumn("learned", F.coalesce("learned", F.array().cast(SPAN)))


def redact(df: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Replace all spans found in each text by their kind in angle brackets; columns stay as they are.

    Spans that overlap are replaced as one, by the kind that begins first. A null text
    stays null. Rows without an id are searched like others, repeated rows alike. An
    empty table gives an empty result.
    """
    its_id, its_key, its_spans = unused(df, "pii_id", "pii_key", "pii_spans")
    spans = found_spans(df, rules, id_col, text_col).select(
        F.col("id").alias(its_id),
        F.col("text_key").alias(its_key),
        F.sort_array(F.concat("base", "learned")).alias(its_spans),
    )
    spans = spans.where(F.size(its_spans) > 0).dropDuplicates([its_id, its_key])
    text = F.col(quoted(text_col)).cast("string")
    same = (F.xxhash64(text) == F.col(its_key)) & F.col(quoted(id_col)).eqNullSafe(F.col(its_id))
    joined = df.join(spans, same, "left")

    @F.arrow_udf("text string")
    def replaced(texts: pa.Array, found: pa.Array) -> pa.Array:
        made = []
        for text, spans in zip(texts, found):
            text, spans = text.as_py(), spans.as_py()
            if text and spans:
                out, done = [], 0
                for span in spans:
                    if span["start"] >= done:
                        out += [text[done : span["start"]], f"<{KINDS[span['kind']].upper()}>"]
                    done = max(done, span["end"])
                text = "".join([*out, text[done:]])
            made.append(text)
        return pa.StructArray.from_arrays([pa.array(made, pa.string())], ["text"])

    order = df.columns
    made = with_struct(joined, replaced(text, F.col(its_spans)), {"text": text_col})
    return made.select(*[F.col(quoted(name)) for name in order])
