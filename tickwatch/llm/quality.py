"""Quality rules from native expressions: base counts and divergence from language references.

A document's character classes and its common words are two histograms. Each is
compared with the reference of the document's language by the Jensen-Shannon
distance. References are the summed histograms of all documents of the language; those of
character classes are learned for every language there is, as a small table by language.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.functions.barrier import computed_once
from tickwatch.llm.frames import quoted
from tickwatch.settings import as_table

# Frequent function words of each language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "en": "the of and to in a is that for it as was with be by on not he his but at are this".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se".split(),
}
SLOTS = max(map(len, COMMON_WORDS.values()))
# One letter for each place in a list; a word outside the list is a dot.
LETTERS = "abcdefghijklmnopqrstuvwxyz"[:SLOTS]
SPACES = r"[\x20\x09-\x0D]"
BLANK = " \t\n\x0b\f\r"
CLASSES = ["lower", "upper", "digit", "space", "symbol", "other"]
# Histograms and how many counts each has; the last one is of everything else.
HISTOGRAMS = {"class_counts": len(CLASSES), "word_counts": SLOTS + 1}
# Up to so many different repeated windows a lookup in their list is quicker than a sort.
FEW = 32

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULTS = [*BASE, "class_distance", "word_distance", "base_failed", "kept"]


@dataclass(frozen=True)
class Rules:
    """Bounds of the verdict. Distances are square roots of divergences in bits, so from 0 to 1."""

    least_words: int = 50
    repeat_percent: int = 50
    class_distance: float = 0.3
    # The distance of common words beyond its noise.
    word_distance: float = 0.22
    noise: float = 1.0
    # Bounds that only count if both are passed.
    both_class_distance: float = 0.13
    both_word_distance: float = 0.19
    # Shorter texts have too rough a histogram to judge.
    least_chars: int = 200
    least_judged_words: int = 50


@dataclass(frozen=True)
class References:
    """Summed histograms by language: of words those of the word lists, of classes as a table (lang, class_sums)."""

    classes: DataFrame
    words: dict[str, list[int]] = field(default_factory=dict)


def word_array(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANK))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACES}+"))


def places_in(words: Column, known: list[str], alphabet: Column) -> Column:
    listed = F.array(*map(F.lit, known))
    return F.transform(words, lambda word: F.get(alphabet, F.array_position(listed, word).cast("int")))


def letters(words: Column, lang: Column) -> Column:
    """One letter for each word, by its place in the language's list; a dot for any other word."""
    made = F.lit("")
    alphabet = F.array(*map(F.lit, "." + LETTERS))
    for name, known in COMMON_WORDS.items():
        made = F.when(lang == name, F.array_join(places_in(words, known, alphabet), "")).otherwise(made)
    return made


def length(column: Column) -> Column:
    return F.char_length(column).cast("bigint")


def measure(df: DataFrame, text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """All columns in one struct ``row``, beside the base counts, ``lang`` and the counts of both histograms.

    The struct keeps columns of the input apart from all names made here.
    """
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    lang = F.col(quoted(lang_col)).cast("string") if lang_col else F.lit(None).cast("string")
    source = df.select(
        F.struct(F.lit(0).alias("none"), *[F.col(quoted(name)).alias(name) for name in df.columns]).alias("row"),
        text.alias("text"),
        lang.alias("lang"),
    )
    text = F.col("text")
    # Most letters are small; what is left without them is short.
    split = computed_once(
        source,
        ["row", "lang"],
        {
            "n_chars": length(text),
            "words": word_array(text),
            "lines": F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANK)) != ""),
            "rest": F.regexp_replace(text, r"\p{Ll}+", ""),
        },
    )
    words, lines, rest = F.col("words"), F.col("lines"), F.col("rest")
    size = F.size(words)
    at = lambda i: F.get(words, i)
    windows = F.transform(F.sequence(F.lit(0), size - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
    split = computed_once(
        split,
        ["row", "lang", "n_chars"],
        {
            "n_words": size.cast("bigint"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
            "lower": F.col("n_chars") - length(rest),
            **{
                name: length(rest) - length(F.regexp_replace(rest, pattern, ""))
                for name, pattern in (
                    ("upper", r"\p{Lu}+"),
                    ("digit", r"\p{Nd}+"),
                    ("space", f"{SPACES}+"),
                    ("symbol", r"[#*$%&|<>]+"),
                )
            },
            "letters": letters(words, F.col("lang")),
            "windows": F.when(size >= 3, windows).otherwise(F.array().cast("array<bigint>")),
        },
    )
    slots = [
        length(F.col("letters")) - length(F.replace(F.col("letters"), F.lit(letter), F.lit("")))
        for letter in [*LETTERS, "."]
    ]
    other = F.col("n_chars") - sum(F.col(name) for name in CLASSES[:-1])
    counted = computed_once(
        split,
        ["row", "lang", "n_chars", "n_words", "n_dup_lines", "windows"],
        {
            "word_chars": F.col("n_chars") - F.col("space"),
            "n_symbols": F.col("symbol"),
            "class_counts": F.array(*CLASSES[:-1], other),
            "word_counts": F.array(*slots),
        },
    )
    return repeated_words(counted, [name for name in counted.columns if name != "windows"])


def summed(name: str) -> list[Column]:
    return [F.sum(F.get(name, F.lit(i))).alias(f"{name}_{i}") for i in range(HISTOGRAMS[name])]


def learn_references(measured: DataFrame) -> References:
    """Sum the histograms of all measured documents by language.

    The sums of classes are written to the shared folder, one row for each language
    there is. One row for each word list comes to the driver.
    """
    by_language = measured.where(F.col("lang").isNotNull()).groupBy("lang").agg(*summed("class_counts"))
    sums = [F.coalesce(f"class_counts_{i}", F.lit(0)) for i in range(HISTOGRAMS["class_counts"])]
    classes = as_table(by_language.select("lang", F.array(*sums).alias("class_sums")), "class-references")
    known = measured.where(F.col("lang").isin(*COMMON_WORDS)).groupBy("lang").agg(*summed("word_counts"))
    words = {row["lang"]: [row[f"word_counts_{i}"] or 0 for i in range(SLOTS + 1)] for row in known.collect()}
    return References(classes, words)


def total(counts: str | Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda sum_, n: sum_ + n)


def shares(references: dict[str, list[int]]) -> Column:
    """The reference histogram of a row's language as shares of 1, null if there is none."""
    chosen = F.lit(None).cast("array<double>")
    for name, counts in sorted(references.items()):
        if whole := sum(counts):
            here = F.array(*[F.lit(count / whole) for count in counts])
            chosen = F.when(F.col("lang") == name, here).otherwise(chosen)
    return chosen


def distance(counts: str, reference: str) -> Column:
    """Jensen-Shannon distance of a histogram from shares; null where either is missing."""

    def divergence(count: Column, q: Column) -> Column:
        p = count / F.col(f"{counts}_total")
        own = F.when(count > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)
        return own + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0)

    terms = F.zip_with(counts, reference, divergence)
    summed = F.aggregate(terms, F.lit(0.0), lambda sum_, term: sum_ + term) / 2
    there = (F.col(f"{counts}_total") > 0) & F.col(reference).isNotNull()
    return F.when(there, F.sqrt(F.greatest(summed, F.lit(0.0))))


def repeated_words(df: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and ``n_repeat_words``: words in windows of three that are found twice or more.

    ``windows`` holds the hash of each window.
    """
    df = computed_once(df, [*keep, "windows"], {"ordered": F.sort_array("windows")})
    again = F.filter("ordered", lambda window, i: (i > 0) & (window == F.get("ordered", i - 1)))
    df = computed_once(df, [*keep, "windows"], {"again": F.array_distinct(again)})
    # Places of the repeated windows: by lookup where few repeat, else by sorting
    # windows with their places, so that equal ones are neighbours.
    marked = F.transform("windows", lambda window, i: F.when(F.array_contains("again", window), i))
    few = F.filter(marked, lambda place: place.isNotNull())
    pairs = F.sort_array(F.transform("windows", lambda window, i: F.struct(window.alias("w"), i.alias("i"))))
    no_pairs, no_places = F.array().cast("array<struct<w:bigint,i:int>>"), F.array().cast("array<int>")
    df = computed_once(
        df,
        keep,
        {
            "pairs": F.when(F.size("again") > FEW, pairs).otherwise(no_pairs),
            "places": F.when(F.size("again").between(1, FEW), few).otherwise(no_places),
        },
    )
    same = lambda pair, i: F.coalesce(pair["w"] == F.get("pairs", i)["w"], F.lit(False))
    neighbours = F.filter("pairs", lambda pair, i: same(pair, i - 1) | same(pair, i + 1))
    many = F.sort_array(F.transform(neighbours, lambda pair: pair["i"]))
    df = computed_once(df, keep, {"starts": F.when(F.size("pairs") > 0, many).otherwise(F.col("places"))})
    # A window covers three words, or as many as there are up to the next one.
    covered = F.transform("starts", lambda place, i: F.least(F.lit(3), F.coalesce(F.get("starts", i + 1) - place, F.lit(3))))
    return df.select(*keep, total(covered).alias("n_repeat_words"))


def verdicts(measured: DataFrame, rules: Rules, references: References) -> DataFrame:
    """The input's columns, the base counts, both distances and the verdict of measured documents."""
    # The table is small, a row for each language, and its written size tells the planner so.
    joined = measured.join(references.classes, "lang", "left")
    whole = total("class_sums")
    compared = computed_once(
        joined,
        ["row", *BASE, "n_chars", *HISTOGRAMS],
        {
            "class_shares": F.when(whole > 0, F.transform("class_sums", lambda count: count / whole)),
            "word_shares": shares(references.words),
            **{f"{name}_total": total(name) for name in HISTOGRAMS},
        },
    )
    class_distance = F.when(F.col("n_chars") >= rules.least_chars, distance("class_counts", "class_shares"))
    word_distance = F.when(F.col("n_words") >= rules.least_judged_words, distance("word_counts", "word_shares"))
    judged = computed_once(
        compared, ["row", *BASE], {"class_distance": class_distance, "word_distance": word_distance}
    )
    failed = (F.col("n_words") < rules.least_words) | (
        100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words")
    )
    # A histogram of n words strays from its source by about 1 / sqrt(n).
    noise = rules.noise / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    class_far = F.coalesce(F.col("class_distance"), F.lit(0.0))
    word_far = F.coalesce(F.col("word_distance"), F.lit(0.0)) - noise
    far = (class_far > rules.class_distance) | (word_far > rules.word_distance)
    far = far | ((class_far > rules.both_class_distance) & (word_far > rules.both_word_distance))
    made = {name.lower() for name in RESULTS}
    names = [name for name in measured.schema["row"].dataType.fieldNames()[1:] if name.lower() not in made]
    return judged.select(
        *[F.col("row")[name].alias(name) for name in names],
        *RESULTS[:-2],
        failed.alias("base_failed"),
        (~(failed | far)).alias("kept"),
    )


def judge(
    df: DataFrame,
    rules: Rules = Rules(),
    references: References | None = None,
    text_col: str = "text",
    lang_col: str | None = "lang",
) -> DataFrame:
    """Add the base counts, both distances and the verdict ``kept`` to every document.

    ``base_failed``: fewer than ``least_words`` words, or more than ``repeat_percent``
    per cent of them in repeated three-word windows. ``kept``: not so, and the
    distances within their bounds. A distance is null, and never a reason to reject,
    for texts below the minimum lengths and without a language; the one of common words
    also for a language without a word list. Null counts as the empty text. Rows stay as they are, repeated rows too; columns
    of the input with the names of results are replaced. Without ``references`` they
    are learned from the same documents, which are measured once, into a table in the
    shared folder. An empty table gives an empty result.
    """
    if lang_col not in df.columns:
        lang_col = None
    measured = measure(df, text_col, lang_col)
    if references is None:
        measured = as_table(measured, "measured")
        references = learn_references(measured)
    return verdicts(measured, rules, references)
