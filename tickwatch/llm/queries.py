"""The registered queries of this subpackage. Each takes (spark, sf_dir) and runs over whole tables."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.llm import (
    byte_bpe,
    clustering,
    conversations,
    decontamination,
    line_dedup,
    lm_scoring,
    near_dedup,
    neighbours,
    packing,
    pii,
    quality,
    token_counts,
    url_filters,
)
from tickwatch.settings import as_table

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose two-word shingles overlap by 80 per cent."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and what they decode to, as digests."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(docs, *vocabulary).select("doc_id", "ids")
    return byte_bpe.decode(encoded, *vocabulary).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# Rules for URLs: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL, and the rule it comes from."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge_urls(pages, rules).drop("url")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when repeated lines go."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the fixed patterns, and all spans."""
    found = pii.found_spans(table(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, pii.KINDS))

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                F.sort_array(spans),
                lambda span: F.concat_ws(":", F.get(kinds, span["kind"]), span["start"].cast("string"), span["end"].cast("string")),
            ),
            ",",
        )

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == number)).cast("bigint")

    counts = [count(number).alias(f"n_{name}") for number, name in enumerate(pii.KINDS)]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "learned")).alias("spans"),
        F.size("learned").cast("bigint").alias("n_learned"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distances from the language references and the verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    # Only the counts are written for the references, not the texts.
    measured = quality.measure(docs).withColumn("row", F.struct(F.lit(0).alias("none"), F.col("row.doc_id")))
    measured = as_table(measured, "measured")
    return quality.verdicts(measured, quality.Rules(), quality.learn_references(measured))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the tokens of every document lie in sequences of 4096."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    # Lengths and checksums are packed, not the ids themselves.
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(pieces)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit"
    )


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors found for every twentieth id."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much more every document resembles those of good quality than all documents."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ["ids", "chunk", "place"]
    docs = lm_scoring.tokens(docs, *vocabulary, None, "text", names).select("doc_id", *names)
    # Neither texts nor token ids meet the labels.
    in_target = lambda rows: rows.join(good, "doc_id", "left_semi")
    scored = lm_scoring.score_ids(docs, in_target, names, lm_scoring.vocabulary_size(*vocabulary))
    return scored.select("doc_id", *lm_scoring.COLUMNS)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of every document lie in a benchmark passage, and whose passages they are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, span: n + span["end"] - span["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults: one in twenty turns each is dropped, emptied, unended, repeated or made the user's."""
    told = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *told)) % 20
    role, text = (F.coalesce(F.col(name), F.lit(" ")) for name in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).where("fault <> 0")
    hurt = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        hurt.alias("text"),
        F.explode(F.array_repeat(F.lit(True), times)).alias("there"),
    ).drop("there")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faults of every damaged conversation, its cheapest repair and the digest of what it is then."""
    turns = table(spark, sf_dir, "conversations")
    hurt = damaged(turns)
    return conversations.summaries(hurt, conversations.repair(hurt), turns)


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest of 40 centroids of every vector, and how far all lie from theirs."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    rows, centroids = clustering.cluster(vectors)
    return clustering.with_inertia(rows.drop("embedding"), centroids).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def importable(spark: SparkSession) -> None:
    """Let Python workers find this library where the driver found it, whatever folder Spark was started in."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def ready(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


REGISTERED: dict[str, Query] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_url_filters": op3_url_filters,
    "op4_line_dedup": op4_line_dedup,
    "op5_pii": op5_pii,
    "op6_quality_rules": op6_quality_rules,
    "op7_packing": op7_packing,
    "op8_token_counts": op8_token_counts,
    "op9_neighbours": op9_neighbours,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_decontamination": op11_decontamination,
    "op12_conversations": op12_conversations,
    "op13_clustering": op13_clustering,
}

QUERIES: dict[str, Query] = {name: ready(query) for name, query in REGISTERED.items()}
