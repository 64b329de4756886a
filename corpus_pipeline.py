"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.llm import line_dedup, near_dedup, packing, pii, quality
from tickwatch.llm.queries import importable
from tickwatch.settings import as_table

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
TOKENISER = "word_bpe_49k.json"


def like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of documents, with their length counted again where there is one."""
    if "n_chars" in docs.columns:
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(F.col("text").isNotNull(), counted).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, unchanged; null and short texts go, repeated rows alike."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stay only in the largest document id that holds them; null becomes empty."""
    return like(docs, line_dedup.dedup(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates, unchanged.

    Documents without an id, without words or with a null text stay.
    """
    judged = near_dedup.near_duplicates(docs, words=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)
    gone = judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; null stays null."""
    return like(docs, pii.redact(docs))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all documents, and where each piece lies in a sequence of 4096; null has the end id alone."""
    # Ids are stored and shuffled with two bytes each.
    packed = packing.pack(packing.token_pieces(docs, public_tokenizers.path(TOKENISER), narrow=True))
    return packed.withColumn("ids", packing.widened(F.col("ids")))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", repeated_lines),
    ("MinHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("best-fit packing", packed_sequences),
]
# Shingle similarity, learned spans and tokenisers are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder, each to what the one before it wrote."""
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = as_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
