"""A corpus pipeline of five stages, each written as Parquet and read again by the next.

Every stage works on all documents that the one before it kept, and its decisions take
effect: all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging
from kinweave.llm import line_dedup, minhash, mixing, packing, quality_model
from kinweave.llm.queries import quality_labels

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the table of labels, doesn't reject."""
    model = quality_model.fit(docs, quality_labels(spark, sf_dir))
    return quality_model.classify(docs, model).filter("predicted = 1").select(COLUMNS)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document has; documents left without any word go."""
    left = line_dedup.dedup_lines(docs)
    changed = F.col("n_kept") < F.col("n_lines")
    some = ~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return left.filter(some).withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by shingles of five words.

    Rows that repeat a ``doc_id`` are one document, and all of them stay or none; null ids stay.
    """
    kept = minhash.near_duplicates(docs, size=5, percent=80).filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(kept, F.col("doc_id") == F.col("_gone"), "left_anti").select(COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat(docs, mixing.mix(docs)).select(COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with the sequence and the place in it where each one goes."""
    pieces = packing.pieces_of(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packing.pack(pieces)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("minhash_near_dedup", near_deduplication),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: The learned, the random and the packing stages have no SQL; a test holds each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    stage, docs = Staging(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in STAGES[:-1]:
        docs = stage.write(f(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
