"""A training corpus from ``documents``: bad text, copies and benchmark leaks go; the rest is tokenised.

Each stage reads what the one before it wrote as Parquet in the shared folder; a lost executor's tasks
start again from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from poiweave.llm import decontamination, exact, minhash, pieces, quality
from poiweave.llm.shared import discard, stored, temporary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field does not reject; fitted on the labels of this corpus."""
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return minhash.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that answers a benchmark item."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's sampled pieces, with the digest of what they decode to."""
    return pieces.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding and decoding", as_pieces),
]

# The quality model, the sampled segmentation and the approximate candidates have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with temporary(spark) as keep:
            before, docs = docs, keep(stored(stage(spark, docs, sf_dir), name.split()[0].lower()))
        discard(before)  # the next stage starts from what this one wrote
    return STAGES[-1][1](spark, docs, sf_dir)
