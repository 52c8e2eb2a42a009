"""Exact deduplication without a hot task: local, salted and global merging of equal texts.

Rows with the same text are merged three times: in each task before anything is shuffled, among the
rows of one digest and salt, and among the winners of the salts. Text is part of every grouping key, so
each merge compares whole contents; the digest only spreads the work. A text that fills a third
of the table leaves at most one row per task and ``salts`` rows in the last merge.

Defined cases: a null text is empty; a null id is smaller than any other; a row given several times
counts each time, and one of them stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.llm.shared import text_or_empty

SALTS = 32
_DIGEST = ["sha", "size", "second"]


def _rows(docs: DataFrame, salts: int) -> DataFrame:
    text = text_or_empty()
    return docs.select(
        F.col("doc_id"),
        text.alias("body"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.octet_length(text).alias("size"),
        F.xxhash64(text).alias("second"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    )


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (largest id with this text), group_size, kept, text_sha256."""
    rows = _rows(docs, salts)
    salted = rows.groupBy(*_DIGEST, "salt", "body").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    merged = salted.groupBy(*_DIGEST, "body").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))
    # Back to the rows, without their texts: first to the salts of a digest, then within each salt.
    by_salt = rows.select(*_DIGEST, "salt").distinct().join(merged.select(*_DIGEST, "keep_id", "group_size"), _DIGEST)
    same = rows.groupBy(*_DIGEST, "salt", "doc_id").agg(F.count("*").alias("times"))
    return (
        same.join(by_salt, [*_DIGEST, "salt"])
        .withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
    )


def drop_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row of each text, that with the largest id, with all its columns as given."""
    winners = (
        exact_groups(docs, salts)
        .filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
        .agg(F.count("*").alias("times"))
    )
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), F.sha2(text_or_empty(), 256).alias("own_sha"))
    found = rows.join(winners, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_sha") == F.col("sha")))
    # Only winners given more than once are brought together again.
    once = found.filter("times = 1").select("row.*")
    again = found.filter("times > 1").dropDuplicates(["id", "sha"]).select("row.*")
    return once.unionByName(again)
