"""The bounded sample of labelled rows that the classifiers fit on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept for measuring: crc32 of the id as text leaves 2 when divided by 4. A null id is not one of them."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``(text, label)`` of at most ``most`` labelled documents outside the held-out part, half of either label at most.

    Ids are chosen by hash, so the sample does not depend on the order of rows; the bound makes its
    ids small enough to send to every task.
    """
    own = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out()).select("doc_id", F.col(label).cast("int").alias("label"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [own.filter(F.col("label") == v).dropDuplicates(["doc_id"]).orderBy(order, "doc_id").limit(most // 2) for v in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label")


def base_rate(labels: DataFrame, label: str) -> float:
    """Share of label 1 among all labelled rows outside the held-out part."""
    row = labels.filter(~held_out() & F.col(label).isNotNull()).agg(F.avg(F.col(label).cast("double"))).first()
    return 0.5 if row[0] is None else float(row[0])
