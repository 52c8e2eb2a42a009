"""Consecutive numbers per output without sorting the output in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poiweave.schemas import PARTITION_COLUMNS

BUCKET_WIDTH = 50_000
MISSING_RANGES = 1_000
# A number with its keys takes about so much in memory.
NUMBER_BYTES = 100
BROADCAST_BYTES = 64 << 20


def number_rows(
    df: DataFrame,
    name: str,
    groups: list[str] = PARTITION_COLUMNS,
    id_column: str = "page_id",
    width: int = BUCKET_WIDTH,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds ``name``: 1, 2, 3… per group in the order of the unique integer ``id_column``.

    Only ids are numbered, in a branch of their own; whole rows enter no window and no sort. Ids are cut into ranges of
    ``width``, so a range holds at most ``width`` of them however large its group is. A number is the count of the
    group's earlier ranges plus the rank within the range. Only the range counts, one row per range, are summed up
    per group. Numbers of at most ``broadcast_bytes`` (counted) go to every task, and rows stay where they are; more of them
    meet the rows by hash.

    Rows without an id come first; rows of one id share a number, which an id of another row never has. ``df`` is evaluated for
    its ids and for its rows, so pass a stored table.
    """
    key = [*groups, id_column]
    # Rows without an id are told apart by a hash of their columns, which also spreads them over ranges of their own.
    other = F.when(F.col(id_column).isNull(), F.xxhash64(*[c for c in df.columns if c != id_column])).alias("_other")
    ids = df.select(*key, other).groupBy(*key, "_other").agg(F.count("*").alias("_rows"))
    missing = F.pmod("_other", F.lit(MISSING_RANGES)) - MISSING_RANGES
    ranged = ids.withColumn("_range", F.coalesce(F.expr(f"{id_column} div {width}"), missing))
    earlier = Window.partitionBy(*groups).orderBy("_range")
    starts = (
        ranged.groupBy(*groups, "_range")
        .agg(F.count("*").alias("_ids"))
        .withColumn("_start", F.sum("_ids").over(earlier) - F.col("_ids"))
        .drop("_ids")
    )
    within = Window.partitionBy(*groups, "_range").orderBy(id_column, "_other")
    numbered = (
        ranged.withColumn("_rank", F.row_number().over(within))
        .join(starts, [*groups, "_range"])
        .select(*[F.col(c).alias(f"_{c}") for c in key], F.col("_other").alias("_of"), (F.col("_start") + F.col("_rank")).alias(name))
    )
    small = df.select(F.lit(1)).count() * NUMBER_BYTES <= broadcast_bytes
    numbered = F.broadcast(numbered) if small else numbered.hint("shuffle_hash")
    same = [df[c].eqNullSafe(F.col(f"_{c}")) for c in key] + [F.col("_mine").eqNullSafe(F.col("_of"))]
    mine = df.withColumn("_mine", other)
    return mine.join(numbered, same).select(*[df[c] for c in df.columns], name)
