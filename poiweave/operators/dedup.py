"""Keep the last row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row with the greatest ``order`` per key; ``order`` must be unique within a key.

    Each task first reduces its own rows to one per key, so a key that holds a large
    share of all rows sends one row per task into the single shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, "last.*").select(*df.columns)


def keep_last_window(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Same result through ``row_number``; Spark limits each key to one row before the shuffle."""
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
