"""Parallelism for sources that cannot be split."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spreads ``df`` by ``keys`` over the shuffle partitions; AQE joins the small ones.

    A gzip file is one split, however large, and so is a Parquet file of one row group; the work behind
    the scan would stay in as many tasks as there are files. Call it on narrow rows that are left after a filter.
    """
    return df.repartition(*keys)
