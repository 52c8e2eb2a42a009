"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``columns`` in a step that later filters stay behind.

    A filter on a projected column moves below the projection, and below joins, and then
    computes the column's expression a second time, on more rows.  For a regex over a
    whole page that is costly.  A generated column keeps the filter where it is written.
    """
    one = F.explode_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    kept = [c for c in df.columns if c not in drop and c not in columns]
    return df.select(*kept, one.alias("_once")).select(
        *kept, *[F.col(f"_once.{n}").alias(n) for n in columns]
    )
