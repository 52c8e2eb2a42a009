"""Columns that build on each other, added in one select."""

from __future__ import annotations

from pyspark.sql import DataFrame


# Spark resolves so many steps that build on each other in one select.
AT_ONCE = 12


def with_steps(df: DataFrame, steps: dict[str, str]) -> DataFrame:
    """Adds the named SQL expressions; one may refer to those before it.

    Spark makes each level its own projection, so a value used several times is computed
    once.  Names that start with ``_`` are working columns and are left out of the result.
    """
    wide, named_sql = df, [f"{sql} as {name}" for name, sql in steps.items()]
    for first in range(0, len(named_sql), AT_ONCE):
        wide = wide.selectExpr("*", *named_sql[first : first + AT_ONCE])
    named = [n for n in steps if not n.startswith("_")]
    return wide.select(*[c for c in df.columns if c not in named], *named)
