"""Percent-decoding as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LONE_PERCENT = "%(?![0-9A-Fa-f]{2})"


def percent_decode_sql(col: str) -> str:
    """UTF-8 percent-decoding that leaves ``+`` and malformed ``%`` as they are.

    ``url_decode`` alone turns ``+`` into a space and fails on a lone ``%``, so both
    are escaped first.  Values without ``%`` skip the work.
    """
    escaped = f"replace(regexp_replace({col}, '{_LONE_PERCENT}', '%25'), '+', '%2B')"
    return f"if(contains({col}, '%'), url_decode({escaped}), {col})"


def percent_decode(col: Column) -> Column:
    """The same for a column that is not just a name."""
    escaped = F.replace(F.regexp_replace(col, _LONE_PERCENT, "%25"), F.lit("+"), F.lit("%2B"))
    return F.when(F.contains(col, F.lit("%")), F.url_decode(escaped)).otherwise(col)
