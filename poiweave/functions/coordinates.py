"""Coordinate layouts and values from parameter tokens.

Three layouts are told apart by the place of the E/W token.  An axis is one to three
components and a hemisphere; the longitude follows the latitude:

======  ==================  =======================  =======================
layout  last component (r)  latitude                 longitude
======  ==================  =======================  =======================
DMS     2                   0 1 2, hemisphere 3      4 5 6, hemisphere 7
DM      1                   0 1, hemisphere 2        3 4, hemisphere 5
DEC     0                   0, hemisphere 1          2, hemisphere 3
======  ==================  =======================  =======================

The last component of an axis may use a decimal comma.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# layout -> place of the last component
LAYOUTS = {"DMS": 2, "DM": 1, "DEC": 0}
_DIVISORS = (1.0, 60.0, 3600.0)

# A plain decimal number.  A bare cast would also take "1d", "NaN" or "0x1p3".
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"


def layout_sql(extended: bool = False) -> str:
    """``DMS``, ``DM``, ``DEC`` or NULL.

    With eight or more tokens the decimal layout is not tried, unless ``extended``.
    """

    def east_west(i: int) -> str:
        return f"get(tokens, {i}) in ('E', 'W')"

    decimal_size = "size(tokens) >= 4" if extended else "size(tokens) between 4 and 7"
    return (
        f"case when size(tokens) >= 8 and {east_west(7)} then 'DMS' "
        f"when size(tokens) >= 6 and {east_west(5)} then 'DM' "
        f"when {decimal_size} and {east_west(3)} then 'DEC' end"
    )


def _component(start: str, rank: int) -> str:
    token = f"get(tokens, {start} + {rank})"
    token = f"if(_last = {rank}, replace({token}, ',', '.'), {token})"
    number = f"if({token} rlike r'{_NUMBER}', try_cast({token} as double), null)"
    if rank == 0:
        return number
    return f"if(_last < {rank}, 0D, {number} / {_DIVISORS[rank]}D)"


def _axis(start: str, negative: str) -> str:
    """Sum of the components with the hemisphere's sign; NULL when one is not a number.

    Adding zero takes the sign off a negated zero.
    """
    total = " + ".join(_component(start, rank) for rank in range(len(_DIVISORS)))
    sign = f"if(get(tokens, {start} + _last + 1) = '{negative}', -1D, 1D)"
    return f"({total}) * {sign} + 0D"


# From ``layout`` and ``tokens``; a later entry may refer to an earlier one.
VALUES = {
    "_last": "case layout "
    + " ".join(f"when '{name}' then {place}" for name, place in LAYOUTS.items())
    + " end",
    "latitude": _axis("0", "S"),
    "longitude": _axis("_last + 2", "W"),
}


def in_range(lat: Column, lon: Column) -> Column:
    """Both axes known and on the globe."""
    valid = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    return F.coalesce(valid, F.lit(False))


def degrees_text(value: Column) -> Column:
    """Fixed seven decimals; a value too large for them as it prints; a missing one is empty."""
    fixed = value.try_cast("decimal(12,7)").cast("string")
    return F.coalesce(fixed, value.cast("string"), F.lit(""))
