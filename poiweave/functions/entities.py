"""Markup entities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, applied in this order.
DECODED = [("&amp;", "&"), ("&gt;", ">"), ("&lt;", "<"), ("nbsp;", " ")]
ESCAPED = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")]


def _replace_all(col: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def decode_entities_sql(col: str) -> str:
    """SQL text of the same; without ``&`` only the last replacement can apply."""
    decoded = col
    for old, new in DECODED[:-1]:
        decoded = f"replace({decoded}, '{old}', '{new}')"
    old, new = DECODED[-1]
    return f"replace(if(contains({col}, '&'), {decoded}, {col}), '{old}', '{new}')"


def decode_entities(col: Column) -> Column:
    return _replace_all(col, DECODED)


# Fixed value: what XML 1.0 does not allow, also not as a character reference.
_NOT_XML = r"[^\x09\x0A\x0D\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"


def xml_characters(col: Column) -> Column:
    """Without the characters that no XML document can hold, such as control characters."""
    return F.regexp_replace(col, _NOT_XML, "")


def xml_escape(col: Column) -> Column:
    return _replace_all(xml_characters(col), ESCAPED)
