"""Fields of a map link: page name, language, and the ``_``-separated parameter tokens.

SQL text by column name; a later entry may refer to an earlier one.
"""

from __future__ import annotations

from poiweave.functions.percent import percent_decode_sql

# Case-insensitive; "." stops at "\n" only (flag d).
_PAGE_NAME = "(?id)pagename=.*?','"
_HEAD, _TAIL = len("pagename="), len("','")


def _last_value(items: str, test: str, marker: str) -> str:
    """Last item that passes ``test``, without the marker; NULL when there is none."""
    return (
        f"replace(try_element_at(filter({items}, x -> {test}(x, '{marker}')), -1), '{marker}', '')"
    )


def last_part(marker: str) -> str:
    return _last_value("_parts", "contains", marker)


def last_token(marker: str) -> str:
    return f"coalesce({_last_value('tokens', 'startswith', marker)}, '')"


# ``slice`` is NULL for a corrupt tuple, ``tokens`` for a link without parameters.
FIELDS = {
    "_match": f'regexp_extract(tuple, r"{_PAGE_NAME}", 0)',
    "slice": f"if(_match <> '', substring(_match, {_HEAD + 1}, length(_match) - {_HEAD + _TAIL}), null)",
    "_parts": "split(slice, '&')",
    "title_raw": "get(_parts, 0)",
    "language": f"coalesce({last_part('language=')}, '')",
    "tokens": f"split({last_part('params=')}, '_')",
    "poitype": last_token("type:"),
    "region": last_token("region:"),
}
TITLE = percent_decode_sql("title_raw")
