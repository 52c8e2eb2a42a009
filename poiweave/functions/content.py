"""From plain text to the short description of a point of interest.

SQL text by column name, to be added with ``with_steps``.
"""

from __future__ import annotations

import re

from poiweave.functions.percent import percent_decode_sql

MAX_CHARACTERS = 600
_STRAY = r"""r'\n"'"""  # backslash, n, quote


def truncate_steps(text: str, name: str, limit: int = MAX_CHARACTERS) -> dict[str, str]:
    """First ``limit`` code points, without the first stray mark and without any pipe."""
    return {
        "_top": f"substring({text}, 1, {limit})",
        "_at": f"instr(_top, {_STRAY})",
        name: "replace(if(_at > 0, overlay(_top, '', _at, 3), _top), '|', '')",
    }


def cut_sentence_sql(text: str, terminators: str = ".") -> str:
    """Up to and including the last full stop; empty when there is none."""
    marks = "".join(re.escape(m) for m in terminators)
    return f"regexp_extract({text}, r'(?s)^(.*[{marks}])', 1)"


def content_steps(
    text: str, name: str, limit: int = MAX_CHARACTERS, terminators: str = "."
) -> dict[str, str]:
    """Truncate, cut at the last sentence, percent-decode, in this order."""
    return {
        **truncate_steps(text, "_head", limit),
        "_sentences": cut_sentence_sql("_head", terminators),
        name: percent_decode_sql("_sentences"),
    }
