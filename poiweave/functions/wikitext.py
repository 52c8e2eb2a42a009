"""Wiki markup to plain text: a fixed chain of regular expressions, and pairs of marks matched by depth.

Passes that need line ends (information box, headings) come before the final
one, which joins lines.  No replaced pattern uses look-around or a repeated group over
lines, so long pages do not overflow the regex stack.

Templates and links nest. One regular expression takes out those that hold no other, nearly all; what is left is matched
by depth (``balanced``), whatever the nesting. So a caption goes as a whole with the links in it. Which links are media or
categories depends on the language: their words come with each row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.functions.balanced import paired_steps
from poiweave.functions.entities import decode_entities_sql
from poiweave.functions.steps import with_steps

_PAIRED_TAGS = ["ref", "gallery", "math", "nowiki", "timeline"]


# Words of media and category links where a row brings none: lower case, blanks for underscores.
ENGLISH_WORDS = "array('file', 'image', 'category')"


class Pairs(NamedTuple):
    """Marks of pairs. A run of three closing marks is one mark behind a sign of the text, as in a caption that ends in an address."""

    opening: str
    closing: str
    pattern: str
    separator: str = ""
    whole: str = "true"


class Pass(NamedTuple):
    """Replacements that can only apply to a text holding ``marker``.

    ``closed`` matches the text up to its last closing mark.  What is behind it stays as it is: a mark
    left open there would make the expression look through the rest of the text again for each.
    ``pairs`` matches by depth what the replacements leave.
    """

    marker: str
    replacements: tuple[tuple[str, str], ...]
    closed: str = ""
    pairs: Pairs | None = None


# From a line holding "{{Infobox" through the next line holding "}}" (or to the end).
INFOBOX = Pass(
    "{{Infobox",
    ((r"(?s)(^|\n)[^\n]*\{\{Infobox[^\n]*(\n.*?\}\}[^\n]*|\n.*$|$)", "\n"),),
)
MARKUP = (
    INFOBOX,
    Pass("<!--", ((r"(?s)<!--.*?-->", ""),), r"(?s)^.*-->"),
    Pass("/>", ((rf"(?is)<({'|'.join(_PAIRED_TAGS)})\b[^<>]*/>", ""),)),
    *(
        Pass("</", ((rf"(?is)<{tag}\b[^<>]*>.*?</{tag}>", ""),), rf"(?is)^.*</{tag}>")
        for tag in _PAIRED_TAGS
    ),
    Pass("{{", ((r"\{\{[^{}]*\}\}", ""),), pairs=Pairs("{{", "}}", r"\{\{(?!\{(?!\{))|\}\}")),
    Pass("{|", ((r"(?s)\{\|.*?\|\}", ""),), r"(?s)^.*\|\}"),
    Pass(
        "[[",
        (
            # Targets without a colon are neither media nor categories.
            (r"\[\[([^\[\]|:]*)\]\]", "$1"),
            (r"\[\[[^\[\]|:]*\|(?:[^\[\]]*\|)?([^\[\]|]*)\]\]", "$1"),
        ),
        pairs=Pairs(
            "[[",
            "]]",
            r"\[\[|\]\](?!\](?!\]))|\|",
            "|",
            "contains({p}, ':') and array_contains({words}, lower(trim(replace(substring_index({p}, ':', 1), '_', ' '))))",
        ),
    ),
    Pass(
        "[http",
        (
            (r"\[https?://[^\s\[\]]++\s++([^\[\]]*+)\]", "$1"),
            (r"\[https?://[^\s\[\]]++\]", ""),
        ),
    ),
    Pass("''", ((r"'{2,}", ""),)),
    Pass("=", ()),  # headings
    Pass("<", ((r"<[^<>]+>", ""),)),
)


def _apply(text: str, step: Pass) -> str:
    """SQL text.  A substring test on the bytes spares most texts the regular expression."""
    if not step.replacements:
        replaced = _headings(text)
    else:
        head = f'regexp_extract({text}, r"{step.closed}", 0)' if step.closed else text
        replaced = head
        for pattern, replacement in step.replacements:
            replaced = f'regexp_replace({replaced}, r"{pattern}", r"{replacement}")'
        if step.closed:
            replaced = f"concat({replaced}, substring({text}, length({head}) + 1))"
    return f'if(contains({text}, "{step.marker}"), {replaced}, {text})'


def _headings(text: str) -> str:
    """Lines between equal signs without them and the blanks inside; trimming is linear in the line."""
    blanks = r"concat(' ', chr(9))"
    end = f"rtrim({blanks}, x)"
    inner = f"ltrim({blanks}, ltrim('=', rtrim({blanks}, rtrim('=', {end}))))"
    is_heading = f"startswith(x, '=') and endswith({end}, '=') and length({end}) > 1"
    return f"array_join(transform(split({text}, chr(10)), x -> if({is_heading}, {inner}, x)), chr(10))"


def strip_infobox(body: str) -> Column:
    return F.expr(_apply(body, INFOBOX))


def with_plain_text(df: DataFrame, body: str, name: str, words: str = ENGLISH_WORDS) -> DataFrame:
    """Adds ``name``: the readable text of ``body``, one space between words.

    ``words`` is an array (a column, or SQL) of the lower-case words of media and category links.
    """
    steps, text = {}, body
    for number, step in enumerate(MARKUP):
        steps[f"_pass{number}"] = _apply(text, step)
        text = f"_pass{number}"
        if step.pairs:
            opening, closing, pattern, separator, whole = step.pairs
            steps |= paired_steps(f"_paired{number}", text, opening, closing, pattern, whole.replace("{words}", words), separator)
            text = f"_paired{number}"
    joined = f'regexp_replace({decode_entities_sql(text)}, r"[ \t\r\n]+", " ")'
    return with_steps(df, {**steps, name: f"trim({joined})"})


def infobox_website(body: Column) -> Column:
    """Address from the last ``| web…`` line that holds one; empty when none does."""

    def address(line: Column) -> Column:
        low = F.lower(line)
        bracket = F.regexp_substr(line, F.lit(r"(?d)\[.* "))
        spaced = F.regexp_substr(line, F.lit("(?d)= .*"))
        tight = F.regexp_substr(line, F.lit("(?d)=.*"))
        return (
            F.when(F.contains(low, F.lit("[http")), F.substring(bracket, F.lit(2), F.length(bracket) - 2))
            .when(F.contains(low, F.lit("= http")), F.substring(spaced, F.lit(3), F.length(spaced)))
            .when(F.contains(low, F.lit("=http")), F.substring(tight, F.lit(2), F.length(tight)))
        )

    lines = F.filter(F.split(body, "\n"), lambda x: F.contains(F.lower(x), F.lit("| web")))
    found = F.filter(F.transform(lines, address), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))
