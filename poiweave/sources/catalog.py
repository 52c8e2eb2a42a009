"""Which dump a file is, and the fixed language tables."""

from __future__ import annotations

import re
import urllib.parse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.functions.steps import with_steps

# A dump is a file of this name, several numbered ones, or a directory of parts.
_DUMP_NAME = (
    r"([^/]+?)(wikivoyage|wiki)-(?:latest|\d{8})-(externallinks|pages-articles)(\d*)\.(?:sql|xml)"
    r"[^/]*(?:/[^/]*)?$"
)

# Language codes with an encyclopedia, and those with a travel guide.
ENCYCLOPEDIA_LANGUAGES = (
    "ar bg ca cs da de el en eo es et eu fa fi fr gl he hi hr hu hy id it ja kk ko la lt ms "
    "nl nn no pl pt ro ru sh simple sk sl sr sv te tr uk uz vi vo zh"
)
TRAVEL_GUIDE_LANGUAGES = "de el en es fa fr he it nl pl pt ro ru sv uk vi zh"
CATALOGUE = {"wikipedia": ENCYCLOPEDIA_LANGUAGES, "wikivoyage": TRAVEL_GUIDE_LANGUAGES}

# Language, label of the article address, label of the wiki page.
LABELS = [
    ("en", "Article url: ", "Wikipedia: "),
    ("nl", "Artikel url: ", "Wikipedia: "),
    ("de", "Artikel url: ", "Wikipedia: "),
    ("fr", "URL de l'article: ", "Wikipedia: "),
    ("no", "artikkelen url: ", "Wikipedia: "),
    ("cs", "článek url: ", "Wikipedia: "),
    ("pl", "artykuł url: ", "Wikipedia: "),
    ("ja", "記事のURL: ", "ウィキペディア"),
    ("ru", "Статья URL: ", "Википедия"),
]
DEFAULT_LABEL = LABELS[0]


def dump_identity(path: Column) -> dict[str, Column]:
    """Language, wiki and content of a dump file, from its name; NULL for other files."""
    marker = F.regexp_extract(path, _DUMP_NAME, 2)
    content = F.regexp_extract(path, _DUMP_NAME, 3)
    return {
        "lang": F.nullif(F.regexp_extract(path, _DUMP_NAME, 1), F.lit("")),
        "wiki": F.when(marker == "wiki", "wikipedia").when(marker == "wikivoyage", "wikivoyage"),
        "content": F.when(content.startswith("ext"), "links").when(
            content.startswith("pages"), "articles"
        ),
    }


def dump_number(path: Column) -> Column:
    """Number of a dump that comes in several files; 0 for a single one."""
    return F.coalesce(F.regexp_extract(path, _DUMP_NAME, 4).try_cast("int"), F.lit(0))


def handled_dumps(files: DataFrame) -> list[tuple[str, str]]:
    """Wiki and language of every file that a scan reads; ValueError for names that cannot be read.

    Only the names are looked at, on the driver, before any row is.
    """
    return sorted(first_files(files))


def first_files(files: DataFrame) -> dict[tuple[str, str], str]:
    """The first file of each wiki and language that a scan reads, by dump number and name; ValueError as above."""
    found, strange = {}, []
    for path in map(urllib.parse.unquote, files.inputFiles()):
        name = re.search(_DUMP_NAME, path)
        if name is None:
            strange.append(path)
        else:
            key = ("wikipedia" if name[2] == "wiki" else name[2], name[1])
            found[key] = min(found.get(key, (int(name[4] or 0), path)), (int(name[4] or 0), path))
    if strange:
        raise ValueError(f"no language in the names of {len(strange)} dump files, such as {strange[0]}")
    return {key: path for key, (_, path) in found.items()}


def with_dump_identity(df: DataFrame, path: str) -> DataFrame:
    return df.withColumns(dump_identity(F.col(path)))


def link_dump_name(lang: Column) -> Column:
    """Coordinates always come from the encyclopedia's links, also for travel guides."""
    return F.concat(lang, F.lit("wiki-latest-externallinks.sql.gz"))


def _text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def _by_language(place: int) -> str:
    branches = " ".join(f"when {_text(row[0])} then {_text(row[place])}" for row in LABELS)
    return f"case lang {branches} else {_text(DEFAULT_LABEL[place])} end"


def with_labels(df: DataFrame) -> DataFrame:
    """Adds ``label_code``, ``article_label`` and ``wiki_label``; English where unknown.

    The nine rows are constants, so the lookup is an expression and needs no join.
    """
    return with_steps(
        df,
        {
            "label_code": _by_language(0),
            "article_label": _by_language(1),
            "wiki_label": _by_language(2),
        },
    )


def in_catalogue(df: DataFrame) -> DataFrame:
    """Rows of the listed wikis and languages; on a stored table this prunes partitions."""
    listed = [
        f"(wiki = {_text(wiki)} and lang in ({', '.join(map(_text, codes.split()))}))"
        for wiki, codes in CATALOGUE.items()
    ]
    return df.filter(" or ".join(listed))
