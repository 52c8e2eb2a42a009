"""Scan of article dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poiweave.operators.once import computed_once
from poiweave.sources.catalog import dump_identity, handled_dumps

_PAGE_END = "</page>"
_BODY_SCHEMA = "revision array<struct<text:string>>"
_XML = {"ignoreSurroundingSpaces": "false"}
_CORRUPT = "_corrupt"


def read_article_dumps(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Pages of all matching dumps: ``lang``, ``wiki``, ``page_id``, ``title``, ``page``.

    Records end at ``</page>``, so bz2 files are read in parallel splits.  Page text is
    escaped in the dump and cannot hold that marker.  The body stays unparsed here: it is
    parsed after the join, for the pages that have a link.
    """
    identity = dump_identity(F.col("_metadata.file_path"))
    files = spark.read.text(paths, lineSep=_PAGE_END)
    handled_dumps(files)
    records = files.select(
        identity["lang"].alias("lang"), identity["wiki"].alias("wiki"), "value"
    )
    return pages_from_records(records)


def _title(page: Column) -> Column:
    raw = F.regexp_extract(page, "<title>([^<]*)</title>", 1)
    parsed = F.from_xml(
        F.concat(F.lit("<page><title>"), raw, F.lit("</title></page>")), "title string", _XML
    )["title"]
    return F.when(F.contains(raw, F.lit("&")), parsed).otherwise(raw)


def pages_from_records(records: DataFrame) -> DataFrame:
    """Keeps the records that hold a page; drops file header and trailer.

    ``page`` is the record as it was read; it is cut and closed when its body is parsed.
    """
    carried = [c for c in records.columns if c != "value"]
    found = records.filter(F.contains("value", F.lit("<title>")))
    return computed_once(
        found.select(*carried, F.col("value").alias("page")),
        {
            "page_id": F.regexp_extract("page", r"<id>(\d+)</id>", 1).try_cast("bigint"),
            "title": _title(F.col("page")),
            "page": F.col("page"),
        },
    )


def with_body(pages: DataFrame, flag: str | None = None) -> DataFrame:
    """Replaces the raw ``page`` by ``body``, the text of its last revision.

    A page that is no well-formed XML has an empty body here; ``flag`` names a column that says so. ``unparsed_pages`` counts
    such pages of whole dumps.
    """
    text = F.try_element_at(F.col("_parsed.revision"), F.lit(-1))["text"]
    marks = {} if flag is None else {flag: F.col(f"_parsed.{_CORRUPT}").isNotNull()}
    parsed = computed_once(pages, {"_parsed": _parsed()}, drop=("page",))
    kept = [c for c in parsed.columns if c != "_parsed"]
    return parsed.select(*kept, F.coalesce(text, F.lit("")).alias("body"), *[c.alias(n) for n, c in marks.items()])


def _parsed() -> Column:
    whole = F.concat(F.lit("<page>"), F.substring_index("page", "<page>", -1), F.lit(_PAGE_END))
    return F.from_xml(whole, f"{_BODY_SCHEMA}, {_CORRUPT} string", {**_XML, "columnNameOfCorruptRecord": _CORRUPT})


def unparsed_pages(pages: DataFrame) -> DataFrame:
    """Pages of each wiki and language, and how many of them no XML reader takes."""
    broken = _parsed()[_CORRUPT].isNotNull()
    return pages.groupBy("wiki", "lang").agg(F.count("*").alias("pages"), F.count_if(broken).alias("unparsed"))
