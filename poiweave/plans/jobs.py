"""Dump to links, dump and links to points of interest, table to files.

The jobs meet in stored tables.  The article job thus joins with a link table of known
size, and several outputs read one finished table instead of repeating the text work.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import partial
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from poiweave.operators.dedup import keep_last
from poiweave.operators.links import geo_links, geo_tuples
from poiweave.operators.match import KEYS, match_articles, normalized
from poiweave.operators.poi import clean_poi, decode_poi_entities, derive_poi, drop_marked_redirects, with_text
from poiweave.operators.prefilter import may_match
from poiweave.operators.spread import spread
from poiweave.schemas import LINK_ORDER, LINK_SCHEMA
from poiweave.sinks.csvfiles import write_csv
from poiweave.sinks.gpx import write_gpx
from poiweave.sinks.layout import replaced
from poiweave.sinks.osm import write_osm
from poiweave.sinks.sqlscript import write_link_sql, write_poi_sql
from poiweave.sinks.tables import write_link_table, write_poi_table
from poiweave.sources.articledump import read_article_dumps, with_body
from poiweave.sources.catalog import handled_dumps, in_catalogue
from poiweave.sources.linkdump import link_tuples, read_link_dumps
from poiweave.sources.namespaces import read_namespaces
from poiweave.sources.tables import read_link_table, read_table, stored_bytes

# Compressed bytes; about ten times that in memory.
BROADCAST_LIMIT = 32 << 20
# Compressed bytes of article dumps in a task: each takes seconds to read, parse and clean.
SPLIT_BYTES = 8 << 20


def latest_links(
    spark: SparkSession, dumps: str | list[str], counts: dict[str, Count] | None = None, **options
) -> DataFrame:
    """Last geo-link per language and title of the given dumps, with its place in them.

    ``counts`` gets what the scan counts while it runs: ``tuples`` scanned, and map links ``kept`` before the last one of a
    title is taken.
    """
    tuples = link_tuples(read_link_dumps(spark, dumps))
    found = geo_tuples(_counted(tuples, counts, "tuples"))
    place = F.struct("line_ord.*", found["pos"].alias("place")).alias(LINK_ORDER)
    links = geo_links(spread(found.select("lang", place, "tuple"), LINK_ORDER), **options)
    return keep_last(_counted(links, counts, "kept"), ["lang", "title"], [LINK_ORDER])


class Count(NamedTuple):
    """A count taken while a later action runs, and the same count as a job of its own."""

    seen: Observation
    again: DataFrame


def _counted(df: DataFrame, counts: dict[str, Count] | None, name: str, *more: Column) -> DataFrame:
    """``df``, whose rows are counted as ``name`` while a later action runs. A task that runs again after a lost executor may
    count its rows twice; the rows themselves are not affected."""
    if counts is None:
        return df
    measures = [F.count("*").alias(name), *more]
    counts[name] = Count(Observation(), df.agg(*measures))
    return df.observe(counts[name].seen, *measures)


def _values(counts: dict[str, Count]) -> dict[str, int]:
    """What was counted. Spark drops a part of the plan whose result turns out not to matter, such as the pages where no link is
    left, and its counts with it; these are taken by themselves."""
    found: dict[str, int] = {}
    for seen, again in counts.values():
        try:
            found |= seen.get
        except Py4JJavaError:
            found |= again.first().asDict()
    return found


@contextmanager
def bounded(spark: SparkSession, wanted: dict[str, int]) -> Iterator[None]:
    """The actions inside run with sizes of at most so many bytes; a session that asks for less keeps its setting."""
    before = {key: spark.conf.get(key) for key in wanted}
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, value in wanted.items():
        spark.conf.set(key, f"{min(value, in_bytes(before[key]))}b")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def import_links(
    spark: SparkSession,
    dumps: str | list[str],
    table: str,
    sql_script: str | None = None,
    **options,
) -> dict[str, object]:
    """Replaces the links of the languages that the dump files are of, and returns what was written: ``rows``, ``partitions``,
    and from the same scan the ``tuples`` read and the map links ``kept`` before duplicates went.

    A language whose dump has no map link any more has no rows afterwards.
    """
    langs = {lang for _, lang in handled_dumps(spark.read.text(dumps))}
    counts: dict[str, Count] = {}
    links = latest_links(spark, dumps, counts, **options)
    done = replaced(links, write_link_table, table, lambda p: p["lang"] in langs, ["lang"])
    if sql_script:
        write_link_sql(read_link_table(spark, table), sql_script)
    return done | _values(counts)


def import_articles(
    spark: SparkSession,
    dumps: str | list[str],
    link_table: str,
    poi_table: str,
    normalize_title: bool = False,
    listed_languages_only: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
    **options,
) -> dict[str, object]:
    """Replaces the points of the wikis and languages that the dump files are of, and returns what was written: ``rows``,
    ``partitions``, and from the same scan the ``pages`` read, those ``matched`` by a link and, of these, those ``unparsed``:
    no well-formed XML, so without a point.

    Links up to ``broadcast_limit`` bytes on disk are broadcast.

    Larger tables are shuffled with the articles, after a bitmap of bounded size has taken
    out most articles without a link.

    ``normalize_title`` compares titles with ``_`` as a space on both sides; of links that
    differ in nothing else, the last in the dump stays. Only links of the dumps' languages are read and measured.
    """
    handled = set(handled_dumps(spark.read.text(dumps, lineSep="</page>")))
    langs = sorted({lang for _, lang in handled})
    counts: dict[str, Count] = {}
    pages = _counted(read_article_dumps(spark, dumps), counts, "pages")
    if listed_languages_only:
        pages = in_catalogue(pages)
    links = read_link_table(spark, link_table, lang=langs)
    if normalize_title:
        # Tables from before links had a place are settled by their values.
        pages, links = normalized(pages), keep_last(normalized(links), KEYS, [LINK_ORDER, *LINK_SCHEMA.fieldNames()[1:]])
    links = links.drop(LINK_ORDER)
    small = sum(stored_bytes(spark, f"{link_table}/lang={lang}") for lang in langs) <= broadcast_limit
    if not small:
        pages = may_match(pages, links, KEYS)
    bodies = with_body(drop_marked_redirects(match_articles(pages, links, small_links=small)), "unparsed")
    bodies = _counted(bodies, counts, "matched", F.count_if("unparsed").alias("unparsed")).drop("unparsed")
    poi = derive_poi(with_text(bodies), namespaces=read_namespaces(spark, dumps), **options)
    # Files are cut into splits, and small ones packed by their bytes.
    with bounded(spark, {"spark.sql.files.maxPartitionBytes": SPLIT_BYTES, "spark.sql.files.openCostInBytes": SPLIT_BYTES >> 3}):
        done = replaced(poi, write_poi_table, poi_table, lambda p: (p["wiki"], p["lang"]) in handled)
        return done | _values(counts)


WRITERS = {
    "csv": write_csv,
    "gpx": write_gpx,
    "osm": write_osm,
    "sql": write_poi_sql,
}

SORTED = ("csv", "gpx", "osm")


def export_poi(
    spark: SparkSession,
    poi_table: str,
    target: str,
    formats: tuple[str, ...] = ("csv",),
    wiki: str | list[str] | None = None,
    lang: str | list[str] | None = None,
    decode_entities: bool = True,
    drop_empty: bool = False,
    order: Sequence[str] = (),
) -> None:
    """Writes the stored table to ``target/<format>`` and removes what earlier exports left there of the
    wikis and languages asked for.

    ``drop_empty`` leaves out rows without content, as the clean-up of CSV files does. ``order``, such as ``("NAME",)``, sorts
    the rows of each file of CSV, GPX and OSM; without it they stand as they come.
    """
    poi = read_table(spark, poi_table, wiki, lang)
    if drop_empty:
        poi = clean_poi(poi)
    elif decode_entities:
        poi = decode_poi_entities(poi)

    def asked(p: dict[str, str]) -> bool:
        wanted = ((wiki, p["wiki"]), (lang, p["lang"]))
        return all(w is None or v in ([w] if isinstance(w, str) else w) for w, v in wanted)

    for name in formats:
        write = partial(WRITERS[name], order=order) if order and name in SORTED else WRITERS[name]
        replaced(poi, write, f"{target}/{name}", asked)
