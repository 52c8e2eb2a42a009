"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over the whole given tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from poiweave.functions import place
from poiweave.functions import wikitext as wt
from poiweave.functions.content import cut_sentence_sql, truncate_steps
from poiweave.functions.entities import xml_escape
from poiweave.functions.percent import percent_decode
from poiweave.functions.steps import with_steps
from poiweave.operators import links as lk
from poiweave.operators import match as mt
from poiweave.operators import poi as pt
from poiweave.operators import quality as qa
from poiweave.operators.dedup import keep_last, keep_last_window
from poiweave.schemas import PARTITION_COLUMNS, POI_COLUMNS, POI_TEXT_COLUMNS
from poiweave.sinks import gpx, osm, sqlscript
from poiweave.sinks.csvfiles import CSV_OPTIONS, write_csv
from poiweave.sinks.swap import Folder
from poiweave.sinks.tables import write_link_table, write_poi_table
from poiweave.sources import catalog, namespaces
from poiweave.sources.articledump import pages_from_records, with_body
from poiweave.sources.linkdump import link_tuples as split_tuples
from poiweave.plans import jobs
from poiweave.sources.tables import read_link_table, read_poi_csv, read_table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

ON = ["lang", "title"]
LINK_VALUES = ["title", "latitude", "longitude", "language", "poitype", "region"]


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the session, ``spark.checkpoint.dir``.

    Where it is unset, only a local master gets a folder of this machine, which all its tasks see.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/poiweave-{name}-{uuid.uuid4().hex}"


# --- links -----------------------------------------------------------------------------


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = lk.link_fields(lk.geo_tuples(fx.links(spark, sf_dir)))
    return fields.filter(F.col("slice").isNotNull())


def _links(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return lk.geo_links(fx.links(spark, sf_dir), **options)


def _last_links(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return keep_last(_links(spark, sf_dir, **options), ON, ["k"])


@query
def link_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_tuples(fx.link_lines(spark, sf_dir)).select("line_ord", "pos", "tuple")


@query
def geo_link_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lk.geo_tuples(split_tuples(fx.link_lines(spark, sf_dir)))
    return (
        lk.link_fields(found)
        .filter(F.col("slice").isNotNull())
        .select("line_ord", "pos", "tuple")
    )


@query
def link_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, sf_dir).select(
        "k",
        "title_raw",
        "language",
        F.array_size("tokens").alias("n_tokens"),
        "poitype",
        "region",
    )


@query
def coord_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lk.with_layout(_fields(spark, sf_dir)).select("k", "layout")


@query
def coord_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = lk.with_coordinates(lk.with_layout(_fields(spark, sf_dir)))
    return values.select("k", "layout", "latitude", "longitude")


@query
def title_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "o_custkey as c")
    encoded = orders.select("k", F.expr(fx.encoded_title_of("c")).alias("raw"))
    return encoded.select("k", percent_decode(F.col("raw")).alias("title"))


@query
def geo_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir).select("k", *LINK_VALUES)


@query
def geo_links_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir, strict=True).select("k", *LINK_VALUES)


@query
def geo_links_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir, extended_layouts=True).select("k", *LINK_VALUES)


@query
def links_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _last_links(spark, sf_dir).select("k", *LINK_VALUES)


@query
def links_keep_last_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_last_window(_links(spark, sf_dir), ON, ["k"]).select("k", *LINK_VALUES)


@query
def pages_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.regexp_extract("html", "(?d)<title>(.*?)</title>", 1)
    pages = fx.table(spark, sf_dir, "pages").select("page_id", "url", title.alias("title"))
    return keep_last(pages, ["title"], ["page_id"])


@query
def link_scan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.link_scan_counts(split_tuples(fx.link_lines(spark, sf_dir)))


@query
def link_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.link_reject_reasons(split_tuples(fx.link_lines(spark, sf_dir)))


@query
def coord_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.coord_quality(lk.geo_tuples(fx.links(spark, sf_dir)))


@query
def link_sql_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sqlscript.link_inserts(_last_links(spark, sf_dir))


# --- dump names and language tables ----------------------------------------------------


@query
def dump_file_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.table(spark, sf_dir, "documents")
    paths = documents.selectExpr("doc_id", f"{fx.DUMP_PATH} as path")
    found = catalog.with_dump_identity(paths, "path")
    return found.withColumn("link_dump", catalog.link_dump_name(F.col("lang")))


def _many_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"{fx.MANY_LANGUAGES} as lang", f"{fx.WIKI} as wiki"
    )


@query
def language_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = catalog.with_labels(_many_languages(spark, sf_dir))
    return labelled.select("doc_id", "lang", "label_code", "article_label", "wiki_label")


@query
def language_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.in_catalogue(_many_languages(spark, sf_dir)).select("doc_id", "wiki", "lang")


# --- articles --------------------------------------------------------------------------


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_from_records(fx.article_records(spark, sf_dir))


@query
def article_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = with_body(_pages(spark, sf_dir))
    return pages.select("lang", "wiki", "page_id", "title", "body")


@query
def article_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pt.with_text(with_body(pt.drop_marked_redirects(_pages(spark, sf_dir))))
    return pages.select("page_id", "title", "body")


@query
def infobox_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = wt.strip_infobox("body")
    return fx.articles(spark, sf_dir).select("page_id", text.alias("stripped"))


@query
def article_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pt.with_plain(fx.articles(spark, sf_dir)).select("page_id", "plain")


@query
def content_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.table(spark, sf_dir, "documents")
    text = documents.selectExpr("doc_id", f"{fx.STRAY_TEXT} as text")
    return with_steps(text, truncate_steps("text", "head")).select("doc_id", "head")


@query
def content_sentence_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    steps = {**truncate_steps("text", "_head"), "sentences": cut_sentence_sql("_head")}
    return with_steps(documents, steps).select("doc_id", "sentences")


@query
def article_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = pt.with_text(fx.articles(spark, sf_dir))
    return pt.with_content(articles).select("page_id", "content")


@query
def infobox_website(spark: SparkSession, sf_dir: str) -> DataFrame:
    address = wt.infobox_website(F.col("body"))
    return fx.articles(spark, sf_dir).select("page_id", address.alias("website"))


# --- joins -----------------------------------------------------------------------------


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.match_articles(fx.titles(spark, sf_dir), _last_links(spark, sf_dir), ON)


_MATCH_COLUMNS = [
    "page_id", "wiki", "lang", "title", "latitude", "longitude", "poitype", "region",
]


@query
def article_link_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir).select(*_MATCH_COLUMNS)


@query
def article_link_join_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = mt.normalized(fx.titles(spark, sf_dir))
    links = _last_links(spark, sf_dir, normalize_title=True)
    return mt.match_articles(articles, links, ON).select(*_MATCH_COLUMNS)


@query
def unmatched_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = mt.unmatched_articles(fx.titles(spark, sf_dir), _last_links(spark, sf_dir), ON)
    return left.select("page_id", "title")


@query
def unmatched_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = mt.unmatched_links(fx.titles(spark, sf_dir), _last_links(spark, sf_dir), ON)
    return left.select("k", "title")


@query
def match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.match_rate(fx.titles(spark, sf_dir), _last_links(spark, sf_dir), ON)


# --- points of interest ----------------------------------------------------------------


@query
def poi_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = catalog.with_labels(fx.titles(spark, sf_dir))
    url = place.page_url(F.col("wiki_label"), F.col("lang"), F.col("title"))
    return labelled.select("page_id", url.alias("url"))


@query
def poi_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    city = place.city(F.col("poitype"), F.col("title"))
    return _matched(spark, sf_dir).select("page_id", city.alias("CITY"))


@query
def poi_country_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    poitype, region = F.col("poitype"), F.col("region")
    return _fields(spark, sf_dir).select(
        "k",
        place.country(poitype, region).alias("COUNTRY"),
        place.subdivision(region).alias("REGION"),
    )


@query
def poi_remarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = catalog.with_labels(_matched(spark, sf_dir))
    url = place.page_url(F.col("wiki_label"), F.col("lang"), F.col("title"))
    remarks = place.remarks(url, F.col("poitype"), F.col("region"))
    return labelled.select("page_id", percent_decode(remarks).alias("REMARKS"))


@query
def poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pt.build_poi(fx.articles(spark, sf_dir), _last_links(spark, sf_dir), on=ON)


@query
def poi_from_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: dump lines to links, dump records to articles, both to points."""
    tuples = split_tuples(fx.link_lines(spark, sf_dir)).withColumnRenamed("pos", "place")
    links = keep_last(lk.geo_links(tuples), ON, ["line_ord", "place"])
    return pt.build_poi(_pages(spark, sf_dir), links, on=ON)


def _write_dumps(lines: DataFrame, folder: str, dumps: list[str], compression: str) -> None:
    """A folder of part files for each ``dump``, all in one pass over the lines; few MB a task, as they are slow to compress."""
    with jobs.bounded(lines.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}):
        lines.write.partitionBy("dump").option("compression", compression).text(folder)
    written = Folder(lines.sparkSession, folder)
    for dump in dumps:
        written.move(f"dump={dump}", dump)


@query
def links_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The link job over gz files that Spark wrote: file order, last per title, stored table."""
    folder, table = scratch_path(spark, "dumps"), scratch_path(spark, "links")
    langs = ("de", "en", "es", "fr")
    name = "wiki-latest-externallinks.sql"
    lines = fx.link_lines(spark, sf_dir).filter(F.col("lang").isin(*langs)).withColumn("dump", F.concat("lang", F.lit(name)))
    # One dump a language, in parts by order of lines.
    lines = lines.repartitionByRange(4, "line_ord").sortWithinPartitions("dump", "line_ord")
    _write_dumps(lines.select("dump", "value"), folder, [lang + name for lang in langs], "gzip")
    jobs.import_links(spark, f"{folder}/*", table)
    return read_link_table(spark, table).select("lang", *LINK_VALUES)


@query
def poi_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article job over bz2 files that Spark wrote, whose headers name a word of media links that nothing else knows."""
    folder, links, table = (scratch_path(spark, name) for name in ("dumps", "links", "poi"))
    header = "<mediawiki>\n<siteinfo>\n<namespaces>\n<namespace key=\"6\">{word}</namespace>\n</namespaces>\n</siteinfo>\n"
    names = {"wikipedia": "wiki", "wikivoyage": "wikivoyage"}
    heads = [(f"{lang}{name}-latest-pages-articles.xml", header.format(word=word)) for name in names.values() for lang, word in fx.OWN_WORDS]
    name = F.when(F.col("wiki") == "wikipedia", names["wikipedia"]).otherwise(names["wikivoyage"])
    records = fx.article_records(spark, sf_dir, fx.OWN_WORD).filter(F.col("lang").isin([lang for lang, _ in fx.OWN_WORDS]))
    pages = records.select(F.concat("lang", name, F.lit("-latest-pages-articles.xml")).alias("dump"), F.concat("value", F.lit("</page>")).alias("value"))
    first = spark.createDataFrame(heads, "dump string, value string").coalesce(1)  # the first part file of each dump
    _write_dumps(first.union(pages), folder, [dump for dump, _ in heads], "bzip2")
    write_link_table(_last_links(spark, sf_dir), links)
    jobs.import_articles(spark, f"{folder}/*", links, table)
    return read_table(spark, table)


@query
def dump_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of media and category links of each language, among documents and pages in many languages."""
    worded = namespaces.with_link_words(_many_languages(spark, sf_dir))
    return worded.select("doc_id", "lang", F.explode("link_words").alias("word"))


@query
def poi_all_wikis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of two stored tables, one of the encyclopedia and one of the travel guide."""
    tables = []
    for wiki in ("wikipedia", "wikivoyage"):
        path = scratch_path(spark, wiki)
        articles = fx.articles(spark, sf_dir).filter(F.col("wiki") == wiki)
        write_poi_table(pt.build_poi(articles, _last_links(spark, sf_dir), on=ON), path)
        tables.append(read_table(spark, path))
    return tables[0].unionByName(tables[1])


@query
def poi_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = poi(spark, sf_dir)
    escaped = table.withColumns({c: xml_escape_markup(F.col(c)) for c in POI_TEXT_COLUMNS})
    return pt.clean_poi(escaped)


def xml_escape_markup(col):
    """``&``, ``<`` and ``>`` as entities; quotes stay."""
    quotes = [("&quot;", '"'), ("&apos;", "'")]
    col = xml_escape(col)
    for entity, mark in quotes:
        col = F.replace(col, F.lit(entity), F.lit(mark))
    return col


@query
def poi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts the rows to be written, without the text work."""
    articles, links = fx.articles(spark, sf_dir), _last_links(spark, sf_dir)
    return qa.poi_counts(pt.emitted_articles(articles, links, ON))


# --- outputs ---------------------------------------------------------------------------


@query
def poi_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The travel guide of a stored table whose contents hold an entity, decoded."""
    path = scratch_path(spark, "poi")
    write_poi_table(poi(spark, sf_dir).withColumn("CONTENT", F.concat("CONTENT", F.lit(" A &amp; B"))), path)
    return pt.decode_poi_entities(read_table(spark, path, wiki="wikivoyage"))


@query
def poi_gpx_waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that the writer turns into elements."""
    points = gpx.waypoints(poi(spark, sf_dir))
    return points.select(
        *PARTITION_COLUMNS, F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), "name", F.col("desc").alias("description")
    )


def _stored_poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "poi")
    write_poi_table(poi(spark, sf_dir), path)
    return read_table(spark, path)


@query
def poi_osm_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = osm.osm_nodes(_stored_poi(spark, sf_dir))
    return nodes.select(
        *PARTITION_COLUMNS,
        F.col("_id").alias("node_id"),
        F.col("_lat").alias("lat"),
        F.col("_lon").alias("lon"),
        F.size("tag").alias("tags"),
    )


@query
def poi_osm_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return osm.osm_tags(_stored_poi(spark, sf_dir))


@query
def poi_sql_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sqlscript.poi_inserts(poi(spark, sf_dir))


@query
def poi_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(poi(spark, sf_dir), path)
    return read_poi_csv(spark, path)


@query
def csv_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every thirteenth page is written without its last field."""
    path = scratch_path(spark, "integrity")
    whole, short = [
        F.to_csv(F.struct(*columns), CSV_OPTIONS) for columns in (POI_COLUMNS, POI_COLUMNS[:-1])
    ]
    line = F.when(F.col("page_id") % 13 == 0, short).otherwise(whole)
    lines = poi(spark, sf_dir).select(*PARTITION_COLUMNS, line.alias("value"))
    lines.hint("rebalance", *PARTITION_COLUMNS).write.partitionBy(*PARTITION_COLUMNS).text(path)
    return qa.csv_integrity(spark, path)
