"""Plans: what is pushed down, shuffled, broadcast and split."""

import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.queries import LINK_VALUES, _last_links, registered
from poiweave.operators import match as mt
from poiweave.operators.dedup import keep_last, keep_last_window
from poiweave.operators.numbering import number_rows
from poiweave.operators.poi import build_poi, clean_poi
from poiweave.operators.prefilter import may_match
from poiweave.plans import jobs
from poiweave.sinks.tables import write_link_table, write_poi_table
from poiweave.sources.articledump import pages_from_records
from poiweave.sources.linkdump import link_tuples
from poiweave.sources.tables import read_link_table, read_table, stored_bytes


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registered()) - {"csv_integrity", "poi_csv_roundtrip", "poi_osm_nodes"}))
def test_no_cross_join_no_python_no_single_task_window(spark, sf_dir, name):
    text = plan(registered()[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert node not in text
    assert "Exchange SinglePartition" not in text


def test_article_parsing_stays_above_the_join(spark, sf_dir):
    """A body filter must not pull the XML parsing under the join."""
    links = spark.createDataFrame(
        [("en", "Place 1", 1.0, 2.0, "", "", "")],
        "lang string, title string, latitude double, longitude double, language string, "
        "poitype string, region string",
    )
    pages = pages_from_records(fx.article_records(spark, sf_dir))
    text = clean_poi(build_poi(pages, links))._jdf.queryExecution().optimizedPlan().toString()
    above, below = text.split("Join Inner", 1)
    assert above.count("StructField(revision") == 1
    assert "StructField(revision" not in below
    assert above.count("{{Infobox") == 1


def test_a_dump_line_is_split_once(spark, sf_dir):
    text = link_tuples(fx.link_lines(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(value") == 1


@pytest.mark.parametrize("name", ["article_link_join", "unmatched_articles", "match_rate"])
def test_title_joins_do_not_read_bodies(spark, sf_dir, name):
    assert "text:string" not in plan(registered()[name](spark, sf_dir))


def test_stored_links_are_pruned_and_measured(spark, sf_dir, tmp_path):
    links = registered()["links_keep_last"](spark, sf_dir)
    both = links.withColumn("lang", F.when(F.col("k") % 2 == 0, "en").otherwise("nl"))
    path = str(tmp_path / "links")
    write_link_table(both, path)
    assert stored_bytes(spark, path) > 1000
    text = plan(read_link_table(spark, path, lang="nl").filter(F.col("latitude") > 10).select("title"))
    assert "PartitionFilters: [isnotnull(lang" in text and "PushedFilters: [IsNotNull(latitude)" in text
    assert "ReadSchema: struct<title:string,latitude:double>" in text


@pytest.fixture
def skew_conf(spark):
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in values.items():
        spark.conf.set(key, value)
    yield
    for key in values:
        spark.conf.unset(key)


def test_hot_title_is_split_and_complete(spark, skew_conf):
    """A third of all articles share one title."""
    articles = spark.range(0, 30_000, 1, 8).select(
        F.lit("en").alias("lang"),
        F.lit("wikipedia").alias("wiki"),
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("title"),
        F.sha2(F.col("id").cast("string"), 512).alias("body"),
    )
    links = spark.range(0, 30_001).select(
        F.lit("en").alias("lang"),
        F.when(F.col("id") == 30_000, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("title"),
        F.lit(1.0).alias("latitude"),
        F.lit("").alias("poitype"),
    )
    joined = mt.match_articles(articles, links)
    rows = joined.collect()
    assert len(rows) == len({r.page_id for r in rows}) == 30_000
    assert "ShuffledHashJoin(skew=true)" in plan(joined)


def test_hot_title_is_reduced_before_the_shuffle(spark):
    links = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 100)).alias("title"),
        F.col("id").alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    expected = dict(links.groupBy("title").agg(F.max("k")).collect())
    for fn in (keep_last, keep_last_window):
        last = fn(links, ["title"], ["k"])
        rows = last.collect()
        assert {r.title: r.k for r in rows} == expected
        assert all(r.v == str(r.k) for r in rows)
        text = plan(last)
        assert "partial_max_by" in text or "WindowGroupLimit" in text


def test_numbers_are_dense_across_ranges(spark):
    rows = spark.range(0, 5000, 7, 4).select(
        F.lit("wikipedia").alias("wiki"),
        F.when(F.col("id") % 3 == 0, "en").otherwise("nl").alias("lang"),
        F.col("id").alias("page_id"),
    )
    numbered = number_rows(rows, "n", width=100).collect()
    for lang in ("en", "nl"):
        mine = sorted((r.page_id, r.n) for r in numbered if r.lang == lang)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_numbers_come_in_page_order_whatever_the_ids(spark, limit):
    """Rows without an id come first, each with a number; rows of one id share one."""
    ids = [None, None, 7, 3, 120, 120, 99_999, -5]
    rows = spark.createDataFrame([("w", lang, i, f"{lang}{k}") for lang in ("en", "nl") for k, i in enumerate(ids)], "wiki string, lang string, page_id long, NAME string")
    got = number_rows(rows, "n", width=100, broadcast_bytes=limit).collect()
    for lang in ("en", "nl"):
        mine = [(r.page_id, r.n) for r in got if r.lang == lang]
        assert sorted(n for i, n in mine if i is None) == [1, 2]
        assert sorted((i, n) for i, n in mine if i is not None) == [(-5, 3), (3, 4), (7, 5), (120, 6), (120, 6), (99_999, 7)]


def test_numbering_moves_no_text(spark, sf_dir, tmp_path):
    path = str(tmp_path / "poi")
    write_poi_table(registered()["poi"](spark, sf_dir), path)
    numbered = number_rows(read_table(spark, path), "n")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = numbered._jdf.queryExecution().explainString(mode)
    moved = re.findall(r"\) (?:Exchange|Window|Sort)\b[^\n]*\n(?:Input|Output)[^:]*: (\[[^\n]*\])", text)
    assert len(moved) >= 3 and not any("CONTENT" in x or "REMARKS" in x for x in moved)
    assert numbered.count() == numbered.select("wiki", "lang", "n").distinct().count() > 0


def test_prefilter_keeps_every_match_and_little_else(spark):
    articles = spark.range(0, 20_000).select(
        F.lit("en").alias("lang"), F.concat(F.lit("t"), F.col("id")).alias("title"), F.col("id").alias("page_id")
    )
    links = spark.range(0, 20_000, 20).select(
        F.lit("en").alias("lang"), F.concat(F.lit("t"), F.col("id")).alias("title")
    )
    kept = may_match(articles, links, ["lang", "title"], bits=1 << 17)
    ids = {r.page_id for r in kept.collect()}
    assert kept.columns == articles.columns
    assert ids >= set(range(0, 20_000, 20))
    assert len(ids) < 1000 + 19_000 * 0.02
    assert "BroadcastHashJoin" in plan(kept) and "Exchange hashpartitioning(lang" not in plan(kept)


def test_dumps_are_written_in_one_pass(spark, tmp_path, monkeypatch):
    """All dumps of a query come from a single pass over its table, and the jobs read from them what the tables say."""
    texts = {k: f"Text of {k}. More [[{word}:a.jpg|thumb|gone]] text." for k in range(24) for word in ("Lichtbild",)}
    docs = [(k, texts[k], ("de", "en", "fr", "es", None, "it")[k % 6]) for k in range(24)] + [(None, "No id.", "de"), (30, None, "en"), (2, texts[2], "fr")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    orders = [(k, k % 40) for k in range(400)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    written, real = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, *args, **options: (written.append(args), real(self, *args, **options))[1])
    found = {}
    for name in ("links_from_files", "poi_from_files"):
        written.clear()
        found[name] = sorted(map(repr, registered()[name](spark, str(tmp_path)).collect()))
        assert len(written) == 1
    links = _last_links(spark, str(tmp_path)).select("lang", *LINK_VALUES)
    assert found["links_from_files"] == sorted(map(repr, links.collect()))
    in_tables = registered()["poi"](spark, str(tmp_path)).filter("lang in ('de', 'en', 'fr', 'es')")
    assert len(found["poi_from_files"]) == in_tables.count() > 0
    assert not any("Lichtbild" in row for row in found["poi_from_files"] if "lang='de'" in row)


def test_article_dumps_are_read_in_small_splits(spark, tmp_path, monkeypatch):
    """While the article job runs, a task reads a bounded part of the compressed dumps; afterwards the session is as it was."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before, seen, real = {k: spark.conf.get(k) for k in keys}, [], jobs.write_poi_table
    pages = [(f"<page><title>P{k}</title><id>{k}</id><revision><text>Text {k}.</text></revision></page>",) for k in range(50)]
    spark.createDataFrame(pages, "value string").coalesce(1).write.option("compression", "bzip2").text(str(tmp_path / "enwiki-latest-pages-articles.xml"))
    links = spark.createDataFrame([("en", f"P{k}", 1.0, 2.0) for k in range(0, 50, 2)], "lang string, title string, latitude double, longitude double")
    write_link_table(links.select("lang", "title", "latitude", "longitude", *[F.lit("").alias(c) for c in ("language", "poitype", "region")]), str(tmp_path / "links"))

    def write(poi, path):
        seen.append({k: spark.conf.get(k) for k in keys})
        real(poi, path)

    monkeypatch.setattr(jobs, "write_poi_table", write)
    for asked, expected in (("128m", 8 << 20), ("64k", 64 << 10)):
        spark.conf.set(keys[0], asked)
        done = jobs.import_articles(spark, str(tmp_path / "enwiki*"), str(tmp_path / "links"), str(tmp_path / "poi"))
        assert done["rows"] == done["matched"] == 25 and done["pages"] == 50
        assert seen[-1][keys[0]] == f"{expected}b" and spark.conf.get(keys[0]) == asked
        assert spark.conf.get(keys[1]) == before[keys[1]]
    spark.conf.set(keys[0], before[keys[0]])
