"""Dump files through the jobs to every output, in a temporary folder."""

import bz2
import csv
import glob
import gzip
import os
import random
import sqlite3
import xml.etree.ElementTree as ET
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poiweave.operators.quality import csv_integrity
from poiweave.plans import jobs
from poiweave.schemas import POI_COLUMNS, POI_TABLE_SCHEMA
from poiweave.sinks import swap
from poiweave.sinks.csvfiles import write_csv
from poiweave.sinks.layout import replaced, writer
from poiweave.sinks.sqlscript import write_link_sql, write_poi_sql
from poiweave.sinks.tables import write_poi_table
from poiweave.sources.articledump import read_article_dumps, unparsed_pages, with_body
from poiweave.sources.linkdump import link_tuples, read_link_dumps
from poiweave.sources.namespaces import read_namespaces
from poiweave.sources.tables import read_link_table, read_poi_csv, read_table

GEO = "{n},7,'http://t/geohack.php?pagename={title}&language=en&params={params}','http://t.'"


def link_dump(folder, lang, lines):
    with gzip.open(f"{folder}/{lang}wiki-latest-externallinks.sql.gz", "wt", encoding="utf-8") as f:
        f.write("-- dump\n")
        for line in lines:
            f.write("INSERT INTO `externallinks` VALUES (" + "),(".join(line) + ");\n")


def page(number, title, body, attributes='xml:space="preserve"'):
    return (
        f"  <page>\n    <title>{title}</title>\n    <ns>0</ns>\n    <id>{number}</id>\n"
        f"    <revision>\n      <id>{number + 1000}</id>\n      <text {attributes}>{body}</text>\n"
        "    </revision>\n  </page>\n"
    )


def article_dump(folder, name, pages):
    head = "<mediawiki>\n  <siteinfo>\n    <sitename>W</sitename>\n  </siteinfo>\n"
    with bz2.open(f"{folder}/{name}-latest-pages-articles.xml.bz2", "wt", encoding="utf-8") as f:
        f.write(head + "".join(pages) + "</mediawiki>\n")


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Two languages, one travel guide; the link and article jobs have run."""
    folder = str(tmp_path_factory.mktemp("dumps"))
    link_dump(
        folder,
        "en",
        [
            [
                GEO.format(n=1, title="Old%20Town", params="1_N_2_E_type:city_region:US-CA"),
                "2,7,'http://plain/','x'",
                GEO.format(n=3, title="A%20%26%20B", params="5_N_6_W"),
                GEO.format(n=4, title="title", params="8_S_9_E_type:country"),
            ],
            [
                GEO.format(n=5, title="Old%20Town", params="3_N_4_E_type:city_region:NL-ZH"),
                GEO.format(n=6, title="Say%20%22hi%22", params="x_N_6_W"),
                GEO.format(n=7, title="Moved", params="1_N_1_E"),
                GEO.format(n=8, title="Empty", params="1_N_1_E"),
            ],
        ],
    )
    link_dump(folder, "nl", [[GEO.format(n=1, title="Old%20Town", params="50_30_N_4_15_E")]])
    article_dump(
        folder,
        "enwiki",
        [
            page(10, "Old Town", "{{Infobox x\n}}\n'''Old Town''' is &quot;old&quot;. It&#039;s big, 1 &amp;lt; 2."),
            page(11, "A &amp; B", "First line.\nSecond [[line|row]].", 'bytes="9" xml:space="preserve"'),
            page(12, "title", "A word. Cut"),
            page(13, "Say &quot;hi&quot;", "Hello."),
            page(14, "Moved", "#REDIRECT [[Old Town]]"),
            page(15, "Empty", ""),
            page(16, "Unlinked", "Nothing here."),
        ],
    )
    article_dump(folder, "enwikivoyage", [page(3, "Old Town", "Travel there.\n\nNow, O'Hara.")])
    article_dump(folder, "nlwiki", [page(5, "Old Town", "Geen punt"), page(6, "A &amp; B", "Niet.")])
    paths = {"folder": folder, "links": f"{folder}/t/links", "poi": f"{folder}/t/poi"}
    jobs.import_links(spark, f"{folder}/*-externallinks.sql.gz", paths["links"])
    jobs.import_articles(
        spark, f"{folder}/*-pages-articles.xml.bz2", paths["links"], paths["poi"]
    )
    return paths


def test_link_table(spark, world):
    rows = {(r.lang, r.title): r for r in read_link_table(spark, world["links"]).collect()}
    assert len(rows) == 7
    assert rows["en", "Old Town"].region == "NL-ZH"  # the later line
    assert (rows["nl", "Old Town"].latitude, rows["nl", "Old Town"].longitude) == (50.5, 4.25)
    assert rows["en", 'Say "hi"'].latitude is None
    assert rows["en", "title"].latitude == -8.0


def test_poi_table(spark, world):
    rows = {(r.wiki, r.lang, r.NAME): r for r in read_table(spark, world["poi"]).collect()}
    assert sorted(rows) == [
        ("wikipedia", "en", "A & B"),
        ("wikipedia", "en", "Old Town"),
        ("wikipedia", "en", 'Say "hi"'),
        ("wikipedia", "en", "title"),
        ("wikipedia", "nl", "Old Town"),
        ("wikivoyage", "en", "Old Town"),
    ]
    town = rows["wikipedia", "en", "Old Town"]
    assert town.CONTENT == "Old Town is \"old\". It's big, 1 < 2."
    assert (town.COUNTRY, town.REGION, town.CITY, town.page_id) == ("NL", "ZH", "Old Town", 10)
    assert rows["wikipedia", "en", "A & B"].CONTENT == "First line. Second row."
    assert rows["wikipedia", "en", "title"].CONTENT == "A word."
    assert rows["wikipedia", "en", "title"].COUNTRY == "country"
    assert rows["wikipedia", "nl", "Old Town"].CONTENT == ""
    guide = rows["wikivoyage", "en", "Old Town"]
    assert guide.REMARKS.startswith("(Wikipedia:  http://en.wikipedia.org/wiki/Old_Town ;")
    assert guide.LATITUDE == 3.0  # coordinates of the encyclopedia's link


def test_large_link_tables_give_the_same_points(spark, world, tmp_path):
    articles = f"{world['folder']}/*-pages-articles.xml.bz2"
    poi = str(tmp_path / "poi")
    jobs.import_articles(spark, articles, world["links"], poi, broadcast_limit=0)
    shuffled, broadcast = read_table(spark, poi), read_table(spark, world["poi"])
    assert shuffled.count() == broadcast.count() == 6
    assert shuffled.exceptAll(broadcast.select(*shuffled.columns)).count() == 0


def test_rerun_replaces_only_its_languages(spark, world, tmp_path):
    table = str(tmp_path / "links")
    folder = world["folder"]
    for _ in range(2):
        jobs.import_links(spark, f"{folder}/*-externallinks.sql.gz", table)
        jobs.import_links(spark, f"{folder}/nlwiki-latest-externallinks.sql.gz", table)
    assert read_link_table(spark, table).count() == 7
    assert read_link_table(spark, table, lang="nl").count() == 1


def test_bz2_is_read_in_splits(spark, tmp_path):
    pages = [
        page(n, f"T {n}", "".join(chr(97 + (n * 7 + i * i) % 26) for i in range(1500)) + ".")
        for n in range(3000)
    ]
    article_dump(str(tmp_path), "enwiki", pages)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        found = read_article_dumps(spark, f"{tmp_path}/*.bz2")
        assert found.rdd.getNumPartitions() > 2
        rows = with_body(found).select("page_id", "title", "body").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 3000
    assert {r.page_id for r in rows} == set(range(3000))
    assert all(len(r.body) == 1501 and r.title == f"T {r.page_id}" for r in rows)


def test_keep_last_over_splits(spark, tmp_path):
    """Uncompressed dump in many splits: the last line of the file wins."""
    with open(tmp_path / "enwiki-latest-externallinks.sql", "w") as f:
        for n in range(400):
            tuples = [GEO.format(n=n, title=f"T{t}", params=f"{n % 90}_N_{n}_E") for t in range(20)]
            f.write("INSERT INTO x VALUES (" + "),(".join(tuples) + ");\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50_000)
    try:
        lines = read_link_dumps(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        assert link_tuples(lines).count() == 8000
        rows = jobs.latest_links(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 20
    assert {r.longitude for r in rows} == {399.0}


def parts(path, pattern="part-*"):
    return sorted(glob.glob(f"{path}/**/{pattern}", recursive=True))


def python_csv(path):
    rows = []
    for file in parts(path):
        opener = gzip.open if file.endswith(".gz") else open
        with opener(file, "rt", encoding="utf-8", newline="") as f:
            rows += list(csv.reader(f))
    return rows


@pytest.mark.parametrize("zipped", [False, True])
def test_csv(spark, world, tmp_path, zipped):
    poi = read_table(spark, world["poi"])
    path = str(tmp_path / "csv")
    write_csv(poi, path, gzip=zipped)
    rows = python_csv(path)
    files = parts(path)
    assert all(f.endswith(".gz") == zipped for f in files)
    assert sum(r == POI_COLUMNS for r in rows) == len(files) == 3
    by_name = {r[0]: r for r in rows}
    assert by_name['Say "hi"'][1] == ""
    assert len(rows) - 3 == poi.count()
    back = read_poi_csv(spark, path).select(*POI_COLUMNS, "wiki", "lang")
    kept = poi.select(*POI_COLUMNS, "wiki", "lang")
    assert back.exceptAll(kept).count() == kept.exceptAll(back).count() == 0
    assert os.path.getsize(files[0]) > 0
    counts = csv_integrity(spark, path).collect()
    assert sum(r.wrong_rows for r in counts) == 0
    assert sum(r.correct_rows for r in counts) == len(rows)


def test_csv_integrity_counts_every_bad_row(spark, tmp_path):
    folder = tmp_path / "wiki=wikipedia" / "lang=en"
    folder.mkdir(parents=True)
    good = ",".join(['"a ""q"" b"'] * 8)
    inside = ",".join(['"two\nlines"'] + ['"x"'] * 7)
    short = ",".join(['"x"'] * 7)
    long = ",".join(['"x"'] * 9)
    (folder / "part-0.csv").write_text("\n".join([good, short, inside, long, short, good]) + "\n")
    row = csv_integrity(spark, str(tmp_path)).first()
    assert (row.correct_rows, row.wrong_rows, row.lines) == (3, 3, 7)


def csv_files(folder, seed, line_end):
    """Files of random quoted fields with line ends, quotes and commas in them; the last one ends without a line end."""
    rng = random.Random(seed)
    bits = ["a", "é", ",", '""', "\n", "\r\n", "\n\n", '""\n""', " ", "x" * 90]
    for lang in ("en", "nl"):
        place = folder / "wiki=wikipedia" / f"lang={lang}"
        place.mkdir(parents=True)
        for k in range(3):
            rows = [",".join(f'"{n}"' for n in POI_COLUMNS)]
            for n in range(rng.randint(0, 60)):
                texts = ["".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 3, 12]))) for _ in range(6)]
                texts = [t.strip() if t.startswith(("\r", "\n", " ")) else t for t in texts]
                plain = f"{n}" if rng.random() < 0.5 else f'"{n}"'
                row = [f'"{texts[0]}"', plain, f"-{n}.5", *[f'"{t}"' for t in texts[1:]]]
                rows.append(",".join(row))
            (place / f"part-{k}.csv").write_bytes((line_end.join(rows) + (line_end if k else "")).encode())


@pytest.mark.parametrize("seed,line_end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_csv_is_cut_in_splits_like_in_one_task(spark, tmp_path, seed, line_end):
    csv_files(tmp_path, seed, line_end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 70)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        table = read_poi_csv(spark, str(tmp_path))
        got = [tuple(r) for r in table.select(*POI_COLUMNS, "wiki", "lang").collect()]
        scanned = spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions()
        counts = {r.lang: r for r in csv_integrity(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    schema = T.StructType(POI_TABLE_SCHEMA.fields[1:])
    whole = spark.read.schema(schema).option("escape", '"').option("multiLine", True).option("header", True).csv(str(tmp_path))
    expected = [tuple(r) for r in whole.na.fill("").select(*POI_COLUMNS, "wiki", "lang").collect()]
    if line_end != "\n":  # the other reader turns the line ends inside fields into those of its files, or back
        got, expected = ([tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r) for r in rows] for rows in (got, expected))
    assert scanned > 20 and Counter(got) == Counter(expected)
    for lang in ("en", "nl"):
        files = list((tmp_path / "wiki=wikipedia" / f"lang={lang}").iterdir())
        assert counts[lang].correct_rows == sum(r[-1] == lang for r in expected) + len(files) and counts[lang].wrong_rows == 0
        assert counts[lang].lines == sum(len(f.read_bytes().removesuffix(b"\n").split(b"\n")) for f in files)


def test_an_open_field_takes_the_rest_of_its_file_alone(spark, tmp_path):
    folder = tmp_path / "wiki=wikipedia" / "lang=en"
    folder.mkdir(parents=True)
    good = ",".join(['"x"'] * 8)
    (folder / "part-0.csv").write_text(f'{good}\n"open,{good}\n{good}\n')
    (folder / "part-1.csv").write_text(f"{good}\n\n{good}\n")
    row = csv_integrity(spark, str(tmp_path)).first()
    assert (row.correct_rows, row.wrong_rows, row.lines) == (3, 1, 6)


def test_gpx(spark, world, tmp_path):
    jobs.export_poi(spark, world["poi"], str(tmp_path), ("gpx",), wiki="wikipedia", lang="en")
    roots = [ET.parse(f).getroot() for f in parts(tmp_path / "gpx")]
    ns = "{http://www.topografix.com/GPX/1/0}"
    assert all(r.tag == ns + "gpx" and r.get("version") == "1.0" for r in roots)
    points = {p.find(ns + "name").text: p for r in roots for p in r.findall(ns + "wpt")}
    assert len(points) == 4
    assert points["A & B"].get("lat") == "5.0000000" and points["A & B"].get("lon") == "-6.0000000"
    assert points['Say "hi"'].get("lat") == ""
    assert points["Old Town"].find(ns + "desc").text.endswith("It's big, 1 < 2.")


def test_osm(spark, world, tmp_path):
    jobs.export_poi(spark, world["poi"], str(tmp_path), ("osm",))
    nodes = {}
    for file in parts(tmp_path / "osm"):
        root = ET.parse(file).getroot()
        assert root.tag == "osm" and root.get("version") == "0.5"
        for node in root.findall("node"):
            tags = {t.get("k"): t.get("v") for t in node.findall("tag")}
            nodes[os.path.dirname(file)[-30:], tags["name"]] = (node, tags)
    assert len(nodes) == 6
    ids = sorted(n.get("id") for (_, name), (n, _) in nodes.items())
    assert ids == ["11", "11", "11", "21", "31", "41"]
    town = next(t for (where, name), (_, t) in nodes.items() if name == "Old Town" and "wikipedia" in where and "lang=en" in where)
    assert town["tourism"] == "user" and town["addr:province"] == "ZH" and "addr:state" not in town
    plain = next(t for (_, name), (_, t) in nodes.items() if name == "A & B")
    assert set(plain) == {"tourism", "name", "note"}


def run_script(path):
    con = sqlite3.connect(":memory:")
    for file in parts(path):
        opener = gzip.open if file.endswith(".gz") else open
        with opener(file, "rt", encoding="utf-8") as f:
            con.executescript(f.read())
    return con


@pytest.mark.parametrize("zipped", [False, True])
def test_poi_sql(spark, world, tmp_path, zipped):
    write_poi_sql(read_table(spark, world["poi"]), str(tmp_path), gzip=zipped)
    con = run_script(tmp_path)
    names = [r[0] for r in con.execute("select title from en_wikipedia order by title")]
    assert names == ["A & B", "Old Town", 'Say "hi"', "title"]
    assert con.execute("select latitude, content from en_wikivoyage").fetchall() == [
        (3.0, "Travel there. Now, O'Hara.")
    ]
    assert con.execute("select count(*) from sqlite_master where type = 'index'").fetchone() == (3,)


def test_link_sql(spark, world, tmp_path):
    write_link_sql(read_link_table(spark, world["links"]), str(tmp_path))
    con = run_script(tmp_path)
    assert con.execute("select count(*) from en_externallinks").fetchone() == (6,)
    assert con.execute("select latitude, longitude from nl_externallinks").fetchall() == [(50.5, 4.25)]


def test_export_keeps_and_drops_empty_content(spark, world, tmp_path):
    jobs.export_poi(spark, world["poi"], str(tmp_path / "all"), ("csv",))
    jobs.export_poi(spark, world["poi"], str(tmp_path / "full"), ("csv",), drop_empty=True)
    assert read_poi_csv(spark, str(tmp_path / "all/csv")).count() == 6
    assert read_poi_csv(spark, str(tmp_path / "full/csv")).count() == 5
    # nl has nothing left, so it gets no directory and no empty file
    assert not os.path.exists(tmp_path / "full/csv/wiki=wikipedia/lang=nl")
    assert all(os.path.getsize(f) for f in parts(tmp_path))


def test_normalized_titles(spark, tmp_path):
    folder = str(tmp_path)
    link_dump(folder, "en", [[GEO.format(n=1, title="A_b", params="1_N_2_E")]])
    article_dump(folder, "enwiki", [page(1, "A b", "Text.")])
    for flag, expected in ((False, 0), (True, 1)):
        links, poi = f"{folder}/l{flag}", f"{folder}/p{flag}"
        jobs.import_links(spark, f"{folder}/*.gz", links, normalize_title=flag)
        jobs.import_articles(spark, f"{folder}/*.bz2", links, poi, normalize_title=flag)
        found = parts(poi, "part-*.parquet")
        assert len(found) == expected


def test_of_links_that_differ_by_an_underscore_the_last_stays(spark, tmp_path):
    """The later one is further south, so no order of values would choose it."""
    folder = str(tmp_path)
    rows = [GEO.format(n=n, title=t, params=p) for n, t, p in ((1, "A_b", "50_N_9_E"), (2, "A%20b", "1_N_2_E"), (3, "C%20d", "2_N_2_E"), (4, "C_d", "1_S_1_W"))]
    link_dump(folder, "en", [rows[:1], rows[1:]])
    article_dump(folder, "enwiki", [page(1, "A b", "Text."), page(2, "C d", "Text.")])
    jobs.import_links(spark, f"{folder}/*.gz", f"{folder}/links")
    assert read_link_table(spark, f"{folder}/links").count() == 4
    jobs.import_articles(spark, f"{folder}/*.bz2", f"{folder}/links", f"{folder}/poi", normalize_title=True)
    found = {r.NAME: (r.LATITUDE, r.LONGITUDE) for r in read_table(spark, f"{folder}/poi").collect()}
    assert found == {"A b": (1.0, 2.0), "C d": (-1.0, -1.0)}


def test_jobs_return_what_their_scan_counted(spark, tmp_path):
    folder = str(tmp_path)
    link_dump(folder, "en", [[GEO.format(n=1, title="A", params="1_N_2_E"), "2,7,'http://plain/','x'"], [GEO.format(n=3, title="A", params="2_N_2_E"), GEO.format(n=4, title="Bad", params="1_N_5_E"), GEO.format(n=5, title="x", params="x")]])
    article_dump(folder, "enwiki", [page(1, "A", "Text."), page(2, "Bad", "a < b & c."), page(3, "Unlinked", "a < b.")])
    done = jobs.import_links(spark, f"{folder}/*.gz", f"{folder}/links")
    assert done == {"rows": 2, "partitions": ["lang=en"], "tuples": 5, "kept": 3}
    for limit in (jobs.BROADCAST_LIMIT, 0):
        done = jobs.import_articles(spark, f"{folder}/*.bz2", f"{folder}/links", f"{folder}/poi", broadcast_limit=limit)
        assert done == {"rows": 1, "partitions": ["wiki=wikipedia/lang=en"], "pages": 3, "matched": 2, "unparsed": 1}
    link_dump(folder, "en", [["2,7,'http://plain/','x'"]])
    jobs.import_links(spark, f"{folder}/*.gz", f"{folder}/links")
    done = jobs.import_articles(spark, f"{folder}/*.bz2", f"{folder}/links", f"{folder}/poi")
    assert done == {"rows": 0, "partitions": [], "pages": 3, "matched": 0, "unparsed": 0}


def test_namespaces_and_redirects_of_the_wikis_language(spark, tmp_path):
    folder = str(tmp_path)
    header = (
        "<mediawiki>\n  <siteinfo>\n    <namespaces>\n"
        '      <namespace key="0" case="first-letter" />\n      <namespace key="6" case="first-letter">Licht_bild</namespace>\n'
        '      <namespace key="10" case="first-letter">Vorlage</namespace>\n      <namespace key="14">Kat &amp; Co</namespace>\n'
        "    </namespaces>\n  </siteinfo>\n"
    )
    bodies = [
        "A [[Datei:a.jpg|mini|von [[B]] bei [[C|D]]]]b [[Bild:x.png]]c [[lichtbild : y.png|z]]d.",
        "E [[LICHT BILD:y|[[F]]]]f [[Licht_bild:z]]g [[Kat &amp; Co:H]]h [[Vorlage:i]].",
        "#WEITERLEITUNG [[A]]",
        "\n #weiterleitung [[A]].",
        "Nothing marks it.",
        "#DOORVERWIJZING [[A]].",
    ]
    pages = [page(n, f"T{n}", b) for n, b in enumerate(bodies)]
    pages[4] = pages[4].replace("<ns>", '<redirect title="A" />\n    <ns>')
    with bz2.open(f"{folder}/dewiki-latest-pages-articles.xml.bz2", "wt", encoding="utf-8") as f:
        f.write(header + "".join(pages) + "</mediawiki>\n")
    article_dump(folder, "nlwiki", [page(1, "T1", "#DOORVERWIJZING [[A]]."), page(2, "T2", "J [[Bestand:x]]k [[Datei:y]]l.")])
    for lang in ("de", "nl"):
        link_dump(folder, lang, [[GEO.format(n=n, title=f"T{n}", params="1_N_2_E") for n in range(6)]])
    assert [tuple(r) for r in read_namespaces(spark, f"{folder}/*.bz2").collect()] == [("wikipedia", "de", ["kat & co", "licht bild"])]
    jobs.import_links(spark, f"{folder}/*.gz", f"{folder}/links")
    jobs.import_articles(spark, f"{folder}/*.bz2", f"{folder}/links", f"{folder}/poi")
    found = {(r.lang, r.NAME): r.CONTENT for r in read_table(spark, f"{folder}/poi").collect()}
    assert found == {
        ("de", "T0"): "A b c zd.",
        ("de", "T1"): "E f g h Vorlage:i.",
        ("de", "T5"): "#DOORVERWIJZING A.",
        ("nl", "T2"): "J k Datei:yl.",
    }


class Broken(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "move:0", "move:1", "move:2", "move:3", "remove:0", "remove:1", "remove:2"])
def test_a_table_is_the_old_or_the_new_one_wherever_a_run_dies(spark, tmp_path, monkeypatch, step):
    """A run replaces two partitions, adds one and removes one, and dies at every step there is."""
    path = str(tmp_path / "table")

    def rows(version, langs):
        return spark.createDataFrame([(f"{lang}{version}", lang) for lang in langs], "title string, lang string")

    def table():
        read = spark.read.schema("title string, lang string").parquet(path)
        return sorted(r.title for r in read.collect())

    def replace(version, langs):
        return replaced(rows(version, langs), lambda df, p: writer(df, ["lang"]).parquet(p), path, lambda p: p["lang"] != "xx", ["lang"])

    assert replace(1, ["de", "en", "nl", "xx"])["rows"] == 4
    old, new = ["de1", "en1", "nl1", "xx1"], ["de2", "en2", "fr2", "xx1"]
    name, _, at = step.partition(":")
    method, calls = getattr(swap.Folder, name), []

    def dies(self, *args):
        if name == "move" and args[0].endswith(".part") or name == "remove" and (args[0].endswith(".part") or not self.exists("_swap")):
            return method(self, *args)
        calls.append(args)
        if name == "write" or len(calls) > int(at):
            raise Broken
        return method(self, *args)

    monkeypatch.setattr(swap.Folder, name, dies)
    with pytest.raises(Broken):
        replace(2, ["de", "en", "fr"])
    monkeypatch.undo()
    assert not {"_new", "_old"} & set(table())
    swap.recover(spark, path)
    assert table() == (old if name == "write" else new)
    swap.recover(spark, path)
    assert replace(3, ["de"]) == {"rows": 1, "partitions": ["lang=de"]}
    assert table() == ["de3", "xx1"]
    assert sorted(p for p in os.listdir(path) if p.startswith("_")) in ([], ["_SUCCESS"])


def test_an_error_while_writing_removes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("a", "en"), ("b", "nl")], "title string, lang string")
    replaced(rows, lambda df, p: writer(df, ["lang"]).parquet(p), path, lambda p: True, ["lang"])
    bad = rows.withColumn("title", F.expr("if(lang = 'nl', raise_error('broken'), title)"))
    with pytest.raises(Exception, match="broken"):
        replaced(bad, lambda df, p: writer(df, ["lang"]).parquet(p), path, lambda p: True, ["lang"])
    assert sorted(r.title for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_sorted_outputs(spark, world, tmp_path):
    rows = [(i, f"{(i * 7919) % 1000:03d}", float(i), 2.0, "", "", "", "", "c", "wikipedia", "en" if i % 3 else "nl") for i in range(1000)]
    poi = spark.createDataFrame(rows, POI_TABLE_SCHEMA).repartition(8)
    write_csv(poi, str(tmp_path / "csv"), max_records=150, order=["NAME"])
    files = parts(tmp_path / "csv")
    assert len(files) > 4
    for file in files:
        with open(file, encoding="utf-8", newline="") as f:
            names = [r[0] for r in csv.reader(f)][1:]
        assert names == sorted(names)
    write_poi_table(poi, str(tmp_path / "poi"))
    jobs.export_poi(spark, str(tmp_path / "poi"), str(tmp_path / "out"), ("gpx", "osm"), order=("NAME",))
    for name, tag in (("gpx", "name"), ("osm", "tag[@k='name']")):
        for file in parts(tmp_path / "out" / name):
            found = [e.text or e.get("v") for e in ET.parse(file).getroot().iterfind(f".//{{*}}{tag}")]
            assert found == sorted(found) and found


def test_listed_languages_only(spark, world, tmp_path):
    folder = str(tmp_path)
    link_dump(folder, "xx", [[GEO.format(n=1, title="A", params="1_N_2_E")]])
    article_dump(folder, "xxwiki", [page(1, "A", "Text.")])
    jobs.import_links(spark, f"{folder}/*.gz", f"{folder}/links")
    for flag, expected in ((True, 0), (False, 1)):
        poi = f"{folder}/poi{flag}"
        jobs.import_articles(
            spark, f"{folder}/*.bz2", f"{folder}/links", poi, listed_languages_only=flag
        )
        assert len(parts(poi, "part-*.parquet")) == expected


def test_a_language_without_links_any_more_has_no_rows(spark, tmp_path):
    folder = str(tmp_path)
    link_dump(folder, "en", [[GEO.format(n=1, title="A", params="1_N_2_E")]])
    link_dump(folder, "nl", [[GEO.format(n=1, title="B", params="1_N_2_E")]])
    article_dump(folder, "enwiki", [page(1, "A", "Text.")])
    article_dump(folder, "nlwiki", [page(1, "B", "no stop")])
    links, poi, out = f"{folder}/links", f"{folder}/poi", f"{folder}/out"
    assert jobs.import_links(spark, f"{folder}/*.gz", links)["rows"] == 2
    jobs.import_articles(spark, f"{folder}/*.bz2", links, poi)
    formats = ("csv", "gpx", "osm", "sql")
    jobs.export_poi(spark, poi, out, formats)
    jobs.export_poi(spark, poi, out, formats, drop_empty=True)
    for name in formats:
        assert [p for p in glob.glob(f"{out}/{name}/wiki=wikipedia/*") if "lang=" in p] == [f"{out}/{name}/wiki=wikipedia/lang=en"]
    link_dump(folder, "nl", [["2,7,'http://plain/','x'"]])
    done = jobs.import_links(spark, f"{folder}/nl*.gz", links)
    assert done == {"rows": 0, "partitions": [], "tuples": 1, "kept": 0}
    assert [r.lang for r in read_link_table(spark, links).collect()] == ["en"]
    jobs.import_articles(spark, f"{folder}/nl*.bz2", links, poi)
    assert [r.lang for r in read_table(spark, poi).collect()] == ["en"]
    link_dump(folder, "en", [["2,7,'http://plain/','x'"]])
    jobs.import_links(spark, f"{folder}/en*.gz", links)
    assert read_link_table(spark, links).count() == 0


def test_the_last_of_numbered_dumps_wins(spark, tmp_path):
    for number in (2, 10):
        with gzip.open(f"{tmp_path}/enwiki-20150501-externallinks{number}.sql.gz", "wt") as f:
            link = GEO.format(n=1, title="A", params=f"{number}_N_2_E")
            f.write(f"INSERT INTO `externallinks` VALUES ({link});\n")
    (row,) = jobs.latest_links(spark, f"{tmp_path}/*.gz").collect()
    assert row.latitude == 10.0


def test_a_name_without_language_is_refused(spark, tmp_path):
    with gzip.open(f"{tmp_path}/links.sql.gz", "wt") as f:
        f.write("INSERT INTO x VALUES (1);\n")
    with pytest.raises(ValueError, match="no language"):
        jobs.import_links(spark, f"{tmp_path}/*.gz", f"{tmp_path}/t")
    assert not os.path.exists(f"{tmp_path}/t")


def test_no_row_aborts_an_export(spark, tmp_path):
    folder = str(tmp_path)
    article_dump(folder, "enwiki", [page(1, "A", "x %01 y."), page(2, "Bad", "a < b & c.")])
    link_dump(folder, "en", [[GEO.format(n=1, title="A", params="1234567_N_5_E"), GEO.format(n=2, title="Bad", params="1_N_5_E")]])
    jobs.import_links(spark, f"{folder}/*.gz", f"{folder}/links")
    jobs.import_articles(spark, f"{folder}/*.bz2", f"{folder}/links", f"{folder}/poi")
    jobs.export_poi(spark, f"{folder}/poi", f"{folder}/out", ("csv", "gpx", "osm", "sql"))
    for name, tag in (("gpx", "wpt"), ("osm", "node")):
        (file,) = glob.glob(f"{folder}/out/{name}/*/*/part-*")
        assert [e.get("lat") for e in ET.parse(file).getroot() if e.tag.endswith(tag)] == ["1234567.0"]
    (counts,) = unparsed_pages(read_article_dumps(spark, f"{folder}/*.bz2")).collect()
    assert (counts.pages, counts.unparsed) == (2, 1)
