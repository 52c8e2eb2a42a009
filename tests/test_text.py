"""Hand cases for markup, content and derived columns."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from poiweave.functions import place
from poiweave.functions.balanced import paired_steps
from poiweave.functions.content import cut_sentence_sql, truncate_steps
from poiweave.functions.entities import decode_entities
from poiweave.functions.steps import with_steps
from poiweave.functions.wikitext import (
    infobox_website,
    strip_infobox,
    with_plain_text,
)
from poiweave.operators.poi import clean_poi, derive_poi, with_content, with_text
from poiweave.schemas import POI_COLUMNS
from poiweave.sources.catalog import with_dump_identity, with_labels


def apply(spark, text, fn):
    return fn(spark.createDataFrame([(text,)], "body string")).first()[0]


PLAIN = [
    ("'''Bold''' and ''it''.", "Bold and it."),
    ("[[Place|first]] [[Second]] [[a#b|c]]", "first Second c"),
    ("x[[File:a.jpg|thumb|text]]y [[category:Z]]", "xy"),
    ("x [[File:a.jpg|thumb|A view of [[Paris]] by [[Night|night]]]]y", "x y"),
    ("x[[File:a|see [http://e f]]]y [[Image : b|[[c]]]]z [[ category:d]]", "xy z"),
    ("[[a|b [[c|d]] e|f]]g [[h|[[i]]", "fg [[h|i"),
    ("a | b]] [[c]] | [[d", "a | b]] c | [[d"),
    ("[[:Category:A|b]] [[en:C]] [[w:D|e: f]] [[g|h: i]]", "b en:C e: f h: i"),
    ("[[Datei:a.jpg|b]]", "b"),
    ("a {{t|{b} c}} {{{p}}} d}} e", "a {} d}} e"),
    ("a<!-- c\n c -->b", "ab"),
    ('a<ref name="x"/>b<ref>n\n</ref>c<REF a=1>m</Ref>d', "abcd"),
    ("a<math>x<y</math>b<gallery>\nf\n</gallery>c", "abc"),
    ("a {{t|{{u|{{v}}}}}} b", "a b"),
    ("{{1{{2{{3{{4{{5}}}}}}}}}} z", "z"),
    ("{{" * 10 + "x" + "}}" * 10 + " z {{open", "z {{open"),
    ("a <ref>b</ref> c <ref>open", "a c open"),
    ("== a ==\n=b\n===\n= =\n=c= \n==d= =", "a =b c d="),
    ("a{| class=x\n| cell\n|}b", "ab"),
    ("[http://x.y label text] [https://x.y/z]", "label text"),
    ("== Head ==\nText\n===Sub===\nmore", "Head Text Sub more"),
    ("a=b\nc = d", "a=b c = d"),
    ("a<br/>b<b>c</b>", "abc"),
    ("&amp;lt;b&amp;gt; x&nbsp;y", "<b> x& y"),
    ("  a\r\n\t b \n", "a b"),
    ("{{Infobox place\n| a = 1\n}}\nText.", "Text."),
    ("Text {{Infobox x}}\nmore\n}} z\nend", "end"),
    ("lead\n{{Infobox open\nnever closed", "lead"),
    ("", ""),
    ("日本語。[[東京|都]]", "日本語。都"),
]


@pytest.mark.parametrize("body,expected", PLAIN)
def test_plain_text(spark, body, expected):
    got = apply(spark, body, lambda d: with_plain_text(d, "body", "t").select("t"))
    assert got == expected


def infobox_by_lines(text):
    """Line rule in plain Python: from an opening line through the next closing line."""
    kept, inside, pending = [], False, False
    for line in text.split("\n"):
        if inside:
            inside = "}}" not in line
            continue
        if "{{Infobox" in line:
            inside = pending = True
            continue
        kept.append(line)
    return kept, pending


@pytest.mark.parametrize("seed", range(40))
def test_infobox_equals_line_rule(spark, seed):
    pieces = ["a", "b }} c", "{{Infobox", "x {{Infobox}} y", "", "}}", "{{infobox"]
    text = "\n".join(pieces[(seed * 7 + i * i * (seed + 3)) % len(pieces)] for i in range(9))
    got = apply(spark, text, lambda d: d.select(strip_infobox("body")))
    kept, _ = infobox_by_lines(text)
    assert [x for x in got.split("\n") if x] == [x for x in kept if x]


def test_long_page_does_not_overflow(spark):
    body = "{{Infobox x\n" + "| k = v\n" * 100_000 + "}}\n" + "word [[a|b]] " * 50_000 + "end."
    got = apply(spark, body, lambda d: with_plain_text(d, "body", "t").select("t"))
    assert got == "word b " * 50_000 + "end."


def paired_by_stack(text, opening, closing, separator, whole):
    """The same rule by a stack, one mark after another."""
    marks = [m for m in re.finditer("|".join(map(re.escape, filter(None, (opening, closing, separator)))), text)]
    stack, cut = [], []
    for m in marks:
        if m[0] == opening:
            stack.append([m, None])
        elif m[0] == separator and stack:
            stack[-1][1] = m
        elif m[0] == closing and stack:
            first, last = stack.pop()
            end = min((x.start() for x in marks if x.start() >= first.end()), default=len(text))
            cut += [(first.start(), m.end())] if whole(text[first.end() : end]) else [(first.start(), (last or first).end()), (m.start(), m.end())]
    # Separators of marks that are never closed belong to no pair, so a second look at who owns them is not needed.
    gone = {i for a, b in cut for i in range(a, b)}
    return "".join(c for i, c in enumerate(text) if i not in gone)


@pytest.mark.parametrize("seed", range(6))
def test_pairs_equal_a_stack(spark, seed):
    rng = random.Random(seed)
    pieces = ["[[", "[[", "]]", "]]", "|", "x", "F:", "é", "\n", "{{", "}}"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    links = with_steps(rows, paired_steps("out", "t", "[[", "]]", r"\[\[|\]\]|\|", "startswith({p}, 'F:')", "|"))
    assert {r.i: r.out for r in links.collect()} == {i: paired_by_stack(t, "[[", "]]", "|", lambda p: p.startswith("F:")) for i, t in enumerate(texts)}
    templates = with_steps(rows, paired_steps("out", "t", "{{", "}}", r"\{\{|\}\}"))
    assert {r.i: r.out for r in templates.collect()} == {i: paired_by_stack(t, "{{", "}}", "", lambda p: True) for i, t in enumerate(texts)}


@pytest.mark.parametrize("body,expected", [("{{" * 100_000 + "x" + "}}" * 100_000, 0), ("[[a|" * 70_000 + "x" + "]]" * 70_000, 1), ("[[File:a|" * 50_000 + "x" + "]]" * 50_000, 0)])
def test_deep_nesting_takes_seconds(spark, body, expected):
    began = time.monotonic()
    assert apply(spark, body, lambda d: with_plain_text(d, "body", "t").select(F.length("t"))) == expected
    assert time.monotonic() - began < 30


def test_redirect_words_of_languages(spark):
    rows = [("de", "#WEITERLEITUNG [[x]]"), ("fr", "#WEITERLEITUNG [[x]]"), ("nl", "\n #doorverwijzing[[x]]"), ("ru", "#ПЕРЕНАПРАВЛЕНИЕ [[x]]"), ("ja", "#転送 [[x]]"), ("xx", "#Redirect [[x]]"), ("fa", "#تغییر_مسیر [[x]]"), ("de", "Text #WEITERLEITUNG")]
    kept = with_text(spark.createDataFrame(rows, "lang string, body string")).collect()
    assert [tuple(r) for r in kept] == [rows[1], rows[7]]


@pytest.mark.parametrize("mark", ["{|", "<ref>", "<!--", "=", "{{", "[http://a ", "[["])
def test_a_megabyte_of_open_marks_is_linear(spark, mark):
    body = mark * (1_000_000 // len(mark)) + "x"
    began = time.monotonic()
    apply(spark, body, lambda d: with_plain_text(d, "body", "t").select(F.length("t")))
    assert time.monotonic() - began < 10


def content(spark, body, **options):
    return apply(spark, body, lambda d: with_content(d, **options).select("content"))


def test_content_limits(spark):
    assert content(spark, "a. " * 200) == ("a. " * 200)[:599].strip()
    assert content(spark, "x" * 599 + ".") == "x" * 599 + "."
    assert content(spark, "x" * 600 + ".") == ""
    assert content(spark, "no full stop") == ""
    assert content(spark, "日本語。終") == ""
    assert content(spark, "日本語。終", terminators=".。") == "日本語。"
    assert content(spark, "😀" * 599 + ".") == "😀" * 599 + "."
    assert content(spark, "a|b. c% %41.") == "ab. c% A."
    assert content(spark, "one. two", limit=4) == "one."


def test_stray_mark_goes_once(spark):
    stray = '\\n"'
    got = apply(spark, f"a{stray}b{stray}.", lambda d: with_steps(d, truncate_steps("body", "h")).select("h"))
    assert got == f"ab{stray}."


def test_sentence_cut_is_a_prefix(spark):
    for text in ["a.b", ".", "", "a\n.b\nc", "a..", "日.本"]:
        got = apply(spark, text, lambda d: d.select(F.expr(cut_sentence_sql("body"))))
        assert got == text[: text.rfind(".") + 1]


def test_website(spark):
    def site(body):
        return apply(spark, body, lambda d: d.select(infobox_website(F.col("body"))))

    assert site("{{Infobox\n| web = [http://a.b name of site]\n}}") == "http://a.b name of"
    assert site("| website = http://a.b/c") == "http://a.b/c"
    assert site("| Website=http://a.b") == "http://a.b"
    assert site("| web = [http://a.b x]\n| website = none") == "http://a.b"
    assert site("| web = [http://a.b x]\n| website = http://c.d") == "http://c.d"
    assert site("| web = [http://a.b]") == ""
    assert site("no box") == ""


def test_entities(spark):
    got = apply(spark, "&amp;lt; &gt;&nbsp;", lambda d: d.select(decode_entities(F.col("body"))))
    assert got == "< >& "


REGIONS = [
    ("", "", "", ""),
    ("A", "", "", ""),
    ("NL", "", "NL", ""),
    ("XYZ", "", "", ""),
    ("US-CA", "city", "US", "CA"),
    ("ABCD", "", "AB", "D"),
    ("", "country", "country", ""),
    ("", "Country", "Country", ""),
    ("", "city", "", ""),
    ("XYZ", "country", "", ""),
]


@pytest.mark.parametrize("region,kind,country,sub", REGIONS)
def test_country_and_region(spark, region, kind, country, sub):
    df = spark.createDataFrame([(region, kind)], "r string, t string")
    row = df.select(place.country(F.col("t"), F.col("r")), place.subdivision(F.col("r"))).first()
    assert tuple(row) == (country, sub)


def matched(spark, **values):
    row = {
        "lang": "nl", "wiki": "wikivoyage", "page_id": 1, "title": "A b%2541", "latitude": 1.0,
        "longitude": None, "poitype": "city", "region": "US-CA", "body": "Text.", **values,
    }
    schema = (
        "lang string, wiki string, page_id long, title string, latitude double, "
        "longitude double, poitype string, region string, body string"
    )
    return spark.createDataFrame([tuple(row.values())], schema)


def test_poi_row(spark):
    row = derive_poi(matched(spark)).first()
    assert [row[c] for c in POI_COLUMNS] == [
        "A b%41", 1.0, None, "US", "CA", "A b%2541",
        "(Wikipedia:  http://nl.wikipedia.org/wiki/A_b%41 ; Type: city ; Country_Region: US-CA)",
        "Text.",
    ]


def test_poi_website(spark):
    body = "{{Infobox\n| web = [http://a.b x]\n}}\nText."
    row = derive_poi(matched(spark, body=body, poitype="", region=""), website=True).first()
    assert row.REMARKS.endswith("A_b%41 ; Artikel url: http://a.b)")


@pytest.mark.parametrize("kind,city", [("city", True), ("City", True), ("city(500)", False), ("", False)])
def test_city(spark, kind, city):
    row = derive_poi(matched(spark, poitype=kind, title="T")).first()
    assert row.CITY == ("T" if city else "")


def test_text_rule(spark):
    rows = [("",), ("#REDIRECT [[x]]",), ("  #redirect x",), ("Text",), ("see #REDIRECT",)]
    kept = with_text(spark.createDataFrame(rows, "body string")).collect()
    assert [r.body for r in kept] == ["Text", "see #REDIRECT"]


def test_clean(spark):
    poi = derive_poi(matched(spark, title="A &amp; B", body="x &amp;amp;lt; y.")).unionByName(
        derive_poi(matched(spark, body="no stop"))
    )
    rows = clean_poi(poi).collect()
    assert [(r.NAME, r.CONTENT) for r in rows] == [("A & B", "x < y.")]


def test_labels(spark):
    df = spark.createDataFrame([("ja",), ("ru",), ("nl",), ("simple",)], "lang string")
    rows = {r.lang: r for r in with_labels(df).collect()}
    assert rows["ja"].wiki_label == "ウィキペディア"
    assert rows["ru"].article_label == "Статья URL: "
    assert (rows["simple"].label_code, rows["simple"].wiki_label) == ("en", "Wikipedia: ")
    assert rows["nl"].label_code == "nl"


NAMES = [
    ("/d/enwiki-latest-externallinks.sql.gz", ("en", "wikipedia", "links")),
    ("nlwikivoyage-latest-pages-articles.xml.bz2", ("nl", "wikivoyage", "articles")),
    ("/d/simplewiki-latest-pages-articles12.xml-p1p9.bz2", ("simple", "wikipedia", "articles")),
    ("/d/dewiki-latest-externallinks.sql.gz/part-0001.gz", ("de", "wikipedia", "links")),
    ("/d/enwiki-latest-pagelinks.sql.gz", (None, None, None)),
    ("/d/readme", (None, None, None)),
]


@pytest.mark.parametrize("path,expected", NAMES)
def test_dump_names(spark, path, expected):
    row = with_dump_identity(spark.createDataFrame([(path,)], "p string"), "p").first()
    assert (row.lang, row.wiki, row.content) == expected


def test_patterns_need_no_look_around():
    from poiweave.functions.wikitext import MARKUP

    for step in MARKUP:
        for pattern, _ in step.replacements:
            assert not re.search(r"\(\?[=!<]", pattern)
