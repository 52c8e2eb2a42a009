"""Hand cases for map links: parameters, layouts, values, percent-decoding."""

from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from poiweave.functions.percent import percent_decode, percent_decode_sql
from poiweave.operators import links as lk
from poiweave.operators.dedup import keep_last, keep_last_window
from poiweave.operators.quality import with_reject_reason
from poiweave.sources.linkdump import link_tuples


def link(query, tail="','x.'"):
    return f"1,2,'http://h/geohack.php?pagename={query}{tail}"


def parse(spark, tuples, **options):
    df = spark.createDataFrame(list(enumerate(tuples)), "n int, tuple string")
    return {r.n: r for r in lk.geo_links(df, **options).collect()}


def one(spark, params, **options):
    return parse(spark, [link(f"T&params={params}")], **options).get(0)


# token count and east/west place -> latitude, longitude (None: dropped)
LAYOUTS = [
    ("46_8_2.15_N_64_51_42.86_W", (46 + 8 / 60 + 2.15 / 3600, -(64 + 51 / 60 + 42.86 / 3600))),
    ("46_8_2,15_S_64_51_42,5_E_x", (-(46 + 8 / 60 + 2.15 / 3600), 64 + 51 / 60 + 42.5 / 3600)),
    ("46_8_N_64_51_W_type:x_region:y", (46 + 8 / 60, -(64 + 51 / 60))),
    ("46_8,5_N_64_51,5_E", (46 + 8.5 / 60, 64 + 51.5 / 60)),
    ("46_8_S_64_51_E_type:x", (-(46 + 8 / 60), 64 + 51 / 60)),
    ("46.123_N_64.987_W", (46.123, -64.987)),
    ("46,5_S_64_E_type:x", (-46.5, 64.0)),
    ("46_N_64_E_a_b", (46.0, 64.0)),
    ("46_N_64_E_a_b_c", (46.0, 64.0)),
    ("46_N_64_E_a_b_c_d", None),
    ("46_N_64_e", None),
    ("46_N_64", None),
    ("46", None),
    ("", None),
    ("-46_8_N_64_51_E", (-46 + 8 / 60, 64 + 51 / 60)),
    ("46,1_8_2_N_64_51_42_E", (None, 64 + 51 / 60 + 42 / 3600)),
    ("x_N_5.5_E", (None, 5.5)),
    ("4_N_1d_E", (4.0, None)),
    ("NaN_N_0x1p3_E", (None, None)),
    ("0_S_0_W", (0.0, 0.0)),
]


@pytest.mark.parametrize("params,expected", LAYOUTS)
def test_layouts_and_values(spark, params, expected):
    row = one(spark, params)
    assert (row and (row.latitude, row.longitude)) == expected
    if expected == (0.0, 0.0):
        assert str(row.latitude) == "0.0"


def test_options(spark):
    assert one(spark, "46_N_64_E_a_b_c_d", extended_layouts=True).latitude == 46.0
    assert one(spark, "x_N_5.5_E", strict=True) is None
    assert one(spark, "95_N_5.5_E", strict=True) is None
    assert one(spark, "46_N_64_E", strict=True).longitude == 64.0


def test_fields(spark):
    rows = parse(
        spark,
        [
            link("A_b%20c&language=de&params=1_N_2_E_type:city(500)_region:US-CA_x"),
            link("B&params=1_N_2_E&params=3_N_4_E"),
            link("C&uselanguage=x&params=1_N_2_E"),
            link("D&params=1_N_2_E_type:city_type:type:town_region:"),
            "1,'geohack.php?params=1_N_2_E&pagename=E','x'",
            link("F&params=1_N_2_E", tail=""),
            link("G&xparams"),
            "1,'geohack.php?PageName=H&params=1_N_2_E','pagename'",
            link('a"b&params=1_N_2_E'),
            "1,'http://h/other?pagename=T&params=1_N_2_E','x'",
        ],
    )
    assert sorted(rows) == [0, 1, 2, 3, 7, 8]
    assert (rows[0].title, rows[0].language, rows[0].poitype, rows[0].region) == (
        "A_b c", "de", "city(500)", "US-CA",
    )
    assert rows[1].latitude == 3.0  # the last part wins
    assert rows[2].language == "usex"
    assert (rows[3].poitype, rows[3].region) == ("town", "")
    assert rows[7].title == "H"
    assert rows[8].title == 'a"b'
    assert parse(spark, [link("A_b&params=1_N_2_E")], normalize_title=True)[0].title == "A b"


def test_coordinates_before_the_page_name_are_not_inherited(spark):
    rows = parse(
        spark,
        [link("A&params=1_N_2_E"), "1,'geohack.php?params=9_N_9_E&pagename=E','x'"],
    )
    assert sorted(rows) == [0]


def test_reject_reasons(spark):
    tuples = [
        "1,'http://plain','x'",
        link("F&params=1_N_2_E", tail=""),
        link("G&xparams"),
        link("H&params=52_N"),
        link("I&params=1_N_2_E"),
    ]
    df = spark.createDataFrame(list(enumerate(tuples)), "n int, tuple string")
    found = [r.reason for r in with_reject_reason(df).orderBy("n").collect()]
    assert found == ["not_geo", "corrupt", "no_params", "layout", "kept"]


def test_tuples_of_a_line(spark):
    lines = [("a", "INSERT INTO `x` VALUES (1,'u'),(2,'v'),(3,'w);'"), ("b", "-- comment"), ("c", "x INSERT INTO")]
    df = spark.createDataFrame(lines, "line_ord string, value string")
    rows = [tuple(r) for r in link_tuples(df).orderBy("line_ord", "pos").collect()]
    assert rows == [
        ("a", 0, "INSERT INTO `x` VALUES (1,'u'"),
        ("a", 1, "2,'v'"),
        ("a", 2, "3,'w);'"),
        ("c", 0, "x INSERT INTO"),
    ]


@pytest.mark.parametrize(
    "text",
    ["100% x", "a+b%20c", "%zz", "%C3%A9", "%FF", "%2525", "%", "%4", "%E2%82", "é%41%", "", "%F0%9F%98%80"],
)
def test_percent_decode(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    row = df.select(percent_decode(F.col("s")), F.expr(percent_decode_sql("s"))).first()
    assert tuple(row) == (unquote(text), unquote(text))


def test_coordinates_survive_formatting(spark):
    """Degrees written as tokens come back, for a grid of places."""
    cells = [(d, m, s) for d in range(0, 90, 17) for m in (0, 7, 59) for s in (0, 12.5, 59.9)]
    tuples = [link(f"T&params={d}_{m}_{s}_S_{d}_{m}_{s}_W") for d, m, s in cells]
    rows = parse(spark, tuples)
    for n, (d, m, s) in enumerate(cells):
        expected = 0.0 - (d + m / 60 + s / 3600)
        assert rows[n].latitude == rows[n].longitude == expected


def test_keep_last(spark):
    rows = [("a", 1, "x"), ("b", 5, "y"), ("a", 3, "z"), ("a", 2, None)]
    df = spark.createDataFrame(rows, "title string, k int, v string")
    expected = [("a", 3, "z"), ("b", 5, "y")]
    for fn in (keep_last, keep_last_window):
        once = fn(df, ["title"], ["k"])
        assert sorted(map(tuple, once.collect())) == expected
        assert sorted(map(tuple, fn(once, ["title"], ["k"]).collect())) == expected
