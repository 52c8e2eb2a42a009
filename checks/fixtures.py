"""Input views derived from the given tables (see FIXTURES.md).

Text is built by expressions that Spark and DuckDB both accept; the oracles reuse the
text expressions, never the parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poiweave.functions.entities import ESCAPED
from poiweave.functions.steps import with_steps
from poiweave.operators.once import computed_once
from poiweave.operators.spread import spread

Q = "chr(39)"
NL = "chr(10)"
TUPLES_PER_LINE = 50


def _div(x: str, n: int) -> str:
    return f"cast(floor({x} / {n}) as bigint)"


def _str(x: str) -> str:
    return f"cast({x} as string)"


def _tenths(x: str) -> str:
    """Text of (x % 599) / 10 with one digit, from integers."""
    return f"{_str(_div(f'({x} % 599)', 10))} || '.' || {_str(f'({x} % 599) % 10')}"


def title_of(c: str) -> str:
    """Title of place ``c`` as a link decodes to it."""
    return f"""case {c} % 10
        when 3 then 'Ort Zürich ' || {_str(c)}
        when 5 then 'A & B ' || {_str(c)}
        when 7 then '100% ' || {_str(c)}
        when 9 then 'Place_' || {_str(c)}
        else 'Place ' || {_str(c)} end"""


def encoded_title_of(c: str) -> str:
    return f"""case {c} % 10
        when 3 then 'Ort%20Z%C3%BCrich%20' || {_str(c)}
        when 5 then 'A%20%26%20B%20' || {_str(c)}
        when 7 then '100%25%20' || {_str(c)}
        when 9 then 'Place_' || {_str(c)}
        else 'Place%20' || {_str(c)} end"""


NS = f"case when {_div('k', 12)} % 2 = 0 then 'N' else 'S' end"
# Links of a title come from the dumps of several languages, with different coordinates.
LINK_LANG = "case k % 5 when 0 then 'de' when 1 then 'fr' when 2 then 'es' else 'en' end"
EW = f"case when {_div('k', 24)} % 2 = 0 then 'E' else 'W' end"
_DMS = (
    f"concat_ws('_', k % 90, c % 60, {_tenths('k')}, {NS}, "
    f"c % 180, k % 60, {_tenths('c')}, {EW})"
)
_DM = f"concat_ws('_', k % 90, c % 60, {NS}, c % 180, k % 60, {EW})"


def _dec(point: str) -> str:
    return (
        f"concat_ws('_', concat(k % 90, '{point}', c % 10), {NS}, "
        f"concat(c % 180, '{point}', k % 10), {EW})"
    )


def _geo_tuple(dms: str, dm: str, dec: str, dec_comma: str, title: str) -> str:
    """Map-link tuple from its position texts."""
    params = f"""case k % 12
        when 0 then {dms}
        when 1 then concat({dms}, '_type:city_region:US-CA')
        when 2 then {dm}
        when 3 then concat({dm}, '_type:landmark_region:NL')
        when 4 then {dec}
        when 5 then {dec_comma}
        when 6 then concat({dec}, '_type:City_region:DE-BY')
        when 7 then concat({dec}, '_type:city_region:XYZ_dim:10_scale:5')
        when 8 then 'abc_N_1234567_E_type:country'
        when 9 then '52_N'
        else '' end"""
    return f"""concat(k, ',', c, ',', {Q}, 'http://maps.example/geohack.php?pagename=', {title},
        '&language=en', case when k % 12 = 10 then '&xparams' else '&params=' end, {params},
        case when k % 12 = 11 then ''
            else concat({Q}, ',', {Q}, 'http://example.maps.', {Q}) end)"""


GEO_TUPLE = _geo_tuple(_DMS, _DM, _dec("."), _dec(","), encoded_title_of("c"))
# The same, its parts first.
GEO_TUPLE_STEPS = {
    "_dms": _DMS,
    "_dm": _DM,
    "_dec": _dec("."),
    "_dec_comma": _dec(","),
    "_title": encoded_title_of("c"),
    "tuple": _geo_tuple("_dms", "_dm", "_dec", "_dec_comma", "_title"),
}

# A link that is no map link, between the map links of a dump.
PLAIN_TUPLE = (
    f"{_str('k')} || ',' || {_str('c')} || ',' || {Q} || 'http://plain.example/' || {_str('k')} || {Q}"
    f" || ',' || {Q} || 'http://example.plain.' || {Q}"
)


# Words of the wikis' languages, and one for each language that only the dump's header knows.
MEDIA_WORD = "case lang when 'de' then 'Datei' when 'fr' then 'Fichier' when 'es' then 'Archivo' else 'Image' end"
OWN_WORDS = [("de", "Lichtbild"), ("fr", "Vue"), ("es", "Foto"), ("en", "Picture")]
OWN_WORD = "case lang when 'de' then 'Lichtbild' when 'fr' then 'Vue' when 'es' then 'Foto' else 'Picture' end"
REDIRECT_WORD = """case lang when 'de' then '#WEITERLEITUNG' when 'fr' then '#REDIRECTION'
        when 'es' then '#REDIRECCIÓN' else '#REDIRECT' end"""


def body_of(doc: str = "doc_id", text: str = "text", media: str = MEDIA_WORD) -> str:
    """Page body of a document: its text in six kinds of markup, with words of its ``lang``."""
    q3 = f"{Q} || {Q} || {Q}"
    return f"""case {doc} % 6
        when 0 then {text}
        when 1 then '{{{{Infobox x' || {NL} || '| web = [http://w.example/' || {_str(doc)} || ' site]'
            || {NL} || '}}}}' || {NL} || {text}
        when 2 then {q3} || 'Bold' || {q3} || ' [[Place 1|first]] and [[Second]]. '
            || '[[' || {media} || ':a.jpg|thumb|A view of [[Paris]] by [[night|[http://e.example dark]]]]]' || {text}
        when 3 then '<!-- c -->' || {text} || '<ref name="a">note</ref>' || {NL} || '== Head ==' || {NL}
            || '{{| a' || {NL} || '|}}' || '<nowiki>x</nowiki>'
        when 4 then repeat('{{{{a ', 6) || 'b' || repeat(' c}}}}', 6) || {text} || ' [http://e.example label]'
        else {REDIRECT_WORD} || ' [[Place 1]]' end"""


ARTICLE_TITLE = f"""case when doc_id % 10 = 9 then 'Place ' || {_str('doc_id')}
        else {title_of('doc_id')} end"""
WIKI = "case when doc_id % 4 = 0 then 'wikivoyage' else 'wikipedia' end"

MANY_LANGUAGES = """case doc_id % 11 when 0 then 'ja' when 1 then 'ru' when 2 then 'nl'
        when 3 then 'no' when 4 then 'cs' when 5 then 'pl' when 6 then 'simple' else lang end"""

# Every eighth text starts with two stray marks: backslash, n, quote.
_STRAY = "chr(92) || 'n' || chr(34)"
STRAY_TEXT = f"""case when doc_id % 8 = 0 then 'x' || {_STRAY} || 'y' || {_STRAY} || 'z' || text
        else text end"""

DUMP_PATH = """'/data/dumps/' || lang || case when doc_id % 4 = 0 then 'wikivoyage' else 'wiki' end ||
        case doc_id % 3 when 0 then '-latest-pages-articles.xml.bz2'
            when 1 then '-latest-externallinks.sql.gz' else '-20150501-stub.xml' end"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One map-link tuple per order: ``k`` (dump order), ``c``, ``lang``, ``tuple``."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "o_custkey as c")
    keyed = spread(orders, "k").withColumn("lang", F.expr(LINK_LANG))
    return computed_once(with_steps(keyed, GEO_TUPLE_STEPS), {"tuple": F.col("tuple")})


def link_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump lines: the tuples of fifty order keys each, and a comment every ten lines.

    Every third order adds a plain link after its map link.
    """
    items = links(spark, sf_dir).selectExpr(
        "lang",
        f"{_div('k', TUPLES_PER_LINE)} as line_ord",
        "k",
        f"case when k % 3 = 0 then array(tuple, {PLAIN_TUPLE}) else array(tuple) end as items",
    )
    # At most fifty entries per group, by construction of the key.
    grouped = items.groupBy("lang", "line_ord").agg(
        F.array_sort(F.collect_list(F.struct("k", "items"))).alias("entries")
    )
    joined = F.array_join(F.flatten(F.col("entries.items")), "),(")
    insert = F.concat(F.lit("INSERT INTO x VALUES ("), joined, F.lit(");"))
    comment = F.concat(F.lit("-- dump part "), F.col("line_ord").cast("string"))
    lines = F.when(F.col("line_ord") % 10 == 0, F.array(comment, insert)).otherwise(F.array(insert))
    return grouped.select("lang", "line_ord", F.explode(lines).alias("value"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles without their bodies."""
    return table(spark, sf_dir, "documents").selectExpr(
        "lang", f"{WIKI} as wiki", "doc_id as page_id", f"{ARTICLE_TITLE} as title"
    )


def articles(spark: SparkSession, sf_dir: str, media: str = MEDIA_WORD) -> DataFrame:
    """One article per document: ``lang``, ``wiki``, ``page_id``, ``title``, ``body``."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    documents = spread(documents, "doc_id")
    made = {"wiki": WIKI, "page_id": "doc_id", "title": ARTICLE_TITLE, "body": body_of(media=media)}
    columns = {name: F.expr(text) for name, text in made.items()}
    return computed_once(documents, columns, drop=("doc_id", "text"))


def _escaped(col: Column) -> Column:
    for old, new in ESCAPED:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def article_records(spark: SparkSession, sf_dir: str, media: str = MEDIA_WORD) -> DataFrame:
    """Dump records as the line reader returns them, without the closing page tag.

    Some records carry the file header before the page, some are only the file trailer.
    """
    text_tag = F.when(
        F.col("page_id") % 2 == 1, F.lit('<text bytes="1" xml:space="preserve">')
    ).otherwise(F.lit('<text xml:space="preserve">'))
    page = F.concat(
        F.when(
            F.col("page_id") % 50 == 0,
            F.lit("<mediawiki>\n  <siteinfo>\n    <sitename>x</sitename>\n  </siteinfo>\n"),
        ).otherwise(F.lit("\n")),
        F.lit("  <page>\n    <title>"),
        _escaped(F.col("title")),
        F.lit("</title>\n    <ns>0</ns>\n    <id>"),
        F.col("page_id").cast("string"),
        F.lit("</id>\n    <revision>\n      <id>7</id>\n      "),
        text_tag,
        _escaped(F.col("body")),
        F.lit("</text>\n    </revision>\n  "),
    )
    records = F.when(
        F.col("page_id") % 97 == 0, F.array(page, F.lit("\n</mediawiki>\n"))
    ).otherwise(F.array(page))
    return articles(spark, sf_dir, media).select("lang", "wiki", F.explode(records).alias("value"))
