"""Points of interest from matched articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.functions import place
from poiweave.functions.content import MAX_CHARACTERS, content_steps
from poiweave.functions.entities import decode_entities
from poiweave.functions.percent import percent_decode
from poiweave.functions.steps import with_steps
from poiweave.functions.wikitext import infobox_website, with_plain_text
from poiweave.operators.match import KEYS, match_articles
from poiweave.operators.once import computed_once
from poiweave.schemas import POI_COLUMNS, POI_TEXT_COLUMNS
from poiweave.sources.articledump import with_body
from poiweave.sources.catalog import with_labels
from poiweave.sources.namespaces import is_redirect, with_link_words


def drop_redirects(articles: DataFrame) -> DataFrame:
    """Redirects begin with a word of the wiki's language, or with the English one."""
    return articles.filter(~is_redirect("body", "lang" in articles.columns))


def drop_marked_redirects(pages: DataFrame) -> DataFrame:
    """Raw pages that the dump itself marks as redirects go before they are parsed. Page text is escaped and cannot hold the mark."""
    return pages.filter(~F.contains("page", F.lit("<redirect ")))


def with_text(articles: DataFrame) -> DataFrame:
    """Articles with a body that is neither empty nor a redirect."""
    return drop_redirects(articles.filter(F.col("body") != ""))


def with_content(
    articles: DataFrame, limit: int = MAX_CHARACTERS, terminators: str = ".", namespaces: DataFrame | None = None
) -> DataFrame:
    """Adds ``content``: the body cleaned, truncated, cut and decoded, in this order.

    ``namespaces`` are the names that the dumps' own headers give media and categories.
    """
    cleaned = with_plain(articles, namespaces)
    cut = with_steps(cleaned, content_steps("plain", "content", limit, terminators))
    return computed_once(cut, {"content": F.col("content")}, drop=("plain",))


def with_plain(articles: DataFrame, namespaces: DataFrame | None = None) -> DataFrame:
    """Adds ``plain``: the readable text of the body, without the media and category links of its language."""
    if "lang" not in articles.columns:
        return with_plain_text(articles, "body", "plain")
    worded = with_link_words(articles, namespaces, "_link_words")
    return with_plain_text(worded, "body", "plain", "_link_words").drop("_link_words")


def derive_poi(
    matched: DataFrame,
    limit: int = MAX_CHARACTERS,
    terminators: str = ".",
    website: bool = False,
    namespaces: DataFrame | None = None,
) -> DataFrame:
    """The eight columns from a matched article, after any columns to carry along.

    Needs ``lang``, ``title``, ``body`` and the link columns; carries ``wiki``,
    ``lang`` and ``page_id``.
    """
    title, poitype, region = F.col("title"), F.col("poitype"), F.col("region")
    site = None
    if website:
        matched = computed_once(matched, {"website": infobox_website(F.col("body"))})
        address = F.col("website")
        site = F.when(address != "", F.concat(F.col("article_label"), address)).otherwise("")
    url = place.page_url(F.col("wiki_label"), F.col("lang"), title)
    remarks = place.remarks(url, poitype, region, site)
    return with_labels(with_content(matched, limit, terminators, namespaces)).select(
        "wiki",
        "lang",
        "page_id",
        percent_decode(title).alias("NAME"),
        F.col("latitude").alias("LATITUDE"),
        F.col("longitude").alias("LONGITUDE"),
        place.country(poitype, region).alias("COUNTRY"),
        place.subdivision(region).alias("REGION"),
        place.city(poitype, title).alias("CITY"),
        percent_decode(remarks).alias("REMARKS"),
        F.col("content").alias("CONTENT"),
    )


def emitted_articles(
    articles: DataFrame, links: DataFrame, on: list[str] = KEYS, small_links: bool = False
) -> DataFrame:
    """Articles with a link and a text: one point of interest each.

    Join first, then parse: only pages with a link are worth the work.  ``articles``
    holds either raw ``page`` records or a ``body`` column.
    """
    matched = match_articles(articles, links, on, small_links)
    if "body" not in matched.columns:
        matched = with_body(drop_marked_redirects(matched))
    return with_text(matched)


def build_poi(
    articles: DataFrame,
    links: DataFrame,
    on: list[str] = KEYS,
    small_links: bool = False,
    **options,
) -> DataFrame:
    return derive_poi(emitted_articles(articles, links, on, small_links), **options)


def decode_poi_entities(poi: DataFrame) -> DataFrame:
    return poi.withColumns({c: decode_entities(F.col(c)) for c in POI_TEXT_COLUMNS})


def clean_poi(poi: DataFrame) -> DataFrame:
    """Entities decoded, rows without content dropped."""
    return decode_poi_entities(poi).filter(F.col("CONTENT") != "")


def poi_columns(poi: DataFrame) -> DataFrame:
    return poi.select(*POI_COLUMNS)
