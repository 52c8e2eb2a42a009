"""Derived columns of a point of interest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def page_url(wiki_label: Column, lang: Column, title: Column) -> Column:
    """Label and address of the encyclopedia page; travel-guide pages use it too."""
    return F.concat(
        wiki_label,
        F.lit(" http://"),
        lang,
        F.lit(".wikipedia.org/wiki/"),
        F.replace(title, F.lit(" "), F.lit("_")),
    )


def city(poitype: Column, title: Column) -> Column:
    return F.when(poitype.isin("city", "City"), title).otherwise("")


def country(poitype: Column, region: Column) -> Column:
    """First two letters of the region; without a region, the type word of a country."""
    size = F.length(region)
    return (
        F.when((size >= 4) | (size == 2), F.substring(region, 1, 2))
        .when((size == 0) & poitype.isin("country", "Country"), poitype)
        .otherwise("")
    )


def subdivision(region: Column) -> Column:
    """The region after country and separator."""
    return F.when(
        F.length(region) >= 4, F.substring(region, F.lit(4), F.length(region))
    ).otherwise("")


def remarks(url: Column, poitype: Column, region: Column, website: Column | None = None) -> Column:
    """Parenthesised page address with the type and region parts that are present."""

    def part(label: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(label), value)).otherwise("")

    middle = [] if website is None else [part(" ; ", website)]
    return F.concat(
        F.lit("("),
        url,
        *middle,
        part(" ; Type: ", poitype),
        part(" ; Country_Region: ", region),
        F.lit(")"),
    )
