"""Counts and integrity reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiweave.functions.coordinates import in_range
from poiweave.operators.links import is_geo_link, link_fields, with_coordinates, with_layout
from poiweave.schemas import PARTITION_COLUMNS
from poiweave.sources.tables import BAD_ROW, read_csv_rows


def with_reject_reason(tuples: DataFrame, extended_layouts: bool = False) -> DataFrame:
    """First test a tuple fails: ``not_geo``, ``corrupt``, ``no_params``, ``layout``; else ``kept``.

    Tuples that are no map link, nearly all of a dump, are blanked before the parsing.
    """
    marked = tuples.select("*", is_geo_link(F.col("tuple")).alias("_geo"))
    blanked = marked.select(
        *tuples.columns, "_geo", F.col("tuple").alias("_whole")
    ).withColumn("tuple", F.when(F.col("_geo"), F.col("tuple")))
    tested = with_layout(link_fields(blanked), extended_layouts)
    reason = (
        F.when(~F.col("_geo"), "not_geo")
        .when(F.col("slice").isNull(), "corrupt")
        .when(F.col("tokens").isNull(), "no_params")
        .when(F.col("layout").isNull(), "layout")
        .otherwise("kept")
    )
    return tested.withColumn("tuple", F.col("_whole")).select(
        *tuples.columns, reason.alias("reason")
    )


def link_reject_reasons(tuples: DataFrame) -> DataFrame:
    return with_reject_reason(tuples).groupBy("lang", "reason").agg(F.count("*").alias("tuples"))


def link_scan_counts(tuples: DataFrame) -> DataFrame:
    """Tuples scanned and links kept per language, before duplicates are removed."""
    return (
        with_reject_reason(tuples)
        .groupBy("lang")
        .agg(F.count("*").alias("tuples"), F.count_if(F.col("reason") == "kept").alias("kept"))
    )


def poi_counts(poi: DataFrame) -> DataFrame:
    """Per wiki and language; takes stored points or emitted articles."""
    return poi.groupBy(*PARTITION_COLUMNS).agg(F.count("*").alias("pois"))


def coord_quality(geo: DataFrame) -> DataFrame:
    """Per layout: links, axes that are not a number, pairs off the globe."""
    lat, lon = F.col("latitude"), F.col("longitude")
    placed = with_coordinates(with_layout(link_fields(geo))).filter(F.col("layout").isNotNull())
    return placed.groupBy("layout").agg(
        F.count("*").alias("links"),
        F.count_if(lat.isNull()).alias("bad_latitude"),
        F.count_if(lon.isNull()).alias("bad_longitude"),
        F.count_if(lat.isNotNull() & lon.isNotNull() & ~in_range(lat, lon)).alias("out_of_range"),
        F.count_if(in_range(lat, lon)).alias("valid"),
    )


def csv_integrity(spark: SparkSession, path: str) -> DataFrame:
    """Correct rows (headers included), wrong rows and physical lines per wiki and language, from one scan.

    A row is wrong when it has not eight fields or a broken quote; every one counts. Blank lines are no rows.
    """
    rows = read_csv_rows(spark, path)
    wrong = F.col(BAD_ROW).isNotNull()
    return rows.groupBy(*PARTITION_COLUMNS).agg(
        F.count_if(~F.col("blank") & ~wrong).alias("correct_rows"),
        F.count_if(~F.col("blank") & wrong).alias("wrong_rows"),
        F.sum("lines").alias("lines"),
    )
