"""Joins of articles with geo-links on the exact title.

Links are unique on the join key, so their rows spread evenly over the join's partitions. Beyond
the broadcast limit the join is left to Spark: its sorted form spills, whatever the size of the link table, and AQE splits
a title that many articles share, or builds hash tables where all partitions are small enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["lang", "title"]


def normalized(df: DataFrame) -> DataFrame:
    """``_`` in titles as a space.  Apply to links before the duplicates are removed."""
    return df.withColumn("title", F.replace("title", F.lit("_"), F.lit(" ")))


def match_articles(
    articles: DataFrame, links: DataFrame, on: list[str] = KEYS, small_links: bool = False
) -> DataFrame:
    """Articles that have a link, with the link's columns.  ``links`` is unique on ``on``.

    ``small_links`` broadcasts the links and spares the shuffle of article bodies.  Set it
    only where their stored size has been checked, as the article job does.
    """
    extra = [c for c in links.columns if c in on or c not in articles.columns]
    right = links.select(*extra)
    right = F.broadcast(right) if small_links else right
    return articles.join(right, on, "inner")


def unmatched_articles(articles: DataFrame, links: DataFrame, on: list[str] = KEYS) -> DataFrame:
    return articles.join(links.select(*on), on, "left_anti")


def unmatched_links(articles: DataFrame, links: DataFrame, on: list[str] = KEYS) -> DataFrame:
    return links.join(articles.select(*on), on, "left_anti")


def match_rate(articles: DataFrame, links: DataFrame, on: list[str] = KEYS) -> DataFrame:
    """Articles, matched articles and their ratio per language."""
    flagged = links.select(*on).withColumn("_matched", F.lit(True))
    return (
        articles.select(*dict.fromkeys(["lang", *on]))
        .join(flagged, on, "left")
        .groupBy("lang")
        .agg(
            F.count("*").alias("articles"),
            F.count("_matched").alias("matched"),
        )
        .withColumn("rate", F.col("matched") / F.col("articles"))
    )
