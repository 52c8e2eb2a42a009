"""OSM nodes with tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.functions.coordinates import degrees_text
from poiweave.functions.entities import xml_characters
from poiweave.operators.numbering import number_rows
from poiweave.schemas import PARTITION_COLUMNS
from poiweave.sinks.gpx import description
from poiweave.sinks.layout import writer

# Fixed value: format name.
ROOT = 'osm version="0.5" generator="poiweave"'


def _tags() -> Column:
    region, country = F.col("REGION"), F.col("COUNTRY")
    # Tag keys in output order.
    pairs = [
        ("tourism", F.lit("user")),
        ("name", F.col("NAME")),
        ("addr:country", country),
        ("addr:province", F.when(country != "US", region).otherwise("")),
        ("addr:state", F.when(country == "US", region).otherwise("")),
        ("addr:city", F.col("CITY")),
        ("note", description()),
    ]
    tags = F.array(*[F.struct(F.lit(k).alias("_k"), xml_characters(v).alias("_v")) for k, v in pairs])
    return F.filter(tags, lambda tag: tag["_v"] != "")


def osm_nodes(poi: DataFrame) -> DataFrame:
    """Columns of the ``node`` element.

    The id is a counter per wiki and language in page order, followed by the digit 1.
    """
    return number_rows(poi, "_counter").select(
        (F.col("_counter") * 10 + 1).alias("_id"),
        F.lit("true").alias("_visible"),
        degrees_text(F.col("LATITUDE")).alias("_lat"),
        degrees_text(F.col("LONGITUDE")).alias("_lon"),
        _tags().alias("tag"),
        *PARTITION_COLUMNS,
    )


def osm_tags(poi: DataFrame) -> DataFrame:
    """One row per tag of each node."""
    return (
        osm_nodes(poi)
        .select(*PARTITION_COLUMNS, F.col("_id").alias("node_id"), F.explode("tag").alias("tag"))
        .select(*PARTITION_COLUMNS, "node_id", F.col("tag._k").alias("k"), F.col("tag._v").alias("v"))
    )


def write_osm(poi: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Give it a stored table: numbering reads three columns of its input besides. ``order`` sorts the nodes of each file by the columns
    given, of ``_id``, ``_lat`` and ``_lon``; ``NAME`` sorts by the first tags, of which the name is one."""
    by_element = {"NAME": "tag", "LATITUDE": "_lat", "LONGITUDE": "_lon"}
    writer(osm_nodes(poi), order=[by_element.get(c, c) for c in order]).format("xml").option("rootTag", ROOT).option("rowTag", "node").save(path)
