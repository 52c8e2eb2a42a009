"""GPX 1.0 way points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.functions.coordinates import degrees_text
from poiweave.functions.entities import xml_characters
from poiweave.schemas import PARTITION_COLUMNS
from poiweave.sinks.layout import writer

# Fixed value: format name and namespace.
ROOT = 'gpx version="1.0" creator="poiweave" xmlns="http://www.topografix.com/GPX/1/0"'


def description() -> Column:
    return F.concat_ws(" ", "REMARKS", "CONTENT")


def waypoints(poi: DataFrame) -> DataFrame:
    """Columns of the ``wpt`` element; ``_`` marks an attribute."""
    return poi.select(
        degrees_text(F.col("LATITUDE")).alias("_lat"),
        degrees_text(F.col("LONGITUDE")).alias("_lon"),
        xml_characters(F.col("NAME")).alias("name"),
        xml_characters(description()).alias("desc"),
        *PARTITION_COLUMNS,
    )


def write_gpx(poi: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """``order`` sorts the way points of each file by the columns given, of ``name``, ``_lat`` and ``_lon``."""
    by_element = {"NAME": "name", "LATITUDE": "_lat", "LONGITUDE": "_lon"}
    writer(waypoints(poi), order=[by_element.get(c, c) for c in order]).format("xml").option("rootTag", ROOT).option("rowTag", "wpt").save(path)
