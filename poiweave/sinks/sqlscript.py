"""SQL scripts: table definition, one INSERT per row, index.

A script is three sections, ``1_table``, ``2_rows`` and ``3_index``, in directories of
that name; their files in name order make one runnable script.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.schemas import LINK_SCHEMA, PARTITION_COLUMNS, POI_COLUMNS
from poiweave.sinks.layout import balanced

# Column definitions of the two tables.
POI_FIELDS = (
    "(TITLE TEXT, LATITUDE FLOAT, LONGITUDE FLOAT, COUNTRY TEXT, REGION TEXT, CITY TEXT, "
    "REMARKS TEXT, CONTENT TEXT)"
)
LINK_FIELDS = (
    "(TITLE TEXT, LATITUDE FLOAT, LONGITUDE FLOAT, LANGUAGE TEXT, POITYPE TEXT, REGION TEXT)"
)
# Columns that the inserts of the POI table name, and the indexes.
POI_INSERT_FIELDS = "(TITLE, LATITUDE, LONGITUDE, COUNTRY, REGION, CITY, REMARKS, CONTENT)"
POI_INDEXES = {"TITLE": "(TITLE)"}
LINK_INDEXES = {"TITLE": "(TITLE)", "LATLON": "(LATITUDE, LONGITUDE)"}
MAX_ROWS_PER_FILE = 1_000_000


def _text(col: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(col, F.lit("'"), F.lit("''")), F.lit("'"))


def _number(col: Column) -> Column:
    """Whole precision, as the double prints."""
    return F.coalesce(col.cast("string"), F.lit("NULL"))


def _insert(table: Column, columns: list[str], fields: str = "") -> Column:
    """``fields`` is the list of columns that the statement names."""
    numbers = {"latitude", "longitude"}
    values = [(_number if c.lower() in numbers else _text)(F.col(c)) for c in columns]
    opening = F.lit(f" {fields} values (" if fields else " values (")
    return F.concat(F.lit("insert into "), table, opening, F.concat_ws(",", *values), F.lit(");"))


def poi_table_name() -> Column:
    return F.concat_ws("_", "lang", "wiki")


def link_table_name() -> Column:
    return F.concat_ws("_", "lang", F.lit("externallinks"))


def poi_inserts(poi: DataFrame) -> DataFrame:
    line = _insert(poi_table_name(), POI_COLUMNS, POI_INSERT_FIELDS)
    return poi.select(*PARTITION_COLUMNS, "page_id", line.alias("line"))


def link_inserts(links: DataFrame) -> DataFrame:
    """Give it links without duplicates; the script then needs no delete."""
    return links.select(
        "lang", "title", _insert(link_table_name(), LINK_SCHEMA.fieldNames()).alias("line")
    )


def _write(
    inserts: DataFrame, keys: list[str], table: Column, fields: str, path: str, gzip: bool, indexes: dict[str, str]
) -> None:
    definition = F.concat(
        F.lit("drop table if exists "), table, F.lit(";\ncreate table "), table, F.lit(f" {fields};")
    )
    made = [F.concat(F.lit("create index "), table, F.lit(f"_{name} on "), table, F.lit(f"{on};")) for name, on in indexes.items()]
    index = F.concat_ws("\n", *made)
    frame = F.explode(
        F.array(
            F.struct(F.lit("1_table").alias("section"), definition.alias("line")),
            F.struct(F.lit("3_index").alias("section"), index.alias("line")),
        )
    )
    ends = inserts.select(*keys).distinct().select(*keys, frame.alias("end")).select(*keys, "end.*")
    rows = inserts.select(*keys, F.lit("2_rows").alias("section"), "line")
    (
        balanced(rows.unionByName(ends), [*keys, "section"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .option("compression", "gzip" if gzip else "none")
        .partitionBy(*keys, "section")
        .text(path)
    )


def write_poi_sql(poi: DataFrame, path: str, gzip: bool = True) -> None:
    _write(poi_inserts(poi), PARTITION_COLUMNS, poi_table_name(), POI_FIELDS, path, gzip, POI_INDEXES)


def write_link_sql(links: DataFrame, path: str, gzip: bool = False) -> None:
    _write(link_inserts(links), ["lang"], link_table_name(), LINK_FIELDS, path, gzip, LINK_INDEXES)
