"""Explicit schemas; nothing in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

LINK_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("language", T.StringType()),
        T.StructField("poitype", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

# Order and names of the eight published columns.
POI_COLUMNS = [
    "NAME",
    "LATITUDE",
    "LONGITUDE",
    "COUNTRY",
    "REGION",
    "CITY",
    "REMARKS",
    "CONTENT",
]

POI_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in ("LATITUDE", "LONGITUDE") else T.StringType())
        for c in POI_COLUMNS
    ]
)

POI_TEXT_COLUMNS = [f.name for f in POI_SCHEMA if isinstance(f.dataType, T.StringType)]

# One output per wiki and language becomes two partition columns of one table.
PARTITION_COLUMNS = ["wiki", "lang"]
PARTITION_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS])

# Stored tables: their files' columns and the partition columns.
# Where a link stands in its language's dumps: number of the dump, file, start of the split, line, place in the line.
LINK_ORDER = "dump_order"
LINK_ORDER_SCHEMA = T.StructType(
    [
        T.StructField("number", T.IntegerType()),
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("line", T.LongType()),
        T.StructField("place", T.IntegerType()),
    ]
)
LINK_TABLE_SCHEMA = T.StructType(
    [*LINK_SCHEMA.fields, T.StructField(LINK_ORDER, LINK_ORDER_SCHEMA), T.StructField("lang", T.StringType())]
)
POI_TABLE_SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType()), *POI_SCHEMA.fields, *PARTITION_SCHEMA.fields]
)
