"""Stored tables: CSV and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poiweave.schemas import (
    LINK_TABLE_SCHEMA,
    PARTITION_COLUMNS,
    PARTITION_SCHEMA,
    POI_COLUMNS,
    POI_SCHEMA,
    POI_TABLE_SCHEMA,
    POI_TEXT_COLUMNS,
)
from poiweave.sinks.swap import recover
from poiweave.sources.csvrecords import parsed, read_records

BAD_ROW = "_bad_row"


def read_poi_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Eight quoted columns with a header, partitioned by wiki and language.

    ``multi_line`` allows line ends inside fields; files are read in splits either way. Without it, where no field holds
    one, no line is moved.
    """
    if multi_line:
        records = read_records(spark, path).filter(~F.col("first") & (F.col("record") != ""))
        rows = records.select(parsed(POI_SCHEMA, {}).alias("row"), *PARTITION_COLUMNS).select("row.*", *PARTITION_COLUMNS)
    else:
        reader = spark.read.schema(T.StructType(POI_SCHEMA.fields + PARTITION_SCHEMA.fields))
        rows = reader.option("escape", '"').option("mode", "PERMISSIVE").option("header", True).csv(path)
    return rows.na.fill("", POI_TEXT_COLUMNS)


def read_csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV record as text fields, blank lines as records without any; a malformed one is also kept whole in ``_bad_row``. ``lines`` are
    the lines that a record takes."""
    fields = T.StructType([T.StructField(c, T.StringType()) for c in [*POI_COLUMNS, BAD_ROW]])
    row = F.when(F.col("record") != "", parsed(fields, {"columnNameOfCorruptRecord": BAD_ROW})).alias("row")
    return read_records(spark, path).select(row, "lines", *PARTITION_COLUMNS).select("row.*", "lines", F.isnull("row").alias("blank"), *PARTITION_COLUMNS)


def read_table(
    spark: SparkSession,
    path: str,
    wiki: str | list[str] | None = None,
    lang: str | list[str] | None = None,
) -> DataFrame:
    """Stored points of interest; ``wiki`` and ``lang`` prune the partitions.

    The schema is explicit, so a table without rows can be read. A replacement that a run decided and did not
    finish is finished first.
    """
    recover(spark, path)
    return _pruned(spark.read.schema(POI_TABLE_SCHEMA).parquet(path), wiki, lang)


def read_link_table(
    spark: SparkSession, path: str, lang: str | list[str] | None = None
) -> DataFrame:
    """Stored links; ``lang`` prunes the partitions. See ``read_table``."""
    recover(spark, path)
    return _pruned(spark.read.schema(LINK_TABLE_SCHEMA).parquet(path), None, lang)


def _pruned(
    df: DataFrame, wiki: str | list[str] | None, lang: str | list[str] | None
) -> DataFrame:
    for column, wanted in (("wiki", wiki), ("lang", lang)):
        if wanted is not None:
            df = df.filter(df[column].isin([wanted] if isinstance(wanted, str) else wanted))
    return df


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes that a stored table takes on disk."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(location):
        return 0
    return system.getContentSummary(location).getLength()
