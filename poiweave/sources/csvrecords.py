"""CSV records with line ends in their fields, cut in parallel.

A reader that allows line ends in fields takes a file in one task, as only the quotes before a place say whether it is inside a
field. Here lines are read in splits and their quotes counted. Whether a split begins inside a field is the parity of all quotes
before it, a sum over the splits of a file, of which there are few. With that each line knows whether a record ends
with it; the lines of a record are then joined. Lines move twice, by split and by record; nothing is in the order of the
whole file.

Quotes inside a field are doubled, as in RFC 4180, so they do not change the parity. Lines end in ``\\n`` or ``\\r\\n``; line
ends inside a field stay as they are. A field that is never closed takes the rest of its file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poiweave.schemas import PARTITION_COLUMNS, PARTITION_SCHEMA

_SPLIT = ["_file", "_block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the split they are read in, their order there, and how many quotes they hold."""
    schema = T.StructType([T.StructField("value", T.StringType()), *PARTITION_SCHEMA.fields])
    files = spark.read.schema(schema).option("lineSep", "\n").text(path)
    return files.select(
        *PARTITION_COLUMNS,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
        (F.length("value") - F.length(F.translate("value", '"', ""))).alias("_quotes"),
    )


def _starts(counted: DataFrame) -> DataFrame:
    """For each split: whether it begins inside a field, how many records end in it, and the split that began the
    record which is open at its beginning."""
    splits = counted.groupBy(*_SPLIT).agg(
        (F.sum("_quotes") % 2).alias("_odd"), F.count_if(~F.col("_inside")).alias("_even_ends"), F.count_if("_inside").alias("_odd_ends")
    )
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    opened = splits.withColumn("_open", F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2 == 1)
    ended = opened.withColumn("_ends", F.when(F.col("_open"), F.col("_odd_ends")).otherwise(F.col("_even_ends")))
    begun = F.when(~F.col("_open") | (F.col("_ends") > 0), F.col("_block"))
    return ended.withColumn("_owner", F.last(begun, ignorenulls=True).over(before)).select(*_SPLIT, "_open", "_ends", "_owner")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Wiki, language, ``record`` (without its line end), ``lines`` and whether it is the ``first`` of its file.

    Blank lines between records are records without text.
    """
    in_split = Window.partitionBy(*_SPLIT).orderBy("_line")
    counted = _lines(spark, path).withColumn("_inside", F.sum("_quotes").over(in_split) % 2 == 1)
    known = counted.join(_starts(counted), _SPLIT).withColumn("_ends_here", F.col("_inside") == F.col("_open"))
    past = in_split.rowsBetween(Window.unboundedPreceding, -1)
    numbered = known.withColumn("_number", F.coalesce(F.sum(F.col("_ends_here").cast("long")).over(past), F.lit(0)))
    from_before = F.col("_open") & (F.col("_number") == 0)
    goes_on = F.col("_number") == F.col("_ends")
    keyed = numbered.select(
        *PARTITION_COLUMNS,
        "_file",
        F.when(from_before, F.col("_owner")).otherwise(F.col("_block")).alias("_of"),
        # A record that leaves its split is the last one begun there, whatever its number.
        F.when(~from_before & ~goes_on, F.col("_number")).alias("_place"),
        F.struct("_block", "_line", "value").alias("_at"),
        ((F.col("_block") == 0) & (F.col("_number") == 0)).alias("_first"),
    )
    whole = keyed.groupBy(*PARTITION_COLUMNS, "_file", "_of", "_place").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("_at")), lambda x: x["value"]), "\n").alias("record"),
        F.count("*").alias("lines"),
        F.max("_first").alias("first"),
    )
    without_end = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return whole.select(*PARTITION_COLUMNS, without_end.alias("record"), "lines", "first")


def parsed(schema: T.StructType, options: dict[str, str]) -> Column:
    """The fields of ``record``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return F.from_csv("record", fields, {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true", **options})
