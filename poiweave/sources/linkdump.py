"""Scan of external-link dumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiweave.sources.catalog import dump_identity, dump_number, handled_dumps


def read_link_dumps(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``INSERT`` lines of all matching dumps: ``lang``, ``value``, ``line_ord``.

    ``line_ord`` orders lines within a language as they stand in the files, also when
    a file is read in several splits: number of the dump file, file, start of the split, line
    within the task; a dump in files 1 to 10 ends with file 10, and parts of a directory follow by name.
    It is taken straight after the read, before anything can move rows between tasks.
    """
    files = spark.read.text(paths)
    handled_dumps(files)
    return (
        files.select(
            "value",
            dump_identity(F.col("_metadata.file_path"))["lang"].alias("lang"),
            F.struct(
                dump_number(F.col("_metadata.file_path")).alias("number"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("line_ord"),
        )
        .filter(F.contains("value", F.lit("INSERT INTO")))
        .select("lang", "line_ord", "value")
    )


def link_tuples(lines: DataFrame) -> DataFrame:
    """One row per ``(…)`` group of an ``INSERT`` line, with its position ``pos``.

    A line always has a piece, so the outer form loses nothing; the inner one would make
    Spark split every line twice, once to test that there is a piece.
    """
    carried = [c for c in lines.columns if c != "value"]
    return lines.filter(F.contains("value", F.lit("INSERT INTO"))).select(
        *carried, F.posexplode_outer(F.split("value", r"\),\(")).alias("pos", "tuple")
    )
