"""CSV output: header, every field quoted, quotes doubled, missing coordinate ``""``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from poiweave.schemas import PARTITION_COLUMNS, POI_COLUMNS
from poiweave.sinks.layout import writer

# Other readers take a CSV file with line ends in its fields in one task, hence the smaller files.
MAX_RECORDS_PER_FILE = 100_000

CSV_OPTIONS = {"quoteAll": "true", "escape": '"', "emptyValue": "", "nullValue": ""}


def write_csv(
    poi: DataFrame, path: str, gzip: bool = False, max_records: int = MAX_RECORDS_PER_FILE, order: Sequence[str] = ()
) -> None:
    """``order`` (such as ``NAME``) sorts the rows of each file."""
    out = writer(poi.select(*POI_COLUMNS, *PARTITION_COLUMNS), max_records=max_records, order=order)
    if gzip:
        out = out.option("compression", "gzip")
    out.options(header="true", **CSV_OPTIONS).csv(path)
