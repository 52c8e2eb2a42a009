"""Stored Parquet tables: the language's part is replaced as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from poiweave.schemas import LINK_ORDER, LINK_SCHEMA
from poiweave.sinks.layout import MAX_RECORDS_PER_FILE, writer


def write_link_table(
    links: DataFrame, path: str, max_records: int = MAX_RECORDS_PER_FILE, order: Sequence[str] = ()
) -> None:
    """Links with their place in the dump, where they have one: later steps can still keep the last of several."""
    place = [LINK_ORDER] if LINK_ORDER in links.columns else []
    writer(links.select("lang", *LINK_SCHEMA.fieldNames(), *place), ["lang"], max_records, order).parquet(path)


def write_poi_table(
    poi: DataFrame, path: str, max_records: int = MAX_RECORDS_PER_FILE, order: Sequence[str] = ()
) -> None:
    writer(poi, max_records=max_records, order=order).parquet(path)
