"""From link tuples to the geo-link table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.functions import coordinates as geo
from poiweave.functions.linkparams import FIELDS, TITLE
from poiweave.functions.steps import with_steps
from poiweave.operators.once import computed_once
from poiweave.schemas import LINK_SCHEMA

# What a tuple must hold to be a map link.
GEO_MARKERS = ["geohack.php?", "pagename", "params"]

_WORK_COLUMNS = ["tuple", "pos"]


def is_geo_link(tuple_text: Column) -> Column:
    tests = [F.contains(tuple_text, F.lit(m)) for m in GEO_MARKERS]
    return tests[0] & tests[1] & tests[2]


def geo_tuples(tuples: DataFrame) -> DataFrame:
    """Substring tests first: nearly all tuples of a dump leave here, before any regex."""
    return tuples.filter(is_geo_link(F.col("tuple")))


def link_fields(tuples: DataFrame) -> DataFrame:
    """Adds ``slice``, ``title_raw``, ``language``, ``tokens``, ``poitype``, ``region``.

    ``slice`` is NULL for a corrupt tuple, ``tokens`` for a link without parameters.
    """
    return with_steps(tuples, FIELDS)


def with_layout(fields: DataFrame, extended_layouts: bool = False) -> DataFrame:
    return with_steps(fields, {"layout": geo.layout_sql(extended_layouts)})


def with_coordinates(laid_out: DataFrame) -> DataFrame:
    return with_steps(laid_out, geo.VALUES)


def geo_links(
    tuples: DataFrame,
    strict: bool = False,
    extended_layouts: bool = False,
    normalize_title: bool = False,
) -> DataFrame:
    """Map links with a recognised coordinate layout.

    One narrow stage: tests, fields, layout, values.  An axis that is not a number is
    NULL and the link is kept; ``strict`` keeps links with both axes on the globe only.
    Columns of ``tuples`` other than the tuple itself are carried along.
    """
    title = f"replace({TITLE}, '_', ' ')" if normalize_title else TITLE
    steps = {**FIELDS, "layout": geo.layout_sql(extended_layouts), **geo.VALUES, "title": title}
    valued = with_steps(geo_tuples(tuples), steps)
    carried = [c for c in tuples.columns if c not in _WORK_COLUMNS]
    columns = LINK_SCHEMA.fieldNames()
    parsed = computed_once(
        valued.select(*carried, *columns, "layout"), {c: F.col(c) for c in [*columns, "layout"]}
    )
    links = parsed.filter(F.col("layout").isNotNull())
    if strict:
        links = links.filter(geo.in_range(F.col("latitude"), F.col("longitude")))
    return links.select(*carried, *columns)
