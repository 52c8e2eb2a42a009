"""Drop articles without a link before their bodies are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 128 MiB of bits, in at most 32,768 rows of 4 KiB: the bound of what is broadcast.
FILTER_BITS = 1 << 30


def may_match(
    articles: DataFrame, links: DataFrame, on: list[str], bits: int = FILTER_BITS
) -> DataFrame:
    """Articles whose key hashes to the bit of some link.

    Every article with a link stays; of the others about (links / bits) stay too, and the
    join that follows drops them.  The broadcast bitmap has a fixed size however many
    links there are.
    """
    position = F.pmod(F.xxhash64(*on), F.lit(bits))
    marks = (
        links.select(position.alias("_position"))
        .groupBy(F.bitmap_bucket_number("_position").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_position")).alias("_bits"))
    )
    placed = articles.withColumns(
        {
            "_bucket": F.bitmap_bucket_number(position),
            "_bit": F.bitmap_bit_position(position),
        }
    )
    byte = "cast(conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)"
    is_set = F.expr(f"({byte} & shiftleft(1, cast(_bit % 8 as int))) <> 0")
    same = placed["_bucket"] == marks["_bucket"]
    return placed.join(F.broadcast(marks), same & is_set, "left_semi").drop("_bucket", "_bit")
