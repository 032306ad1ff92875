"""A pair of whole numbers in one: ordered like the pair, and of fixed width.

An aggregate over a struct has no fixed width, so Spark sorts for it; over one number it
hashes. Days and months fit into 32 bits each.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HALF = 1 << 31


def pack(first: Column, second: Column) -> Column:
    """One bigint. NULL if either is NULL; each must fit into 32 bits."""
    return F.shiftleft(first.cast("bigint"), 32) + (second.cast("bigint") + F.lit(_HALF))


def unpack_first(packed: Column) -> Column:
    return F.shiftright(packed, 32)


def unpack_second(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(_HALF)
