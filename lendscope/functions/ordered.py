"""Several ordered values in one number, texts among them, so that aggregates over them hash.

A maximum over a struct has no buffer of fixed width, so Spark sorts the rows for it; over a
bigint or a decimal it hashes. A text takes part as its place in a dictionary of the column's
distinct values, which keeps their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct texts up to which a dictionary is made. Beyond, there is none, and structs are used.
MOST_TEXTS = 1_000
#: Bits of a place in a dictionary.
TEXT_BITS = 11


class Dictionary:
    """The distinct values of a text column in ascending order."""

    def __init__(self, texts: list[str]):
        self.texts = sorted(texts)  # by code point, which is the order of UTF-8
        self.literal = F.array(*map(F.lit, self.texts)).cast("array<string>")

    def place(self, text: Column) -> Column:
        """From 1; NULL for NULL."""
        return F.when(text.isNotNull(), F.array_position(self.literal, text))

    def text(self, place: Column) -> Column:
        return F.get(self.literal, (place - 1).cast("int"))


def dictionary_of(rows: DataFrame, column: str, most: int = MOST_TEXTS) -> Dictionary | None:
    """The dictionary of a column, or None if it has more than `most` values.

    One scan of the column, combined before it is shuffled; at most `most` + 1 values come back.
    """
    found = rows.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    return None if len(found) > most else Dictionary([r[0] for r in found])


def packed(*parts: tuple[Column, int]) -> Column:
    """Whole numbers in one bigint that orders like their struct, NULL before all others.

    Each part comes with its bits (63 in all) and lies in -2^(bits-1) + 1 .. 2^(bits-1) - 1; a
    value that does not stops the job.
    """
    if sum(bits for _, bits in parts) > 63:
        raise ValueError("more than 63 bits")

    def shifted(value: Column, bits: int) -> Column:
        half = 1 << (bits - 1)
        fits = value.between(-half + 1, half - 1)
        number = F.when(fits, value.cast("bigint") + half).when(
            value.isNotNull(), F.raise_error(F.concat(value.cast("string"), F.lit(f" needs more than {bits} bits"))).cast("bigint")
        )
        return F.coalesce(number, F.lit(0).cast("bigint"))

    first, *others = parts
    return reduce(
        lambda sum_, part: F.shiftleft(sum_, part[1]) + shifted(*part), others, shifted(*first)
    )


def unpacked(number: Column, bits: list[int]) -> list[Column]:
    """The parts of a packed number, in order."""
    parts, below = [], 0
    for width in reversed(bits):
        raw = F.shiftright(number, below).bitwiseAND(F.lit((1 << width) - 1))
        parts.append(F.when(raw != 0, raw - (1 << (width - 1))))
        below += width
    return parts[::-1]


# NULL and every bigint: a little more than 64 bits.
_WIDE, _HALF_WIDE = str(1 << 65), str((1 << 63) + 1)


def with_id(number: Column, id_: Column) -> Column:
    """A packed number (of 59 bits at most) and a bigint of any size behind it, as one decimal that
    orders like both; NULL ids come first."""
    behind = F.coalesce(id_.cast("decimal(20,0)") + F.lit(_HALF_WIDE).cast("decimal(20,0)"), F.lit(0).cast("decimal(21,0)"))
    return (number.cast("decimal(19,0)") * F.lit(_WIDE).cast("decimal(20,0)") + behind).cast("decimal(38,0)")


def without_id(wide: Column) -> tuple[Column, Column]:
    """The packed number and the id."""
    size = F.lit(_WIDE).cast("decimal(38,0)")
    behind = wide % size
    number = ((wide - behind) / size).cast("bigint")
    return number, F.when(behind != 0, (behind - F.lit(_HALF_WIDE).cast("decimal(20,0)")).cast("bigint"))


# --- the latest status of a loan

MONTH_BITS = 40


class LatestStatus:
    """The largest (month, status) or (month, status, id) of a group, as one aggregate.

    `of` is the aggregate; `month`, `status` and `id` read it back from a column. Without a
    dictionary (too many distinct statuses) the aggregate is over a struct.
    """

    def __init__(self, rows: DataFrame, month: str, status: str, id_: str | None = None):
        self.texts = dictionary_of(rows, status)
        self.id_ = id_
        if self.texts is None:
            named = [F.col(month).alias("month"), F.col(status).alias("status")]
            self.of = F.max(F.struct(*named, *([F.col(id_).alias("id")] if id_ else [])))
            return
        number = packed((F.col(month), MONTH_BITS), (self.texts.place(F.col(status)), TEXT_BITS))
        self.of = F.max(with_id(number, F.col(id_)) if id_ else number)

    def _parts(self, column: str) -> tuple[Column, Column, Column | None]:
        number, behind = without_id(F.col(column)) if self.id_ else (F.col(column), None)
        month, place = unpacked(number, [MONTH_BITS, TEXT_BITS])
        return month, self.texts.text(place), behind

    def month(self, column: str) -> Column:
        return F.col(f"{column}.month") if self.texts is None else self._parts(column)[0]

    def status(self, column: str) -> Column:
        return F.col(f"{column}.status") if self.texts is None else self._parts(column)[1]

    def id(self, column: str) -> Column:
        return F.col(f"{column}.id") if self.texts is None else self._parts(column)[2]
