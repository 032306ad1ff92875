"""Text-to-typed column rules.

RAW tables hold only text. Every rule here is total: text that does not fit the
target type becomes NULL, it never raises, so one bad cell cannot stop a load.

Each rule is SQL text over a column (`*_sql`), with a Column form beside it. Staging
types some 350 columns; as text a table is one parsed projection instead of thousands
of driver-to-JVM calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The "not available" code, the "no date" day count, and the text
# hashed in place of a NULL key part.
NOT_AVAILABLE = "XNA"
NO_DATE = 365243
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# A closing d or f (but not that of 'inf'), or an x anywhere.
JAVA_ONLY = "[dDxX]|(?<![nN])[fF]"


def to_double_sql(text: str) -> str:
    """Text to double. Java-only spellings ('12d', '1f', '0x1p3') are not numbers."""
    return f"if({text} rlike '{JAVA_ONLY}', null, try_cast({text} as double))"


def to_decimal_sql(text: str, precision: int = 18, scale: int = 4) -> str:
    """Text to decimal, rounding half up to the scale."""
    return f"try_cast({text} as decimal({precision},{scale}))"


def to_bigint_sql(text: str) -> str:
    """Text to bigint, rounded as a double, so '12.0' is 12.

    Parsed as a wide decimal: that knows no Java-only spellings, so the rule needs no
    guard. Short rules matter, because the columns of a projection share one generated
    method and the JVM leaves a method past its size limit uncompiled. Whatever is too
    large for the decimal is too large for a bigint.
    """
    wide = f"cast(try_cast({text} as decimal(38,18)) as double)"
    return f"try_cast(round({wide}, 0) as bigint)"


def to_bool_01_sql(text: str) -> str:
    return f"case {to_bigint_sql(text)} when 1 then true when 0 then false end"


def to_bool_yn_sql(text: str) -> str:
    """'Y' / 'N' exactly: no trimming, no case folding."""
    return f"case {text} when 'Y' then true when 'N' then false end"


def clean_text_sql(text: str) -> str:
    """Trim blanks; empty becomes NULL."""
    return f"nullif(trim({text}), '')"


def is_code_sql(text: str, code: str = NOT_AVAILABLE) -> str:
    """Whether the trimmed text is the code. Never NULL."""
    return f"coalesce(trim({text}) = '{code}', false)"


def null_if_code_sql(text: str, code: str = NOT_AVAILABLE) -> str:
    return f"nullif({clean_text_sql(text)}, '{code}')"


def is_sentinel_sql(text: str, sentinel: int = NO_DATE) -> str:
    """Whether the number is the placeholder. Never NULL."""
    return f"coalesce({to_bigint_sql(text)} = {sentinel}, false)"


def null_if_sentinel_sql(text: str, sentinel: int = NO_DATE) -> str:
    return f"nullif({to_bigint_sql(text)}, {sentinel}L)"


def surrogate_key_sql(*values: str) -> str:
    """md5 over the '-'-joined text of the parts.

    concat_ws alone would skip NULL parts and let ('a', NULL) collide with
    (NULL, 'a'), hence the placeholder.
    """
    parts = ", ".join(f"coalesce(cast({v} as string), '{NULL_KEY_PART}')" for v in values)
    return f"md5(concat_ws('-', {parts}))"


def to_double(text: str) -> Column:
    return F.expr(to_double_sql(text))


def to_decimal(text: str, precision: int = 18, scale: int = 4) -> Column:
    return F.expr(to_decimal_sql(text, precision, scale))


def to_bigint(text: str) -> Column:
    return F.expr(to_bigint_sql(text))


def to_bool_01(text: str) -> Column:
    return F.expr(to_bool_01_sql(text))


def to_bool_yn(text: str) -> Column:
    return F.expr(to_bool_yn_sql(text))


def clean_text(text: str) -> Column:
    return F.expr(clean_text_sql(text))


def is_code(text: str, code: str = NOT_AVAILABLE) -> Column:
    return F.expr(is_code_sql(text, code))


def null_if_code(text: str, code: str = NOT_AVAILABLE) -> Column:
    return F.expr(null_if_code_sql(text, code))


def is_sentinel(text: str, sentinel: int = NO_DATE) -> Column:
    return F.expr(is_sentinel_sql(text, sentinel))


def null_if_sentinel(text: str, sentinel: int = NO_DATE) -> Column:
    return F.expr(null_if_sentinel_sql(text, sentinel))


def surrogate_key(*values: str) -> Column:
    return F.expr(surrogate_key_sql(*values))
