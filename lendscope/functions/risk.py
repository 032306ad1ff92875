"""Domain rules: delinquency buckets, cohorts, client bands, confidence bounds.

Divisors are double literals on purpose: bigint / decimal-literal would be
decimal arithmetic in Spark and give other digits at the band edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and thresholds of every published band.
DPD_LIMITS = ((0, "0"), (30, "1-30"), (60, "31-60"), (90, "61-90"))
DPD_ABOVE = "90+"
DPD_BUCKETS = ("0", "1-30", "31-60", "61-90", "90+")
AGE_LIMITS = ((25, "<25"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64"))
AGE_ABOVE = "65+"
INCOME_LIMITS = (
    (90000, "1: <90k"),
    (135000, "2: 90k-135k"),
    (180000, "3: 135k-180k"),
    (270000, "4: 180k-270k"),
)
INCOME_ABOVE = "5: 270k+"
UNKNOWN = "unknown"
DAYS_PER_MONTH = 30.4375
DAYS_PER_YEAR = 365.25
OPEN_COHORT_FROM = 96
Z_95 = 1.96


def _ladder(value: Column, limits: Sequence[tuple], above: str, inclusive: bool) -> Column:
    """First label whose limit holds the value; NULL for a NULL value."""
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, name in limits:
        label = label.when(value <= limit if inclusive else value < limit, name)
    return label.otherwise(above)


def dpd_bucket(days: Column) -> Column:
    """Bucket of days past due; unknown days stay NULL."""
    return _ladder(days, DPD_LIMITS, DPD_ABOVE, inclusive=True)


def months_before(days: Column) -> Column:
    """Whole months between a past day (negative) and the application."""
    return F.floor(-days / F.lit(DAYS_PER_MONTH)).cast("bigint")


def cohort_block(months: Column) -> Column:
    """Twelve-month block label, '00-11m' up to '84-95m', then '96m+'."""
    first = (F.floor(months / F.lit(12.0)) * 12).cast("bigint")

    def two_digits(n: Column) -> Column:
        return F.lpad(n.cast("string"), 2, "0")

    block = F.concat(two_digits(first), F.lit("-"), two_digits(first + 11), F.lit("m"))
    return F.when(months >= OPEN_COHORT_FROM, "96m+").otherwise(block)


def age_in_years(days_birth: Column) -> Column:
    return F.floor(-days_birth / F.lit(DAYS_PER_YEAR)).cast("bigint")


def age_band(days_birth: Column) -> Column:
    years = -days_birth / F.lit(DAYS_PER_YEAR)
    return F.coalesce(_ladder(years, AGE_LIMITS, AGE_ABOVE, inclusive=False), F.lit(UNKNOWN))


def income_band(income: Column) -> Column:
    return F.coalesce(
        _ladder(income, INCOME_LIMITS, INCOME_ABOVE, inclusive=False), F.lit(UNKNOWN)
    )


def wilson_interval(successes: Column, trials: Column, z: float = Z_95) -> tuple[Column, Column]:
    """Score interval (low, high) of a proportion, as centre minus / plus half width."""
    n = trials.cast("double")
    p = successes.cast("double") / n
    z_sq = F.lit(z * z)
    shrink = 1 + z_sq / n
    centre = (p + z_sq / (2 * n)) / shrink
    half = F.lit(z) * F.sqrt(p * (1 - p) / n + z_sq / (4 * n * n)) / shrink
    return centre - half, centre + half


def money_sum(amount: Column) -> Column:
    """Exact sum of money amounts at a width that does not depend on the input."""
    return F.sum(amount).cast("decimal(38,4)")
