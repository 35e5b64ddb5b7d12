"""Money, rounding and rates.

Money is summed as decimal: the result does not depend on the order in which
partitions arrive, so reruns and retried tasks give identical totals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"
ROUNDING = "decimal(38,10)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def total_money(value: Column) -> Column:
    return F.sum(money(value))


def rounded(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal form, back to double."""
    return F.round(value.cast(ROUNDING), digits).cast("double")


def mean_money(value: Column) -> Column:
    """Mean from an exact total."""
    return F.try_divide(total_money(value).cast("double"), F.count(value))


def share_pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, one digit; NULL when the whole is 0."""
    return rounded(F.try_divide(F.lit(100.0) * part, whole), 1)


def rate_pct(flag: Column) -> Column:
    """Mean of a 0/1 column as a percentage, one digit."""
    return rounded(F.avg(flag) * 100, 1)


def plain_text(value: Column, digits: int = 10) -> Column:
    """Shortest plain decimal text with at least one fraction digit (no exponent)."""
    text = value.cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1")
