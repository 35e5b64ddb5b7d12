"""Calendar keys on DateType columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(day: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(day, "yyyy-MM")


def week_key(day: Column) -> Column:
    """``yyyy-WW`` with Monday-first weeks counted 00-53 inside each calendar year.

    Days before the year's first Monday are week 00, so keys restart every January
    (the C library's ``%Y-%W``, which Spark's date patterns do not offer).
    """
    week = ((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")
    return F.concat_ws("-", F.date_format(day, "yyyy"), F.lpad(week.cast("string"), 2, "0"))


def day_key(day: Column) -> Column:
    """Midnight timestamp text, the form in which daily periods are published."""
    return F.concat(day.cast("string"), F.lit(" 00:00:00"))


def month_offset(day: Column, first_day: Column, days_per_month: float) -> Column:
    """Whole average-length months between two dates, truncated toward zero."""
    return (F.date_diff(day, first_day) / F.lit(days_per_month)).cast("int")
