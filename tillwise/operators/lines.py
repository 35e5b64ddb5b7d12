"""Raw lines -> identified sales, cancellations and anonymous lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions import lines as L

LINE_CLASS = "line_class"


def split_anonymous(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(identified, anonymous) by presence of a customer id; ids become text.

    The null test is on the stored column, so a columnar scan can skip by it.
    """
    identified = raw.filter(~L.is_anonymous())
    anonymous = raw.filter(L.is_anonymous())
    return (
        identified.withColumn("customer_id", L.normal_customer_id()),
        anonymous.withColumn("customer_id", L.normal_customer_id()),
    )


def add_revenue(lines: DataFrame) -> DataFrame:
    return lines.withColumn("revenue", L.line_revenue())


def extract_cancellations(identified: DataFrame) -> DataFrame:
    return identified.filter(L.is_cancellation()).transform(add_revenue)


def clean_transactions(identified: DataFrame) -> DataFrame:
    return identified.filter(L.is_clean_sale()).transform(add_revenue)


def label_lines(raw: DataFrame) -> DataFrame:
    """All lines with revenue, text ids and the table they belong to (``line_class``).

    The class is NULL for lines that belong to no table: a prefixed invoice without a
    negative quantity, or a regular one without a positive quantity and price.
    """
    target = (
        F.when(L.is_anonymous(), "anonymous_tx")
        .when(L.is_cancellation(), "cancellations")
        .when(L.is_clean_sale(), "transactions")
    )
    return (
        raw.withColumn("customer_id", L.normal_customer_id())
        .transform(add_revenue)
        .withColumn(LINE_CLASS, target)
    )


def classify_lines(raw: DataFrame) -> DataFrame:
    """All three line tables in one pass, told apart by ``line_class``."""
    return label_lines(raw).filter(F.col(LINE_CLASS).isNotNull())
