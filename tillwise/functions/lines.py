"""Tests on raw line items.

Each is made of plain comparisons. Where a plan filters by one of them, its conjuncts reach a
Parquet scan; a choice between several does not, so filter by what they share first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the invoice prefix that marks a cancellation.
CANCEL_PREFIX = "C"


def is_anonymous() -> Column:
    return F.col("customer_id").isNull()


def is_cancellation() -> Column:
    """Prefixed invoice (case-sensitive) that takes goods back."""
    return F.col("invoice").startswith(CANCEL_PREFIX) & (F.col("quantity") < 0)


def is_clean_sale() -> Column:
    """Sold goods at a price; a missing invoice number does not disqualify a line."""
    regular = F.col("invoice").isNull() | ~F.col("invoice").startswith(CANCEL_PREFIX)
    return regular & (F.col("quantity") > 0) & (F.col("price") > 0)


def is_priced_sale() -> Column:
    """What every counted sale has, identified or not."""
    return (F.col("quantity") > 0) & (F.col("price") > 0)


def is_countable_invoice() -> Column:
    """Invoice test of the share report. For anonymous lines the prefix is tested in either
    case and a missing invoice number fails; identified ones are tested like clean sales."""
    invoice = F.col("invoice")
    upper, lower = invoice.startswith(CANCEL_PREFIX), invoice.startswith(CANCEL_PREFIX.lower())
    return F.when(is_anonymous(), ~(upper | lower)).otherwise(invoice.isNull() | ~upper)


def line_revenue() -> Column:
    return F.col("quantity") * F.col("price")


def normal_customer_id() -> Column:
    """Numeric id as text without a fraction part (17850.0 -> '17850')."""
    return F.col("customer_id").cast("bigint").cast("string")
