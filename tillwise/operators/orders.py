"""Clean sales -> order rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.numbers import total_money

# An order row is one invoice of one customer at one minute in one country; an invoice
# keyed over two minutes therefore gives two rows.
ORDER_KEYS = ["invoice", "customer_id", "invoice_date", "country"]


def build_orders(transactions: DataFrame) -> DataFrame:
    """One row per order key; lines with a missing key part have no order.

    Sums combine on the map side. The distinct product count is shuffled on
    (order key, stock_code) first, so a giant invoice spreads over many tasks; a consumer
    that does not read ``unique_products`` does not pay for it, as the optimizer prunes it.
    """
    return (
        transactions.dropna(subset=ORDER_KEYS)
        .groupBy(*ORDER_KEYS)
        .agg(
            F.sum("quantity").alias("total_items"),
            total_money(F.col("revenue")).cast("double").alias("total_revenue"),
            F.count_distinct("stock_code").alias("unique_products"),
        )
        .withColumn("order_date", F.to_date("invoice_date"))
    )
