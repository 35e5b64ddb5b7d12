"""Order rows -> one feature row per customer.

Orders may come in parts that have no customer in common (``Orders``), as stored tables hold
them: parts in buckets of the customer are aggregated without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.config import AnalyticsConfig
from tillwise.functions.calendar import month_key
from tillwise.functions.numbers import rounded, total_money
from tillwise.operators.lines import LINE_CLASS
from tillwise.operators.orders import ORDER_KEYS

FEATURE_COLUMNS = [
    "customer_id",
    "last_order_date",
    "total_orders",
    "total_revenue",
    "total_items",
    "country",
    "first_order_date",
    "cohort_month",
    "recency_days",
    "frequency",
    "monetary",
    "time_to_second_order_days",
    "had_repeat_within_30d",
    "made_second_purchase",
    "churned",
]


Orders = DataFrame | Sequence[DataFrame]


def each_part(orders: Orders, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``of`` makes of every part, together."""
    parts = [orders] if isinstance(orders, DataFrame) else orders
    return reduce(DataFrame.unionByName, [of(part) for part in parts])


def _flag(condition: Column) -> Column:
    """0/1, with unknown as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def purchase_gaps(orders: Orders, config: AnalyticsConfig) -> DataFrame:
    """First and second order date per customer, cohort and days between the two dates.

    Order rows are ranked, so a second row on the first day is a second purchase with
    gap 0. The rank filter lets Spark cut each customer to two rows per map task before
    the shuffle, which keeps a customer with a huge share of all orders harmless. Ties
    inside a day need no further sort key, because only the date survives.
    """
    gap = F.date_diff("second_order_date", "first_order_date")
    return each_part(orders, _first_two_dates).withColumns(
        {
            "cohort_month": month_key(F.col("first_order_date")),
            "time_to_second_order_days": gap,
            "had_repeat_within_30d": _flag(gap <= config.repeat_days),
            "made_second_purchase": _flag(F.col("second_order_date").isNotNull()),
        }
    )


def _first_two_dates(orders: DataFrame) -> DataFrame:
    by_date = Window.partitionBy("customer_id").orderBy("order_date")
    first_two = (
        orders.filter(F.col("customer_id").isNotNull())
        .select("customer_id", "order_date", F.row_number().over(by_date).alias("order_rank"))
        .filter(F.col("order_rank") <= 2)
    )

    def date_at(rank: int) -> Column:
        return F.max(F.when(F.col("order_rank") == rank, F.col("order_date")))

    return first_two.groupBy("customer_id").agg(
        date_at(1).alias("first_order_date"), date_at(2).alias("second_order_date")
    )


def most_frequent(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Most frequent ``value`` per ``key``, the smallest one on ties.

    Counting per (key, value) first combines on the map side, so each key arrives at the
    final step with one row per distinct value instead of all its rows.
    """
    counts = rows.dropna(subset=[key, value]).groupBy(key, value).count()
    ranked = F.struct((-F.col("count")).alias("order"), F.col(value).alias("value"))
    return counts.groupBy(key).agg(F.min(ranked)["value"].alias(name))


def customer_totals(orders: Orders) -> DataFrame:
    """Last order, distinct invoices, items and revenue per customer.

    The distinct count makes Spark combine and shuffle on (customer, invoice) first and
    only then, combined again per task, on the customer: no customer is a hot key.
    """
    return each_part(
        orders,
        lambda part: part.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_order_date"),
            F.count_distinct("invoice").alias("total_orders"),
            F.sum("total_items").alias("total_items"),
            total_money(F.col("total_revenue")).alias("revenue"),
        ),
    )


def customer_value(orders: Orders, config: AnalyticsConfig) -> DataFrame:
    """Totals, recency and churn, one row per customer: what scores and tiers need.

    One aggregate, which reads ``orders`` once.
    """
    recency = F.date_diff(F.lit(config.as_of), "last_order_date")
    return customer_totals(orders).select(
        "customer_id",
        "last_order_date",
        "total_orders",
        F.col("revenue").cast("double").alias("total_revenue"),
        "total_items",
        recency.alias("recency_days"),
        F.col("total_orders").alias("frequency"),
        rounded(F.col("revenue"), 2).alias("monetary"),
        _flag(recency > config.churn_days).alias("churned"),
    )


def add_history(value: DataFrame, orders: Orders, config: AnalyticsConfig) -> DataFrame:
    """Country and purchase gaps added to rows that are unique on the customer.

    Two more narrow aggregates over the orders, each with its own skew-safe shuffle, joined
    on the customer they all end up partitioned by: pass stored orders.
    """
    country = each_part(
        orders, lambda part: most_frequent(part, "customer_id", "country", "country")
    )
    gaps = purchase_gaps(orders, config)
    return value.join(country, "customer_id", "left").join(gaps, "customer_id", "left")


def customer_features(orders: Orders, config: AnalyticsConfig) -> DataFrame:
    """Purchase history, value and churn, one row per customer (reads ``orders`` thrice).

    Each part is joined for itself, so that parts in buckets of the customer stay where they are.
    """
    return each_part(
        orders, lambda part: add_history(customer_value(part, config), part, config)
    ).select(*FEATURE_COLUMNS)


def add_return_flag(customers: DataFrame, cancellations: DataFrame) -> DataFrame:
    """1 for customers found among the cancellations, else 0.

    Both sides are unique on the key, so no customer is hot in the join; the side to
    broadcast, if any, is decided by Spark from measured sizes.
    """
    returners = (
        cancellations.select("customer_id")
        .dropna()
        .distinct()
        .withColumn("returned", F.lit(1))
    )
    return (
        customers.join(returners, "customer_id", "left")
        .withColumn("had_return", F.coalesce("returned", F.lit(0)))
        .drop("returned")
    )


def return_flags(lines: DataFrame) -> DataFrame:
    """The same flag for customers with an order, straight from labelled lines.

    One aggregate over all lines with partial results per task: no order roll-up, no join.
    """
    in_order = F.lit(True)
    for key in ORDER_KEYS:
        in_order = in_order & F.col(key).isNotNull()
    bought = (F.col(LINE_CLASS) == "transactions") & in_order
    returned = F.col(LINE_CLASS) == "cancellations"
    return (
        lines.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.bool_or(bought).alias("bought"), F.bool_or(returned).alias("returned"))
        .filter("bought")
        .select("customer_id", _flag(F.col("returned")).alias("had_return"))
    )
