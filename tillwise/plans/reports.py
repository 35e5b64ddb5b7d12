"""The seven named reports over the stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.config import AnalyticsConfig
from tillwise.functions import lines as L
from tillwise.functions.calendar import day_key, month_key, month_offset, week_key
from tillwise.functions.numbers import (
    MONEY,
    mean_money,
    money,
    rate_pct,
    rounded,
    share_pct,
    total_money,
)
from tillwise.operators.customers import Orders, each_part

# Lowest rounded churn percentage of each risk level, highest first.
RISK_LEVELS = [(80, "Critical"), (50, "High"), (25, "Moderate")]
LOWEST_RISK = "Healthy"

# Buckets by days to the second purchase (upper end, label), in report order.
NO_REPEAT = "One-time only"
REPEAT_BUCKETS = [(7, "Within 7 days"), (30, "8-30 days"), (90, "31-90 days")]
LATE_REPEAT = "90+ days"

# The order count from which customers share one label.
TOP_ORDER_COUNT, TOP_ORDER_LABEL = 11, "11+"

# Group labels.
IDENTIFIED, ANONYMOUS = "Identified", "Anonymous"
RETURNER, NO_RETURNS = "Made a return", "No returns"
DAY, WEEK = "day", "week"


def _shaped(report: DataFrame, name: str) -> DataFrame:
    """Columns in the published order with their contract types."""
    return report.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.REPORTS[name]]
    )


def _repeat_bucket() -> Column:
    """Label and place of a customer's gap to the second purchase."""
    gap = F.col("time_to_second_order_days")
    last = len(REPEAT_BUCKETS) + 2
    label, place = F.lit(LATE_REPEAT), F.lit(last)
    for position, (upper_end, name) in reversed(list(enumerate(REPEAT_BUCKETS, start=2))):
        label = F.when(gap <= upper_end, name).otherwise(label)
        place = F.when(gap <= upper_end, position).otherwise(place)
    none = F.col("made_second_purchase") == 0
    return _label(F.when(none, NO_REPEAT).otherwise(label), F.when(none, 1).otherwise(place))


def _order_count() -> Column:
    count = F.least(F.col("frequency"), F.lit(TOP_ORDER_COUNT))
    text = F.when(count == TOP_ORDER_COUNT, TOP_ORDER_LABEL).otherwise(count.cast("string"))
    return _label(text, count)


def _label(text: Column, place: Column | None = None) -> Column:
    place = F.lit(None) if place is None else place
    return F.struct(text.alias("label"), place.cast("bigint").alias("sort_order"))


#: The group of a customer in each report that counts customers by groups.
CUSTOMER_LABELS: dict[str, Callable[[], Column]] = {
    "churn_by_rfm_tier": lambda: _label(F.col("rfm_tier")),
    "cohort_retention": lambda: _label(F.col("cohort_month")),
    "time_to_second_purchase": _repeat_bucket,
    "order_frequency_aha": _order_count,
    "returns_analysis": lambda: _label(
        F.when(F.col("had_return") == 1, RETURNER).otherwise(NO_RETURNS)
    ),
}


#: Reports that also tell what a group's customers are worth.
VALUE_REPORTS = ("churn_by_rfm_tier", "returns_analysis")


def customer_groups(
    customers: DataFrame, names: Sequence[str] = tuple(CUSTOMER_LABELS)
) -> DataFrame:
    """Counts, churn and value of every group of every named report, from one pass.

    A customer becomes one row for each report, and these combine to one row a group in the task
    that reads them; as many rows come out as the reports have labels. Value and orders are read
    only if a named report tells them.
    """
    entries = [
        F.struct(F.lit(name).alias("report"), CUSTOMER_LABELS[name]().alias("group"))
        for name in names
    ]
    retained = 1 - F.col("churned")
    read, measures = ["churned"], [
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("churned").alias("churned_customers"),
        rate_pct(F.col("churned")).alias("churn_rate_pct"),
        F.sum(retained).alias("retained_customers"),
        rate_pct(retained).alias("retention_pct"),
    ]
    if set(names) & set(VALUE_REPORTS):
        read += ["monetary", "frequency"]
        measures += [
            rounded(mean_money(F.col("monetary")), 2).alias("mean_revenue"),
            rounded(F.avg("frequency"), 1).alias("avg_orders"),
        ]
    return (
        customers.select(*read, F.inline(F.array(*entries)))
        .select(*read, "report", "group.label", "group.sort_order")
        .groupBy("report", "label", "sort_order")
        .agg(*measures)
    )


def _groups(customers: DataFrame, groups: DataFrame | None, name: str) -> DataFrame:
    """One report's groups, out of those of all reports if they are there already."""
    found = customer_groups(customers, (name,)) if groups is None else groups
    return found.filter(F.col("report") == name)


def churn_by_rfm_tier(customers: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Churn, value and order count per tier, worst churn first."""
    tiers = _groups(customers, groups, "churn_by_rfm_tier").withColumnsRenamed(
        {"label": "rfm_tier", "mean_revenue": "avg_revenue_per_customer"}
    )
    # The level is read off the rounded percentage.
    risk = F.lit(LOWEST_RISK)
    for lowest, level in reversed(RISK_LEVELS):
        risk = F.when(F.col("churn_rate_pct") >= lowest, level).otherwise(risk)
    return _shaped(tiers.withColumn("risk_level", risk), "churn_by_rfm_tier").orderBy(
        F.desc("churn_rate_pct"), "rfm_tier"
    )


def cohort_retention(
    customers: DataFrame,
    orders: Orders,
    config: AnalyticsConfig,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Share of each first-purchase-month cohort that orders again per month offset.

    Orders shrink to distinct customer days before the join, so the heaviest customer
    brings at most one row per calendar day to it. After the join the customer key stays
    in place: the distinct step per offset needs no further shuffle of its own. Where
    customers and orders are stored in the same buckets, the join needs none either.
    """
    cohorts = customers.select("customer_id", "cohort_month", "first_order_date")
    if groups is None:
        sizes = cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    else:
        sizes = _groups(customers, groups, "cohort_retention").select(
            F.col("label").alias("cohort_month"), F.col("total_customers").alias("cohort_size")
        )
    offset = month_offset(F.col("order_date"), F.col("first_order_date"), config.days_per_month)
    active = each_part(
        orders,
        lambda part: part.select("customer_id", "order_date")
        .distinct()
        .join(cohorts, "customer_id")
        .withColumn("months_since_first", offset)
        .filter(F.col("months_since_first").between(0, config.max_month_offset))
        .select("customer_id", "cohort_month", "months_since_first")
        .distinct(),
    )
    retained = active.groupBy("cohort_month", "months_since_first").agg(
        F.count(F.lit(1)).alias("active_customers")
    )
    report = retained.join(sizes, "cohort_month").withColumn(
        "retention_pct", share_pct(F.col("active_customers"), F.col("cohort_size"))
    )
    return _shaped(report, "cohort_retention").orderBy("cohort_month", "months_since_first")


def activity_trend(orders: DataFrame, granularities: Sequence[str] = (DAY, WEEK)) -> DataFrame:
    """Active customers, invoices and revenue per day and per week.

    Each order row becomes two rows, one for its customer (with the revenue) and one for its
    invoice, and these combine to one row per day and customer or invoice before and after
    the first shuffle. Its key holds the counted id, so a day with a huge share of the orders
    spreads over many tasks. Days and weeks are then taken from these small sets.
    """
    customer = F.struct(
        F.lit(True).alias("is_customer"),
        F.col("customer_id").alias("id"),
        money(F.col("total_revenue")).alias("revenue"),
    )
    invoice = F.struct(
        F.lit(False).alias("is_customer"),
        F.col("invoice").alias("id"),
        F.lit(None).cast(MONEY).alias("revenue"),
    )
    by_day = (
        orders.select("order_date", F.inline(F.array(customer, invoice)))
        .groupBy("order_date", "is_customer", "id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    measures = [
        F.count(F.when(F.col("is_customer"), F.col("id"))).alias("active_customers"),
        F.count(F.when(~F.col("is_customer"), F.col("id"))).alias("orders_placed"),
        rounded(F.sum("revenue"), 2).alias("revenue"),
    ]
    parts = {
        DAY: lambda: by_day.groupBy(day_key(F.col("order_date")).alias("period")),
        WEEK: lambda: (
            by_day.groupBy(week_key(F.col("order_date")).alias("period"), "is_customer", "id")
            .agg(F.sum("revenue").alias("revenue"))
            .groupBy("period")
        ),
    }
    found = [
        parts[g]().agg(*measures).withColumn("granularity", F.lit(g)) for g in granularities
    ]
    report = reduce(DataFrame.unionByName, found)
    return _shaped(report, "activity_trend").orderBy("granularity", "period")


def time_to_second_purchase(customers: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Retention by how soon the second purchase came."""
    report = _groups(customers, groups, "time_to_second_purchase")
    report = report.withColumnRenamed("label", "repeat_bucket")
    return _shaped(report, "time_to_second_purchase").orderBy("sort_order")


def order_frequency_aha(customers: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Retention by lifetime order count, high counts pooled."""
    report = _groups(customers, groups, "order_frequency_aha")
    report = report.withColumnRenamed("label", "lifetime_orders")
    return _shaped(report, "order_frequency_aha").orderBy("sort_order")


def share_of_lines(lines: DataFrame) -> DataFrame:
    """Two rows, identified and anonymous, from lines labelled by ``customer_type``.

    One global aggregate with partial sums per task; both rows exist even when one kind
    of line does not occur. Revenue shares are taken from the rounded totals.
    """
    def measures(label: str) -> list[Column]:
        mine = F.col("customer_type") == label
        revenue = F.when(mine, F.col("revenue"))
        return [
            F.count_if(mine).alias(f"{label}_count"),
            rounded(total_money(revenue), 2).alias(f"{label}_revenue"),
            rounded(mean_money(revenue), 2).alias(f"{label}_mean"),
        ]

    totals = lines.agg(*measures(IDENTIFIED), *measures(ANONYMOUS))
    line_total = F.col(f"{IDENTIFIED}_count") + F.col(f"{ANONYMOUS}_count")
    revenue_total = F.coalesce(f"{IDENTIFIED}_revenue", F.lit(0.0)) + F.coalesce(
        f"{ANONYMOUS}_revenue", F.lit(0.0)
    )

    def row(label: str) -> Column:
        return F.struct(
            F.lit(label).alias("customer_type"),
            F.col(f"{label}_count").alias("transaction_count"),
            F.col(f"{label}_revenue").alias("total_revenue"),
            F.col(f"{label}_mean").alias("avg_line_value"),
            share_pct(F.col(f"{label}_count"), line_total).alias("pct_of_transactions"),
            share_pct(F.col(f"{label}_revenue"), revenue_total).alias("pct_of_revenue"),
        )

    report = totals.select(F.inline(F.array(row(IDENTIFIED), row(ANONYMOUS))))
    return _shaped(report, "anonymous_share")


def _counted_lines(lines: DataFrame) -> DataFrame:
    """Lines that shares are taken of, labelled by ``customer_type``.

    What all counted lines share is filtered first, as plain comparisons that reach the scan.
    """
    label = F.when(L.is_anonymous(), ANONYMOUS).otherwise(IDENTIFIED)
    counted = lines.filter(L.is_priced_sale()).filter(L.is_countable_invoice())
    return counted.withColumns({"revenue": L.line_revenue(), "customer_type": label})


def anonymous_share(lines: DataFrame) -> DataFrame:
    """How much of lines and revenue carries no customer id.

    ``lines`` is the raw feed or the union of the stored sales and anonymous lines; both
    give the same result.
    """
    return share_of_lines(_counted_lines(lines).select("revenue", "customer_type"))


def anonymous_breakdown(lines: DataFrame, by: Column, name: str) -> DataFrame:
    """Identified and anonymous lines and revenue for each value of ``by``, and the anonymous share.

    Shows whether lines without a customer id cluster somewhere. One aggregate that combines in
    the task that reads; a value with most of the lines costs no more than others. Lines without
    the value are a group of their own (NULL).
    """
    measures = []
    for label in (IDENTIFIED, ANONYMOUS):
        mine = F.col("customer_type") == label
        revenue = F.coalesce(total_money(F.when(mine, F.col("revenue"))), F.lit(0))
        measures += [
            F.count_if(mine).alias(f"{label.lower()}_lines"),
            rounded(revenue, 2).alias(f"{label.lower()}_revenue"),
        ]
    groups = _counted_lines(lines).groupBy(by.alias(name)).agg(*measures)

    def share(of: str) -> Column:
        mine, other = F.col(f"anonymous_{of}"), F.col(f"identified_{of}")
        return share_pct(mine, mine + other).alias(f"pct_anonymous_{of}")

    return groups.select("*", share("lines"), share("revenue"))


def anonymous_by_country(lines: DataFrame) -> DataFrame:
    """Where lines without a customer id come from, most of them first."""
    report = anonymous_breakdown(lines, F.col("country"), "country")
    return report.orderBy(F.desc("anonymous_lines"), "country")


def anonymous_by_month(lines: DataFrame) -> DataFrame:
    """Monthly volume with and without a customer id."""
    return anonymous_breakdown(lines, month_key(F.col("invoice_date")), "month").orderBy("month")


def returns_analysis(customers: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Retention and value of customers with and without a return."""
    report = _groups(customers, groups, "returns_analysis").withColumnsRenamed(
        {"label": "returner_group", "mean_revenue": "avg_lifetime_revenue"}
    )
    return _shaped(report, "returns_analysis").orderBy("returner_group")


#: A report of the tables, and of their ``customer_groups`` if these were counted before.
Report = Callable[..., DataFrame]

# In publication order.
CATALOG: dict[str, Report] = {
    "churn_by_rfm_tier": lambda t, _, groups=None: churn_by_rfm_tier(t.customers, groups),
    "cohort_retention": lambda t, c, groups=None: cohort_retention(
        t.customers, t.order_parts or t.orders, c, groups
    ),
    "activity_trend": lambda t, _, groups=None: activity_trend(t.orders),
    "time_to_second_purchase": lambda t, _, groups=None: time_to_second_purchase(
        t.customers, groups
    ),
    "order_frequency_aha": lambda t, _, groups=None: order_frequency_aha(t.customers, groups),
    "anonymous_share": lambda t, _, groups=None: anonymous_share(
        t.transactions.unionByName(t.anonymous_tx)
    ),
    "returns_analysis": lambda t, _, groups=None: returns_analysis(t.customers, groups),
}
