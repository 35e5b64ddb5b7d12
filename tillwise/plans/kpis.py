"""Headline figures over reports and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.config import AnalyticsConfig
from tillwise.functions import lines as L
from tillwise.functions.numbers import rate_pct
from tillwise.operators.customers import Orders, each_part
from tillwise.operators.lines import LINE_CLASS
from tillwise.plans.reports import DAY, IDENTIFIED, WEEK

# Fixed value: smallest cohort shown when the reader does not choose.
DEFAULT_MIN_COHORT = 20


def overview_kpis(churn_report: DataFrame, share_report: DataFrame) -> DataFrame:
    """Customers, churn, revenue and anonymous revenue share as one row.

    ``total_revenue`` is exact; ``total_revenue_from_tiers`` is the published headline
    formula, rounded tier means times tier sizes.
    """
    per_tier = churn_report.select(
        "total_customers",
        "churned_customers",
        (F.col("avg_revenue_per_customer") * F.col("total_customers")).alias("tier_revenue"),
    )
    identified = share_report.filter(F.col("customer_type") == IDENTIFIED).select(
        "total_revenue", "pct_of_revenue"
    )
    tier_revenue = F.sum(F.col("tier_revenue").cast("decimal(28,6)"))
    customers = F.sum("total_customers")
    return per_tier.unionByName(identified, allowMissingColumns=True).agg(
        customers.alias("total_customers"),
        F.try_divide(F.sum("churned_customers") * F.lit(100.0), customers).alias(
            "overall_churn_pct"
        ),
        F.max("total_revenue").alias("total_revenue"),
        tier_revenue.cast("double").alias("total_revenue_from_tiers"),
        (100 - F.max("pct_of_revenue")).alias("anonymous_revenue_pct"),
    )


def activity_kpis(activity_report: DataFrame) -> DataFrame:
    """Peaks and the daily mean as one row."""

    def of(granularity: str, column: str) -> Column:
        return F.when(F.col("granularity") == granularity, F.col(column))

    return activity_report.agg(
        F.max(of(DAY, "active_customers")).alias("peak_daily_customers"),
        F.max(of(WEEK, "active_customers")).alias("peak_weekly_customers"),
        F.max(of(DAY, "revenue")).alias("peak_daily_revenue"),
        F.avg(of(DAY, "orders_placed")).alias("avg_daily_orders"),
    )


def activity_of(activity_report: DataFrame, granularity: str) -> DataFrame:
    """The day rows or the week rows of the activity report."""
    return activity_report.filter(F.col("granularity") == granularity)


def retention_matrix(
    cohort_report: DataFrame, config: AnalyticsConfig, min_size: int = DEFAULT_MIN_COHORT
) -> DataFrame:
    """Cohorts of at least ``min_size`` customers by month offset (``m0`` .. ``m11``).

    The size is the same on every row of a cohort, so keeping large rows keeps exactly
    the rows of large cohorts. Offsets nobody was active in stay NULL.
    """
    offsets = list(range(config.max_month_offset + 1))
    pivoted = (
        cohort_report.filter(F.col("cohort_size") >= min_size)
        .groupBy("cohort_month")
        .pivot("months_since_first", offsets)
        .agg(F.max("retention_pct"))
    )
    return pivoted.select(
        "cohort_month", *[F.col(str(k)).alias(f"m{k}") for k in offsets]
    ).orderBy("cohort_month")


def repeat_30d_retention(customers: DataFrame) -> DataFrame:
    """Retention of customers with and without a second purchase within 30 days."""
    retained = 1 - F.col("churned")
    return (
        customers.groupBy("had_repeat_within_30d")
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.sum(retained).alias("retained_customers"),
            rate_pct(retained).alias("retention_pct"),
        )
        .orderBy("had_repeat_within_30d")
    )


def tier_counts(customers: DataFrame) -> DataFrame:
    """Customers per tier, largest tier first."""
    return (
        customers.groupBy("rfm_tier")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "rfm_tier")
    )


def _as_rows(totals: DataFrame) -> DataFrame:
    """One wide row -> (metric, value) rows."""
    entries = [
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
        for name in totals.columns
    ]
    return totals.select(F.inline(F.array(*entries)))


def line_counts() -> list[Column]:
    """Row counts of the raw feed and of each line table, over labelled lines."""
    of = lambda name: F.count_if(F.col(LINE_CLASS) == name)
    return [
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~L.is_anonymous()).alias("identified_rows"),
        F.count_if(L.is_anonymous()).alias("anonymous_rows"),
        of("transactions").alias("transaction_rows"),
        of("cancellations").alias("cancellation_rows"),
    ]


def line_audit(lines: DataFrame) -> DataFrame:
    """The line counts as rows, from one pass over labelled lines."""
    return _as_rows(lines.agg(*line_counts()))


def customer_audit(orders: Orders, config: AnalyticsConfig) -> DataFrame:
    """Order rows, customers and overall churn, from one pass over the orders."""
    recency = F.date_diff(F.lit(config.as_of), F.col("last_order_date"))
    measures = [
        F.count(F.lit(1)).alias("order_rows"), F.max("order_date").alias("last_order_date")
    ]
    return _as_rows(
        each_part(orders, lambda part: part.groupBy("customer_id").agg(*measures))
        .agg(
            F.sum("order_rows").alias("order_rows"),
            F.count("customer_id").alias("customers"),
            rate_pct((recency > config.churn_days).cast("int")).alias("churn_pct"),
        )
    )


def pipeline_audit(lines: DataFrame, orders: Orders, config: AnalyticsConfig) -> DataFrame:
    """Counts of labelled lines, orders and customers, and overall churn."""
    return line_audit(lines).unionByName(customer_audit(orders, config))
