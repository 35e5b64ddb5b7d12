"""Column contracts of the raw feed, the five tables and the seven reports."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    """``"name type, ..."`` as a schema, without needing a running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW = _schema(
    "invoice string, stock_code string, description string, quantity bigint, "
    "invoice_date timestamp_ntz, price double, customer_id double, country string"
)

LINES = _schema(
    "invoice string, stock_code string, description string, quantity bigint, "
    "invoice_date timestamp_ntz, price double, customer_id string, country string, "
    "revenue double"
)

ORDERS = _schema(
    "invoice string, customer_id string, invoice_date timestamp_ntz, country string, "
    "total_items bigint, total_revenue double, unique_products bigint, order_date date"
)

CUSTOMERS = _schema(
    "customer_id string, last_order_date date, total_orders bigint, total_revenue double, "
    "total_items bigint, country string, first_order_date date, cohort_month string, "
    "recency_days int, frequency bigint, monetary double, time_to_second_order_days int, "
    "had_repeat_within_30d int, made_second_purchase int, churned int, "
    "r_score int, m_score int, f_score int, rfm_tier string, had_return int"
)

TABLES = {
    "transactions": LINES,
    "anonymous_tx": LINES,
    "cancellations": LINES,
    "orders": ORDERS,
    "customers": CUSTOMERS,
}

REPORTS = {
    "churn_by_rfm_tier": _schema(
        "rfm_tier string, total_customers bigint, churned_customers bigint, "
        "churn_rate_pct double, avg_revenue_per_customer double, avg_orders double, "
        "risk_level string"
    ),
    "cohort_retention": _schema(
        "cohort_month string, cohort_size bigint, months_since_first int, "
        "active_customers bigint, retention_pct double"
    ),
    "activity_trend": _schema(
        "period string, granularity string, active_customers bigint, "
        "orders_placed bigint, revenue double"
    ),
    "time_to_second_purchase": _schema(
        "repeat_bucket string, sort_order int, total_customers bigint, "
        "retained_customers bigint, retention_pct double"
    ),
    "order_frequency_aha": _schema(
        "lifetime_orders string, sort_order bigint, total_customers bigint, "
        "retained_customers bigint, retention_pct double"
    ),
    "anonymous_share": _schema(
        "customer_type string, transaction_count bigint, total_revenue double, "
        "avg_line_value double, pct_of_transactions double, pct_of_revenue double"
    ),
    "returns_analysis": _schema(
        "returner_group string, total_customers bigint, retained_customers bigint, "
        "retention_pct double, avg_lifetime_revenue double, avg_orders double"
    ),
}

# Sort columns of each report's file, and whether they run down.
REPORT_ORDER = {
    "churn_by_rfm_tier": [("churn_rate_pct", True), ("rfm_tier", False)],
    "cohort_retention": [("cohort_month", False), ("months_since_first", False)],
    "activity_trend": [("granularity", False), ("period", False)],
    "time_to_second_purchase": [("sort_order", False)],
    "order_frequency_aha": [("sort_order", False)],
    "anonymous_share": [("customer_type", True)],
    "returns_analysis": [("returner_group", False)],
}

AUDIT = _schema("metric string, value double")

# Columns of the sample tables that the adapter reads.
SAMPLE_TABLES = {
    "lineitem": _schema(
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
    ),
    "orders": _schema(
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "customer": _schema("c_custkey bigint, c_nationkey int"),
    "nation": _schema("n_nationkey int, n_name string"),
}
