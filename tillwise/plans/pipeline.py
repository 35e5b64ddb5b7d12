"""Build of the stored tables from the raw feed, and the report run over them."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.config import AnalyticsConfig
from tillwise.operators.customers import Orders, add_history, add_return_flag, customer_value
from tillwise.operators.lines import (
    LINE_CLASS,
    clean_transactions,
    extract_cancellations,
    label_lines,
    split_anonymous,
)
from tillwise.operators.orders import build_orders
from tillwise.operators.rfm import add_rfm, quartile_edges
from tillwise.plans.kpis import customer_audit, line_counts
from tillwise.plans.reports import CATALOG, customer_groups
from tillwise.sources.reports import write_report
from tillwise.sources.staging import released_after, stage, staging_folder
from tillwise.sources.tables import (
    RetailTables,
    hot_customers,
    new_version,
    order_parts,
    publish,
    read_tables,
    read_version,
    write_customers,
    write_line_tables,
    write_orders,
)

#: Columns of labelled lines that orders, returns, shares and counts are made from.
ROLL_UP_COLUMNS = [
    "invoice", "quantity", "invoice_date", "price", "customer_id", "country", "revenue", LINE_CLASS,
]


def orders_of_raw(raw: DataFrame) -> DataFrame:
    """Order rows straight from the raw feed."""
    identified, _ = split_anonymous(raw)
    return build_orders(clean_transactions(identified))


def cancellations_of_raw(raw: DataFrame) -> DataFrame:
    identified, _ = split_anonymous(raw)
    return extract_cancellations(identified)


def staged_lines(raw: DataFrame, folder: str | None = None) -> DataFrame:
    """All lines with their class, stored with just the columns that roll-ups read."""
    return stage(label_lines(raw).select(*ROLL_UP_COLUMNS), "lines", folder)


def orders_of_lines(lines: DataFrame) -> DataFrame:
    """Order rows of labelled lines, without the count of products."""
    sales = lines.filter(F.col(LINE_CLASS) == "transactions")
    return build_orders(sales.withColumn("stock_code", F.lit(None).cast("string"))).drop("unique_products")


def cancellations_of_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col(LINE_CLASS) == "cancellations")


def scored_customers(
    orders: Orders, config: AnalyticsConfig, staging: str | None = None
) -> DataFrame:
    """Customer values with scores and tier; reads ``orders`` once.

    Scores need the quartiles of all customers first, so the values are staged: the way
    from the orders to the customers is then done once, not once per reader.
    """
    value = stage(customer_value(orders, config), "customer-value", staging)
    return add_rfm(value, quartile_edges(value))


def build_customers(
    orders: Orders,
    cancellations: DataFrame,
    config: AnalyticsConfig,
    staging: str | None = None,
) -> DataFrame:
    """The complete customer table, from stored orders."""
    return (
        add_history(scored_customers(orders, config, staging), orders, config)
        .transform(add_return_flag, cancellations)
        .select(*schemas.CUSTOMERS.names)
    )


def build_tables(
    raw: DataFrame, folder: str, config: AnalyticsConfig, staging: str | None = None
) -> RetailTables:
    """Build all five stored tables and the audit; the raw feed is read once.

    Everything goes to a new version that replaces the old one only when complete. What was
    staged on the way is removed at the end.
    """
    spark = raw.sparkSession
    staging = staging or staging_folder(spark)  # fails here, before anything is written
    version = new_version(folder)
    seen = Observation(f"lines-{uuid4().hex}")
    lines = label_lines(raw).observe(seen, *line_counts())
    with released_after(spark):
        write_line_tables(lines.filter(F.col(LINE_CLASS).isNotNull()), version)
        transactions = read_version(spark, version, "transactions")
        hot = stage(hot_customers(transactions), "hot-customers", staging)
        write_orders(build_orders(transactions), version, hot)
        orders = order_parts(spark, version)
        cancellations = read_version(spark, version, "cancellations")
        customers = build_customers(orders, cancellations, config, staging)
        write_customers(customers, version)
        counts = [
            F.struct(F.lit(k).alias("metric"), F.lit(float(v)).alias("value"))
            for k, v in seen.get.items()
        ]
        counted = spark.range(1).select(F.inline(F.array(*counts)))
        audit = counted.unionByName(customer_audit(orders, config))
        audit.coalesce(1).write.parquet(f"{version}/audit")
    publish(spark, folder, version)
    return read_tables(spark, folder)


def run_reports(
    tables: RetailTables, folder: str, config: AnalyticsConfig, staging: str | None = None
) -> dict[str, int]:
    """Write every catalogued report in name order; row counts come with the write.

    What the reports take from the customers is counted for all of them in one pass and staged.
    """
    spark = tables.customers.sparkSession
    rows = {}
    with released_after(spark):
        groups = stage(customer_groups(tables.customers), "customer-groups", staging)
        for name in sorted(CATALOG):
            # A fresh name per run, so that repeated runs do not share a counter.
            seen = Observation(f"{name}-{uuid4().hex}")
            report = CATALOG[name](tables, config, groups)
            write_report(report.observe(seen, F.count(F.lit(1)).alias("rows")), folder, name)
            rows[name] = seen.get["rows"]
    return rows
