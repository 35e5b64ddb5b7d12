"""The five stored tables as Parquet folders.

The three line tables are partitions of one folder, so a single pass over the feed
writes all of them; a reader of one table touches only its own files.

A build writes into a version folder of its own. Only when all of it is there, the version
is entered in a log under the next free number (``commits``); readers take the latest entry.
So a build that fails leaves readers on the tables they had, and of two builds that end
together the one that is entered second is current, for all readers alike. Older versions
stay until ``drop_old_versions``.

Orders and customers are stored in buckets of the customer, so that whatever is aggregated
per customer, or joined on it, needs no shuffle. A bucket is one task's work; customers with
more rows than a task should get are therefore kept apart in a folder without buckets, and
``order_parts`` gives both.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise import schemas
from tillwise.operators.lines import LINE_CLASS
from tillwise.sources import commits
from tillwise.sources.buckets import forget, read_bucketed, write_bucketed
from tillwise.sources.files import delete

LINES_FOLDER = "lines"
LINE_TABLES = ("transactions", "anonymous_tx", "cancellations")
VERSION_LOG = "versions"
LAYOUT = "layout"
CUSTOMER = "customer_id"
BUCKETED = ("orders", "customers")

#: Sale lines from which a customer's orders are kept apart: what one task reads in seconds.
HOT_LINES = 1_000_000


@dataclass(frozen=True)
class RetailTables:
    transactions: DataFrame
    anonymous_tx: DataFrame
    cancellations: DataFrame
    orders: DataFrame
    customers: DataFrame
    #: The orders in parts without a common customer; the first one is in buckets.
    order_parts: tuple[DataFrame, ...] = ()

    def register_views(self) -> None:
        """Make the tables available to ``spark.sql`` under their own names."""
        for name in schemas.TABLES:
            getattr(self, name).createOrReplaceTempView(name)


def new_version(folder: str) -> str:
    """The path of a version that no reader sees yet."""
    return f"{folder}/tables-{uuid4().hex}"


def publish(spark: SparkSession, folder: str, version: str) -> int:
    """Make a complete version the one that readers get; its number in the log."""
    return commits.append(spark, f"{folder}/{VERSION_LOG}", version.rsplit("/", 1)[-1])


def _versions(spark: SparkSession, folder: str, numbers: list[int]) -> list[str]:
    return [f"{folder}/{commits.read(spark, f'{folder}/{VERSION_LOG}', n)}" for n in numbers]


def current_version(spark: SparkSession, folder: str) -> str:
    logged = commits.numbers(spark, f"{folder}/{VERSION_LOG}")
    if not logged:
        raise FileNotFoundError(f"no tables were built in {folder}")
    return _versions(spark, folder, logged[-1:])[0]


def drop_old_versions(spark: SparkSession, folder: str) -> None:
    """Remove all versions but the current one; their readers must be done.

    Their entries stay, so that no number is used again.
    """
    for version in _versions(spark, folder, commits.numbers(spark, f"{folder}/{VERSION_LOG}")[:-1]):
        for name in BUCKETED:
            forget(spark, f"{version}/{name}")
        delete(spark, version)


def write_line_tables(lines: DataFrame, version: str) -> None:
    """The three line tables from classified lines, without a shuffle."""
    (
        lines.select(*schemas.LINES.names, LINE_CLASS)
        .write.mode("overwrite")
        # Overwriting means all partitions, whatever the session's own mode is.
        .option("partitionOverwriteMode", "static")
        .partitionBy(LINE_CLASS)
        .parquet(f"{version}/{LINES_FOLDER}")
    )


def hot_customers(transactions: DataFrame) -> DataFrame:
    """Customers with more than HOT_LINES sale lines; no more than one for each so many lines."""
    lines = transactions.filter(F.col(CUSTOMER).isNotNull()).groupBy(CUSTOMER).count()
    return lines.filter(F.col("count") > HOT_LINES).select(CUSTOMER)


def write_orders(orders: DataFrame, version: str, hot: DataFrame, buckets: int | None = None) -> None:
    """The orders in buckets, those of ``hot`` customers in a folder of their own."""
    spark = orders.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = orders.select(*schemas.ORDERS.names)
    split = not hot.isEmpty()
    if split:
        orders.join(hot, CUSTOMER, "left_semi").select(*schemas.ORDERS.names).write.parquet(f"{version}/orders-hot")
        orders = orders.join(hot, CUSTOMER, "left_anti").select(*schemas.ORDERS.names)
    write_bucketed(orders, f"{version}/orders", CUSTOMER, buckets, [CUSTOMER, "order_date"])
    layout = json.dumps({"buckets": buckets, "hot": split})
    commits.create(spark, f"{version}/{LAYOUT}", layout)


def write_customers(customers: DataFrame, version: str) -> None:
    """The customers in as many buckets as the orders of the version."""
    buckets = _layout(customers.sparkSession, version)["buckets"]
    rows = customers.select(*schemas.CUSTOMERS.names)
    write_bucketed(rows, f"{version}/customers", CUSTOMER, buckets, [CUSTOMER])


def _layout(spark: SparkSession, version: str) -> dict:
    return json.loads(commits.read_text(spark, f"{version}/{LAYOUT}"))


def order_parts(spark: SparkSession, version: str) -> tuple[DataFrame, ...]:
    """The orders of a version in parts without a common customer; the first one is in buckets."""
    layout = _layout(spark, version)
    parts = (read_bucketed(spark, f"{version}/orders", schemas.ORDERS, CUSTOMER, layout["buckets"]),)
    if layout["hot"]:
        parts += (spark.read.schema(schemas.ORDERS).parquet(f"{version}/orders-hot"),)
    return parts


def read_version(spark: SparkSession, version: str, name: str) -> DataFrame:
    """One table of a version."""
    schema = schemas.TABLES[name]
    if name == "orders":
        return reduce(DataFrame.unionByName, order_parts(spark, version))
    if name == "customers":
        buckets = _layout(spark, version)["buckets"]
        return read_bucketed(spark, f"{version}/{name}", schema, CUSTOMER, buckets)
    stored = T.StructType([*schema.fields, T.StructField(LINE_CLASS, T.StringType())])
    return (
        spark.read.schema(stored)
        .parquet(f"{version}/{LINES_FOLDER}")
        .filter(F.col(LINE_CLASS) == name)
        .drop(LINE_CLASS)
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_version(spark, current_version(spark, folder), name)


def read_tables(spark: SparkSession, folder: str) -> RetailTables:
    version = current_version(spark, folder)
    tables = {name: read_version(spark, version, name) for name in schemas.TABLES}
    return RetailTables(**tables, order_parts=order_parts(spark, version))


def read_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts and churn of the current version, as its build found them."""
    version = current_version(spark, folder)
    return spark.read.schema(schemas.AUDIT).parquet(f"{version}/audit")
