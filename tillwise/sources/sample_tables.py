"""Adapter: order-processing sample tables -> the raw line-item feed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.config import AnalyticsConfig

# Fixed value: the last order date of the sample tables.
SAMPLE_CONFIG = AnalyticsConfig(as_of=date(2001, 8, 1))


def sample_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.SAMPLE_TABLES[name]).parquet(f"{folder}/{name}.parquet")


def raw_from_sample_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their order's customer and country, in the raw column layout.

    Country names are attached to the orders first, so the wide line table takes part in
    one join only. Lines and order headers both grow with the data, so that join is asked
    to be a merge join: compressed file sizes would let Spark broadcast either side at small
    scale, and a merge join can spill and have its hot keys split.

    The sample tables are tidier than a till's feed, so fixed rules on the line itself lay in
    what such a feed holds: cancellations, bad quantities, zero prices, missing customer ids,
    invoices that run over two minutes or two countries, missing invoices and countries,
    lower-case prefixes, and texts with quotes, commas and accents.
    """
    lines = sample_table(spark, folder, "lineitem")
    orders = sample_table(spark, folder, "orders")
    customers = sample_table(spark, folder, "customer")
    nations = sample_table(spark, folder, "nation")

    headers = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = lines.join(headers.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    def every(n: int) -> Column:
        return F.col("l_partkey") % n == 0

    known = F.col("o_custkey") % 5 != 0
    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 48)
    taken_back = cancelled | ((F.col("l_linenumber") == 7) & (F.col("l_quantity") <= 2))
    free = (F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)
    prefix = F.when(cancelled, "C").when(~known & every(13), "c").otherwise("")
    quantity = F.col("l_quantity").cast("bigint")
    minute_later = F.col("o_orderdate") + F.expr("INTERVAL 1 MINUTE")
    return joined.select(
        F.when(~every(53), F.concat(prefix, F.col("o_orderkey").cast("string"))).alias("invoice"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.when(F.col("l_linenumber") == 1, 'sample "line", caf\u00e9')
        .otherwise("sample line")
        .alias("description"),
        F.when(taken_back, -quantity).otherwise(quantity).alias("quantity"),
        F.when(every(7), minute_later).otherwise(F.col("o_orderdate")).alias("invoice_date"),
        F.when(free, 0.0)
        .otherwise(F.try_divide("l_extendedprice", "l_quantity"))
        .alias("price"),
        F.when(known, F.col("o_custkey").cast("double")).alias("customer_id"),
        F.when(every(11), "ELSEWHERE")
        .when(every(97), F.lit(None))
        .otherwise(F.col("n_name"))
        .alias("country"),
    )
