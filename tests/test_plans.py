"""Physical plans: what must reach the scan, and what must never appear."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tests.fixture_data import fixture_raw
from tillwise import schemas
from tillwise.config import AnalyticsConfig
from tillwise.operators.customers import customer_features, most_frequent, purchase_gaps
from tillwise.operators.lines import clean_transactions, extract_cancellations, split_anonymous
from tillwise.operators.orders import build_orders
from tillwise.plans import pipeline, reports
from tillwise.sources import staging
from tillwise.sources.staging import release

CONFIG = AnalyticsConfig()
SMALL = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw lines and orders as Parquet, the form in which a cluster would hold them."""
    folder = tmp_path_factory.mktemp("stored")
    raw = fixture_raw(spark)
    raw.write.parquet(f"{folder}/raw")
    identified, _ = split_anonymous(raw)
    build_orders(clean_transactions(identified)).write.parquet(f"{folder}/orders")
    return (
        spark.read.schema(schemas.RAW).parquet(f"{folder}/raw"),
        spark.read.schema(schemas.ORDERS).parquet(f"{folder}/orders"),
    )


def test_sale_filter_reaches_the_scan(stored):
    identified, _ = split_anonymous(stored[0])
    plan = physical(clean_transactions(identified))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "IsNotNull(customer_id)" in pushed
    assert "GreaterThan(quantity,0)" in pushed
    assert "GreaterThan(price,0.0)" in pushed
    assert "Or(IsNull(invoice),Not(StringStartsWith(invoice,C)))" in pushed


def test_cancellation_scan_is_narrow(stored):
    identified, _ = split_anonymous(stored[0])
    plan = physical(extract_cancellations(identified).select("customer_id").distinct())
    assert "StringStartsWith(invoice,C)" in plan and "LessThan(quantity,0)" in plan
    assert "ReadSchema: struct<invoice:string,quantity:bigint,customer_id:double>" in plan


def test_unread_product_count_costs_nothing(stored):
    identified, _ = split_anonymous(stored[0])
    orders = build_orders(clean_transactions(identified))
    assert physical(orders).count("Exchange hashpartitioning") == 2
    pruned = physical(orders.drop("unique_products"))
    assert pruned.count("Exchange hashpartitioning") == 1
    assert "stock_code" not in pruned and "description" not in pruned


def test_product_count_spreads_a_giant_invoice(stored):
    identified, _ = split_anonymous(stored[0])
    plan = physical(build_orders(clean_transactions(identified)))
    first_shuffle = plan.split("Exchange hashpartitioning(")[-1]
    assert "stock_code" in first_shuffle.split(")")[0]


def test_rank_filter_cuts_before_the_shuffle(stored):
    plan = physical(purchase_gaps(stored[1], CONFIG))
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert "ReadSchema: struct<customer_id:string,order_date:date>" in plan


def test_mode_counts_before_the_key_shuffle(stored):
    plan = physical(most_frequent(stored[1], "customer_id", "country", "country"))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert ["country" in keys for keys in shuffles] == [False, True]


def test_features_have_no_further_shuffle_for_their_joins(stored):
    plan = physical(customer_features(stored[1], CONFIG))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # Distinct invoices and country counts take two each, the rank filter one.
    assert len(keys) == 5


def test_activity_makes_two_rows_of_an_order_and_spreads_days(stored):
    plan = physical(reports.activity_trend(stored[1]))
    assert "Expand" not in plan and plan.count("Generate inline(array(") >= 1
    first_shuffle = plan.split("Exchange hashpartitioning(")[-1].split(")")[0]
    assert "order_date" in first_shuffle and "id#" in first_shuffle
    week = physical(reports.activity_trend(stored[1], (reports.WEEK,)))
    assert week.count("FileScan parquet") == 1


def test_cohorts_join_customer_days(stored):
    gaps = purchase_gaps(stored[1], CONFIG)
    plan = physical(reports.cohort_retention(gaps, stored[1], CONFIG))
    assert "ReadSchema: struct<customer_id:string,order_date:date>" in plan
    assert "CartesianProduct" not in plan


def test_share_is_one_global_aggregate(stored):
    plan = physical(reports.anonymous_share(stored[0]))
    assert plan.count("FileScan parquet") == 1
    assert "hashpartitioning" not in plan
    assert "stock_code" not in plan
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "GreaterThan(quantity,0)" in pushed and "GreaterThan(price,0.0)" in pushed


@pytest.mark.parametrize(
    "name", ["return_flags", "customers", "returns_analysis", "pipeline_audit", "overview_kpis"]
)
def test_the_feed_is_read_and_joined_once(spark, name, monkeypatch):
    """One scan of the lines and one merge join with them, staged steps counted."""
    plans = []
    original = staging.stage

    def recorded(df, label, folder=None):
        plans.append(physical(df))
        return original(df, label, folder)

    for module in (entry_points, pipeline):
        monkeypatch.setattr(module, "stage", recorded)
    plans.append(physical(entry_points.queries()[name](spark, SMALL)))
    release(spark)
    assert sum(plan.count("lineitem.parquet") for plan in plans) == 1
    assert sum("l_orderkey" in plan and plan.count("SortMergeJoin [l_orderkey") for plan in plans) == 1


def test_tiers_need_no_history(spark, monkeypatch):
    plans = []
    original = staging.stage

    def recorded(df, label, folder=None):
        plans.append(physical(df))
        return original(df, label, folder)

    monkeypatch.setattr(pipeline, "stage", recorded)
    entry_points.churn_by_rfm_tier(spark, SMALL)
    release(spark)
    assert len(plans) == 1 and "Window" not in plans[0] and "cohort_month" not in plans[0]


@pytest.mark.parametrize("name", list(entry_points.retail_queries()))
def test_registered_plans(spark, name):
    plan = physical(entry_points.queries()[name](spark, SMALL).withColumn("one", F.lit(1)))
    release(spark)
    for unwanted in (
        "CartesianProduct",
        "BroadcastNestedLoopJoin",
        "BatchEvalPython",
        "ArrowEvalPython",
        "MapInPandas",
        "Scan ExistingRDD",
        "LocalTableScan",
    ):
        assert unwanted not in plan
