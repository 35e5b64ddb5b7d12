"""Orders and customers in buckets: no shuffle on the customer, hot customers apart, one pass for the reports."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tests.fixture_data import fixture_raw
from tests.test_fixture import rows
from tillwise import schemas
from tillwise.config import AnalyticsConfig
from tillwise.operators.customers import customer_features, customer_totals, most_frequent, purchase_gaps
from tillwise.plans import pipeline, reports
from tillwise.plans.kpis import customer_audit
from tillwise.plans.pipeline import build_tables, run_reports
from tillwise.sources import buckets, tables
from tillwise.sources.sample_tables import SAMPLE_CONFIG, raw_from_sample_tables
from tillwise.sources.staging import release
from tillwise.sources.tables import current_version, order_parts, read_table, read_tables

CONFIG = AnalyticsConfig()
SMALL = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def customer_shuffles(df) -> list[str]:
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", physical(df))
    return [k for k in keys if "customer_id" in k]


@pytest.fixture(scope="module")
def merge_joins(spark):
    """Joins as they are on tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    build_tables(raw_from_sample_tables(spark, SMALL), out, SAMPLE_CONFIG)
    return out


@pytest.fixture(scope="module")
def stored(spark, folder):
    return read_tables(spark, folder)


def test_nothing_per_customer_shuffles(stored, merge_joins):
    parts = stored.order_parts
    assert len(parts) == 1
    for found in (
        customer_totals(parts),
        purchase_gaps(parts, CONFIG),
        most_frequent(parts[0], "customer_id", "country", "country"),
        customer_features(parts, CONFIG),
    ):
        assert "Exchange" not in physical(found)
    assert customer_shuffles(customer_audit(parts, CONFIG)) == []


def test_cohorts_join_where_they_are(stored, merge_joins):
    report = reports.cohort_retention(stored.customers, stored.order_parts, CONFIG)
    assert customer_shuffles(report) == [] and "SortMergeJoin [customer_id" in physical(report)


def test_buckets_change_no_value(spark, stored):
    # The same rows as a plain folder.
    plain = spark.read.schema(schemas.ORDERS).parquet(*stored.orders.inputFiles())
    assert len(customer_shuffles(customer_features(plain, CONFIG))) == 5
    of = lambda df: sorted(rows(df.select(sorted(df.columns))))
    assert of(customer_features(stored.order_parts, CONFIG)) == of(customer_features(plain, CONFIG))
    assert of(reports.cohort_retention(stored.customers, stored.order_parts, CONFIG)) == of(
        reports.cohort_retention(stored.customers, plain, CONFIG)
    )


def test_a_session_that_did_not_build_finds_the_buckets(spark, folder, merge_joins):
    version = current_version(spark, folder)
    for name in tables.BUCKETED:
        buckets.forget(spark, f"{version}/{name}")
    (orders,) = order_parts(spark, version)
    assert orders.columns == schemas.ORDERS.names and orders.count() > 0
    assert "Exchange" not in physical(customer_totals(orders))
    assert read_table(spark, folder, "customers").count() == orders.select("customer_id").distinct().count()


def test_each_bucket_is_one_file(spark, stored):
    files = stored.order_parts[0].inputFiles()
    numbers = [re.search(r"_(\d{5})\.", f).group(1) for f in files]
    assert len(set(numbers)) == len(numbers) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_hot_customers_are_kept_apart(spark, tmp_path, monkeypatch, stored):
    """With a low bound most customers are hot: same tables, and their rows are in no bucket."""
    monkeypatch.setattr(tables, "HOT_LINES", 60)
    build_tables(raw_from_sample_tables(spark, SMALL), str(tmp_path), SAMPLE_CONFIG)
    split = read_tables(spark, str(tmp_path))
    regular, hot = split.order_parts
    assert 0 < hot.count() and 0 < regular.count()
    assert regular.join(hot, "customer_id", "left_semi").count() == 0
    lines = split.transactions.groupBy("customer_id").count()
    assert lines.join(regular, "customer_id", "left_semi").agg(F.max("count")).first()[0] <= 60
    assert lines.join(hot, "customer_id", "left_semi").agg(F.min("count")).first()[0] > 60
    of = lambda df: sorted(rows(df.select(sorted(df.columns))), key=str)
    for name in ("orders", "customers"):
        assert of(getattr(split, name)) == of(getattr(stored, name))
    for report in ("cohort_retention", "activity_trend", "churn_by_rfm_tier"):
        assert of(reports.CATALOG[report](split, SAMPLE_CONFIG)) == of(reports.CATALOG[report](stored, SAMPLE_CONFIG))
    assert of(customer_features(split.order_parts, CONFIG)) == of(customer_features(stored.order_parts, CONFIG))


def test_reports_read_the_customers_once(spark, stored, tmp_path, monkeypatch):
    """One scan for all reports that count customers, one for the cohort join."""
    plans = []

    def staged(df, label, folder=None):
        plans.append(physical(df))
        return original_stage(df, label, folder)

    def written(report, folder, name):
        plans.append(physical(report))
        return original_write(report, folder, name)

    original_stage, original_write = pipeline.stage, pipeline.write_report
    monkeypatch.setattr(pipeline, "stage", staged)
    monkeypatch.setattr(pipeline, "write_report", written)
    run_reports(stored, str(tmp_path), SAMPLE_CONFIG)
    scans = [len(re.findall(r"FileScan parquet [\w.]*tillwise_\w+\[[^\]]*(?:rfm_tier|first_order_date)#", p)) for p in plans]
    assert sum(scans) == 2


def test_groups_counted_together_equal_groups_counted_alone(stored):
    together = reports.customer_groups(stored.customers)
    for name in reports.CUSTOMER_LABELS:
        alone = reports.CATALOG[name](stored, SAMPLE_CONFIG)
        shared = reports.CATALOG[name](stored, SAMPLE_CONFIG, together)
        assert rows(shared) == rows(alone) and shared.dtypes == alone.dtypes


def test_breakdowns_add_up_to_the_share(spark):
    raw = fixture_raw(spark).unionByName(fixture_raw(spark).limit(3).withColumn("country", F.lit(None).cast("string")))
    share = {r.customer_type: r for r in reports.anonymous_share(raw).collect()}
    for report in (reports.anonymous_by_country(raw), reports.anonymous_by_month(raw)):
        total = report.agg(*(F.sum(c).alias(c) for c in report.columns[1:5])).first()
        for label in ("identified", "anonymous"):
            assert total[f"{label}_lines"] == share[label.title()].transaction_count
            assert total[f"{label}_revenue"] == pytest.approx(share[label.title()].total_revenue)


def test_registered_plan_of_stored_features(spark, merge_joins):
    found = entry_points.queries()["stored_customer_features"](spark, SMALL)
    assert "Exchange" not in physical(found)
    release(spark)
