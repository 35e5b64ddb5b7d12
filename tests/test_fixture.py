"""Operators and reports on the hand-made lines (as of 2011-12-09)."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.fixture_data import fixture_raw
from tillwise import schemas
from tillwise.config import AnalyticsConfig
from tillwise.operators.customers import purchase_gaps, return_flags
from tillwise.operators.lines import (
    classify_lines,
    clean_transactions,
    extract_cancellations,
    label_lines,
    split_anonymous,
)
from tillwise.operators.orders import build_orders
from tillwise.operators.rfm import quartile_edges
from tillwise.plans import kpis, reports
from tillwise.plans.pipeline import build_customers

CONFIG = AnalyticsConfig()


@pytest.fixture(scope="module")
def raw(spark):
    return fixture_raw(spark)


@pytest.fixture(scope="module")
def parts(raw):
    identified, anonymous = split_anonymous(raw)
    return (
        clean_transactions(identified).cache(),
        extract_cancellations(identified).cache(),
        anonymous,
    )


@pytest.fixture(scope="module")
def orders(parts):
    return build_orders(parts[0]).cache()


@pytest.fixture(scope="module")
def customers(parts, orders):
    return build_customers(orders, parts[1], CONFIG).cache()


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_line_tables(raw, parts):
    sales, cancellations, anonymous = parts
    assert sales.count() == 10
    assert sorted(r.invoice for r in cancellations.collect()) == ["C500002", "C500014"]
    assert {r.revenue for r in cancellations.collect()} == {-1.5, -1.0}
    assert sorted(r.invoice for r in anonymous.collect()) == ["500010", "c500009"]
    assert anonymous.filter("customer_id is not null").count() == 0
    # A missing invoice number stays in the sales.
    assert sales.filter("invoice is null").count() == 1
    # Ids are digits only.
    assert {r.customer_id for r in sales.collect()} == {"1", "2", "3", "4"}


def test_one_pass_classification_gives_the_same_tables(raw, parts):
    lines = classify_lines(raw)
    assert dict(rows(lines.groupBy("line_class").count())) == {
        "transactions": 10,
        "cancellations": 2,
        "anonymous_tx": 2,
    }
    sales = lines.filter("line_class = 'transactions'").drop("line_class")
    assert sorted(map(repr, rows(sales))) == sorted(map(repr, rows(parts[0])))


def test_orders(orders):
    assert orders.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.ORDERS
    ]
    found = sorted(rows(orders, "invoice", "total_items", "total_revenue", "unique_products"))
    assert found == [
        # One invoice keyed over two minutes gives two order rows.
        ("500001", 1, 1.5, 1),
        ("500001", 3, 5.0, 2),
        ("500003", 1, 1.0, 1),
        ("500004", 1, 1.0, 1),
        ("500005", 1, 1.0, 1),
        ("500011", 1, 3.0, 1),
        ("500012", 1, 3.0, 1),
        ("500013", 1, 3.0, 1),
    ]


def test_customers(customers):
    assert customers.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.CUSTOMERS
    ]
    columns = [
        "customer_id", "first_order_date", "last_order_date", "frequency", "monetary",
        "recency_days", "churned", "time_to_second_order_days", "made_second_purchase",
        "had_repeat_within_30d", "had_return", "country", "r_score", "f_score", "m_score",
        "rfm_tier",
    ]
    d = date
    assert sorted(rows(customers, *columns)) == [
        ("1", d(2011, 1, 10), d(2011, 1, 10), 1, 6.5, 333, 1, 0, 1, 1, 1, "UK", 2, 1, 3, "Lost"),
        ("2", d(2011, 9, 10), d(2011, 9, 10), 1, 1.0, 90, 0, None, 0, 0, 0, "UK", 4, 1, 1, "New"),
        ("3", d(2011, 8, 10), d(2011, 9, 9), 2, 2.0, 91, 1, 30, 1, 1, 0, "France", 3, 2, 2,
         "Lost"),
        ("4", d(2010, 1, 2), d(2011, 1, 3), 3, 9.0, 340, 1, 365, 1, 0, 0, "UK", 1, 2, 4,
         "At Risk"),
    ]


def test_gaps_agree_with_customer_table(orders, customers):
    columns = [
        "customer_id", "first_order_date", "time_to_second_order_days",
        "had_repeat_within_30d", "made_second_purchase",
    ]
    gaps = purchase_gaps(orders, CONFIG)
    assert sorted(map(repr, rows(gaps, *columns))) == sorted(map(repr, rows(customers, *columns)))


def test_quartile_edges(customers):
    edges = quartile_edges(customers)
    assert edges.recency_days == pytest.approx([90.75, 212.0, 334.75], abs=0)
    assert edges.monetary == pytest.approx([1.75, 4.25, 7.125], abs=0)


def test_churn_report(customers):
    assert rows(reports.churn_by_rfm_tier(customers)) == [
        ("At Risk", 1, 1, 100.0, 9.0, 3.0, "Critical"),
        ("Lost", 2, 2, 100.0, 4.25, 1.5, "Critical"),
        ("New", 1, 0, 0.0, 1.0, 1.0, "Healthy"),
    ]


def test_cohort_report(customers, orders):
    assert rows(reports.cohort_retention(customers, orders, CONFIG)) == [
        ("2010-01", 1, 0, 1, 100.0),
        ("2010-01", 1, 11, 1, 100.0),
        ("2011-01", 1, 0, 1, 100.0),
        ("2011-08", 1, 0, 1, 100.0),
        ("2011-09", 1, 0, 1, 100.0),
    ]


def test_retention_matrix(customers, orders):
    report = reports.cohort_retention(customers, orders, CONFIG)
    assert kpis.retention_matrix(report, CONFIG).count() == 0
    matrix = kpis.retention_matrix(report, CONFIG, min_size=1)
    assert matrix.columns == ["cohort_month"] + [f"m{k}" for k in range(12)]
    first = matrix.first()
    assert (first.cohort_month, first.m0, first.m1, first.m11) == ("2010-01", 100.0, None, 100.0)


def test_activity_report(orders):
    report = reports.activity_trend(orders)
    found = rows(report)
    assert found[0] == ("2010-01-02 00:00:00", "day", 1, 1, 3.0)
    # Two order rows of one invoice count as one invoice.
    assert ("2011-01-10 00:00:00", "day", 1, 1, 6.5) in found
    weeks = [r for r in found if r[1] == "week"]
    assert [w[0] for w in weeks] == ["2010-00", "2011-00", "2011-01", "2011-02", "2011-32",
                                     "2011-36"]
    assert found == sorted(found, key=lambda r: (r[1], r[0]))
    # Customers 2 and 3 both ordered in week 36, on different days.
    assert rows(kpis.activity_kpis(report)) == [(1, 2, 6.5, 1.0)]
    assert kpis.activity_of(report, "week").count() == len(weeks)


def test_second_purchase_report(customers):
    assert rows(reports.time_to_second_purchase(customers)) == [
        ("One-time only", 1, 1, 1, 100.0),
        ("Within 7 days", 2, 1, 0, 0.0),
        ("8-30 days", 3, 1, 0, 0.0),
        ("90+ days", 5, 1, 0, 0.0),
    ]


def test_order_count_report(customers):
    assert rows(reports.order_frequency_aha(customers)) == [
        ("1", 1, 2, 1, 50.0),
        ("2", 2, 1, 0, 0.0),
        ("3", 3, 1, 0, 0.0),
    ]


def test_order_count_report_pools_high_counts(spark):
    customers = spark.createDataFrame(
        [(10, 0), (11, 0), (12, 1), (500, 1)], "frequency bigint, churned int"
    )
    assert rows(reports.order_frequency_aha(customers)) == [
        ("10", 10, 1, 1, 100.0),
        ("11+", 11, 3, 1, 33.3),
    ]


def test_share_report(raw, parts):
    expected = [
        ("Identified", 10, 19.5, 1.95, 90.9, 66.1),
        ("Anonymous", 1, 10.0, 10.0, 9.1, 33.9),
    ]
    sales, _, anonymous = parts
    with_revenue = anonymous.withColumn("revenue", F.col("quantity") * F.col("price"))
    assert rows(reports.anonymous_share(sales.unionByName(with_revenue))) == expected
    assert rows(reports.anonymous_share(raw)) == expected


def test_return_flags_of_lines(raw, customers):
    found = return_flags(label_lines(raw))
    assert sorted(rows(found)) == sorted(rows(customers, "customer_id", "had_return"))


def test_share_report_of_nothing(raw):
    assert rows(reports.anonymous_share(raw.filter("quantity > 1000"))) == [
        ("Identified", 0, None, None, None, None),
        ("Anonymous", 0, None, None, None, None),
    ]


def test_returns_report(customers):
    assert rows(reports.returns_analysis(customers)) == [
        ("Made a return", 1, 0, 0.0, 6.5, 1.0),
        ("No returns", 3, 1, 33.3, 4.0, 2.0),
    ]


def test_overview(customers, raw):
    overview = kpis.overview_kpis(
        reports.churn_by_rfm_tier(customers), reports.anonymous_share(raw)
    ).first()
    assert overview.total_customers == 4
    assert overview.overall_churn_pct == 75.0
    assert overview.total_revenue == 19.5
    assert overview.total_revenue_from_tiers == 18.5
    assert overview.anonymous_revenue_pct == pytest.approx(33.9)


def test_repeat_and_tiers(customers):
    assert rows(kpis.repeat_30d_retention(customers)) == [(0, 2, 1, 50.0), (1, 2, 0, 0.0)]
    assert rows(kpis.tier_counts(customers)) == [("Lost", 2), ("At Risk", 1), ("New", 1)]


def test_audit(raw, orders):
    assert dict(rows(kpis.pipeline_audit(label_lines(raw), orders, CONFIG))) == {
        "raw_rows": 17.0,
        "identified_rows": 15.0,
        "anonymous_rows": 2.0,
        "transaction_rows": 10.0,
        "cancellation_rows": 2.0,
        "order_rows": 8.0,
        "customers": 4.0,
        "churn_pct": 75.0,
    }
