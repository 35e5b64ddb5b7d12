"""The whole way from lines to reports against a plain-Python brute force.

The lines are random but harsh: a third of them belong to one customer, one invoice and
one day; ids, invoices, countries and dates are missing here and there; invoices spread
over minutes, days and countries; prefixes come in both cases.
"""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest

from tests.test_fixture import rows
from tillwise import schemas
from tillwise.config import AnalyticsConfig
from tillwise.operators.lines import classify_lines
from tillwise.operators.orders import build_orders
from tillwise.plans import reports
from tillwise.plans.pipeline import build_customers

CONFIG = AnalyticsConfig(as_of=date(2011, 12, 9))


def half_up(value: Decimal | float, digits: int) -> float:
    exact = value if isinstance(value, Decimal) else Decimal(repr(value))
    return float(exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def random_lines(seed: int, size: int = 4000) -> list[tuple]:
    rng = random.Random(seed)
    start = datetime(2010, 1, 1, 8, 0)
    lines = []
    for _ in range(size):
        hot = rng.random() < 1 / 3
        customer = 1.0 if hot else rng.choice([None, *range(1, 120)])
        number = "7" if hot and rng.random() < 0.5 else str(rng.randint(1, 900))
        prefix = rng.choices(["", "C", "c"], [90, 8, 2])[0]
        at = start if hot and rng.random() < 0.5 else start + timedelta(
            days=rng.randint(0, 700), minutes=rng.choice([0, 0, 1, 2])
        )
        lines.append(
            (
                None if rng.random() < 0.02 else prefix + number,
                None if rng.random() < 0.02 else f"P{rng.randint(1, 30)}",
                "text",
                rng.choice([-3, -1, 0, 1, 2, 5, 12, 12, 40]),
                at,
                rng.choice([0.0, -1.0, 0.42, 1.25, 2.55, 9.99, 120.5]),
                None if customer is None else float(customer),
                rng.choice(["UK", "UK", "France", "Spain", None]),
            )
        )
    return lines


def brute_force(lines):
    sales, returners, anonymous = [], set(), []
    for line in lines:
        invoice, _, _, quantity, _, price, customer, _ = line
        if customer is None:
            good = invoice is not None and invoice[:1] not in ("C", "c")
            if good and quantity > 0 and price > 0:
                anonymous.append(line)
        elif invoice is not None and invoice.startswith("C"):
            if quantity < 0:
                returners.add(str(int(customer)))
        elif quantity > 0 and price > 0:
            sales.append(line)

    orders = {}
    for invoice, stock, _, quantity, at, price, customer, country in sales:
        if invoice is None or country is None:
            continue
        key = (invoice, str(int(customer)), at, country)
        items, revenue, products = orders.setdefault(key, [0, Decimal(0), set()])
        orders[key][0] = items + quantity
        orders[key][1] = revenue + Decimal(repr(quantity * price)).quantize(Decimal("1e-6"))
        if stock is not None:
            products.add(stock)

    by_customer = defaultdict(list)
    for (invoice, customer, at, country), (items, revenue, _) in orders.items():
        by_customer[customer].append((at.date(), invoice, country, items, revenue))
    customers = {}
    for customer, mine in by_customer.items():
        days = sorted(day for day, *_ in mine)
        countries = Counter(country for _, _, country, _, _ in mine)
        top = max(countries.values())
        customers[customer] = {
            "first": days[0],
            "last": days[-1],
            "gap": (days[1] - days[0]).days if len(days) > 1 else None,
            "frequency": len({invoice for _, invoice, *_ in mine}),
            "items": sum(items for *_, items, _ in mine),
            "monetary": half_up(sum(revenue for *_, revenue in mine), 2),
            "country": min(c for c, n in countries.items() if n == top),
            "recency": (CONFIG.as_of - days[-1]).days,
            "returned": int(customer in returners),
        }
    return sales, anonymous, orders, customers


def tier_of(c, edges):
    recent = c["recency"] <= edges[1]
    if c["frequency"] >= 4:
        return "Champions" if recent else "Loyal"
    if recent:
        return "New" if c["frequency"] == 1 else "Lost"
    return "At Risk" if c["frequency"] >= 2 else "Lost"


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    lines = random_lines(request.param)
    classified = classify_lines(spark.createDataFrame(lines, schemas.RAW)).cache()

    def part(name):
        return classified.filter(classified.line_class == name).drop("line_class")

    orders = build_orders(part("transactions")).cache()
    customers = build_customers(orders, part("cancellations"), CONFIG).cache()
    return part, orders, customers, brute_force(lines)


def test_orders(case):
    _, orders, _, (_, _, expected, _) = case
    found = {
        (r.invoice, r.customer_id, r.invoice_date, r.country): (
            r.total_items, r.total_revenue, r.unique_products,
        )
        for r in orders.collect()
    }
    assert found == {
        key: (items, float(revenue), len(products))
        for key, (items, revenue, products) in expected.items()
    }


def test_customers(case):
    _, _, customers, (_, _, _, expected) = case
    edges = np.quantile([c["recency"] for c in expected.values()], [0.25, 0.5, 0.75])
    money_edges = np.quantile([c["monetary"] for c in expected.values()], [0.25, 0.5, 0.75])
    assert customers.count() == len(expected)
    for r in customers.collect():
        c = expected[r.customer_id]
        assert (r.first_order_date, r.last_order_date) == (c["first"], c["last"])
        assert r.cohort_month == c["first"].strftime("%Y-%m")
        assert r.time_to_second_order_days == c["gap"]
        assert r.made_second_purchase == int(c["gap"] is not None)
        assert r.had_repeat_within_30d == int(c["gap"] is not None and c["gap"] <= 30)
        assert (r.frequency, r.total_orders) == (c["frequency"], c["frequency"])
        assert (r.total_items, r.monetary) == (c["items"], c["monetary"])
        assert (r.country, r.had_return) == (c["country"], c["returned"])
        assert (r.recency_days, r.churned) == (c["recency"], int(c["recency"] > 90))
        assert r.r_score == 4 - int(np.searchsorted(edges, c["recency"]))
        assert r.m_score == 1 + int(np.searchsorted(money_edges, c["monetary"]))
        assert r.rfm_tier == tier_of(c, edges)


def test_activity(case):
    _, orders, _, (_, _, expected, _) = case
    groups = defaultdict(lambda: (set(), set(), []))
    for (invoice, customer, at, _), (_, revenue, _) in expected.items():
        for key in ((at.strftime("%Y-%m-%d 00:00:00"), "day"), (at.strftime("%Y-%W"), "week")):
            people, invoices, money = groups[key]
            people.add(customer)
            invoices.add(invoice)
            money.append(revenue)
    wanted = [
        (period, kind, len(people), len(invoices), half_up(sum(money), 2))
        for (period, kind), (people, invoices, money) in groups.items()
    ]
    assert rows(reports.activity_trend(orders)) == sorted(wanted, key=lambda r: (r[1], r[0]))


def test_cohorts(case):
    _, orders, customers, (_, _, expected_orders, expected) = case
    sizes = Counter(c["first"].strftime("%Y-%m") for c in expected.values())
    active = defaultdict(set)
    for (_, customer, at, _) in expected_orders:
        first = expected[customer]["first"]
        offset = int((at.date() - first).days / 30.44)
        if offset <= 11:
            active[first.strftime("%Y-%m"), offset].add(customer)
    wanted = sorted(
        (cohort, sizes[cohort], offset, len(who), half_up(100.0 * len(who) / sizes[cohort], 1))
        for (cohort, offset), who in active.items()
    )
    assert rows(reports.cohort_retention(customers, orders, CONFIG)) == wanted


def test_share(case):
    part, _, _, (sales, anonymous, _, _) = case
    report = rows(reports.anonymous_share(part("transactions").unionByName(part("anonymous_tx"))))
    totals = [
        half_up(sum(Decimal(repr(line[3] * line[5])) for line in group), 2)
        for group in (sales, anonymous)
    ]
    counts = [len(sales), len(anonymous)]
    for row, label, count, total in zip(report, ("Identified", "Anonymous"), counts, totals):
        assert row[:3] == (label, count, total)
        assert row[4] == half_up(100.0 * count / sum(counts), 1)
        assert row[5] == half_up(100.0 * total / sum(totals), 1)


def test_reports_agree_with_each_other(case):
    _, orders, customers, (_, _, _, expected) = case
    churn = reports.churn_by_rfm_tier(customers).collect()
    retained = len(expected) - sum(r.churned_customers for r in churn)
    assert sum(r.total_customers for r in churn) == len(expected)
    for report in (
        reports.time_to_second_purchase(customers),
        reports.order_frequency_aha(customers),
        reports.returns_analysis(customers),
    ):
        found = report.collect()
        assert sum(r.total_customers for r in found) == len(expected)
        assert sum(r.retained_customers for r in found) == retained

    cohorts = reports.cohort_retention(customers, orders, CONFIG).collect()
    first = [r for r in cohorts if r.months_since_first == 0]
    assert sum(r.cohort_size for r in first) == len(expected)
    assert all(r.retention_pct == 100.0 for r in first)
    assert {r.cohort_month for r in first} == {r.cohort_month for r in cohorts}

    trend = reports.activity_trend(orders).collect()
    days = [r for r in trend if r.granularity == "day"]
    weeks = [r for r in trend if r.granularity == "week"]
    assert sum(r.revenue for r in days) == pytest.approx(sum(r.revenue for r in weeks))
    rebuilt = {datetime.fromisoformat(r.period).strftime("%Y-%W") for r in days}
    assert rebuilt == {r.period for r in weeks}
