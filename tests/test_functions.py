"""Column helpers against plain Python and pandas."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_fixture import rows
from tillwise.functions.calendar import day_key, month_key, month_offset, week_key
from tillwise.functions.numbers import plain_text, rate_pct, rounded, share_pct
from tillwise.operators import quantiles
from tillwise.operators.quantiles import exact_quantiles
from tillwise.operators.rfm import bin_score, tier


def test_week_key_equals_strftime_for_every_day(spark):
    start = date(1990, 1, 1)
    days = [(start + timedelta(n),) for n in range(50 * 366)]
    df = spark.createDataFrame(days, "day date").select("day", week_key(F.col("day")))
    assert all(key == day.strftime("%Y-%W") for day, key in df.collect())


def test_day_and_month_keys(spark):
    df = spark.createDataFrame([(date(2009, 12, 1),)], "day date")
    assert rows(df.select(day_key(F.col("day")), month_key(F.col("day")))) == [
        ("2009-12-01 00:00:00", "2009-12")
    ]


@pytest.mark.parametrize(
    ("days", "offset"), [(0, 0), (30, 0), (31, 1), (365, 11), (366, 12), (-31, -1), (-30, 0)]
)
def test_month_offset_truncates(spark, days, offset):
    first = date(2010, 1, 2)
    df = spark.createDataFrame([(first, first + timedelta(days))], "first date, day date")
    assert df.select(month_offset(F.col("day"), F.col("first"), 30.44)).first()[0] == offset


def test_rounding(spark):
    values = [(1.005, 1.01), (2.675, 2.68), (-1.005, -1.01), (0.25, 0.25), (12.344999, 12.34)]
    df = spark.createDataFrame(values, "value double, expected double")
    assert all(a == b for a, b in df.select(rounded(F.col("value"), 2), "expected").collect())


def test_share_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0)], "part bigint, whole bigint")
    assert df.select(share_pct(F.col("part"), F.col("whole"))).first()[0] is None


def test_rate(spark):
    df = spark.createDataFrame([(1,), (0,), (0,)], "flag int")
    assert df.agg(rate_pct(F.col("flag"))).first()[0] == 33.3


def test_plain_text_has_no_exponent(spark):
    values = [(17743429.18,), (100.0,), (0.5,), (77.3,), (None,), (1.23456,)]
    df = spark.createDataFrame(values, "v double")
    texts = [r[0] for r in df.select(plain_text(F.col("v"))).collect()]
    assert texts == ["17743429.18", "100.0", "0.5", "77.3", None, "1.23456"]


def test_bins_equal_pandas_qcut(spark):
    generator = np.random.default_rng(7)
    values = pd.Series(np.round(generator.lognormal(5, 2, 1237), 2))
    df = spark.createDataFrame(values.to_frame("v")).cache()
    edges = exact_quantiles(df, ["v"], [0.25, 0.5, 0.75])["v"]
    scored = df.select("v", bin_score(F.col("v"), edges, [1, 2, 3, 4]).alias("score")).toPandas()
    wanted = pd.qcut(values, 4, labels=[1, 2, 3, 4]).astype(int)
    assert scored["score"].tolist() == wanted.tolist()


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 10, 100, 1202, 30_011])
def test_quantiles_equal_numpy(spark, size):
    generator = np.random.default_rng(size)
    table = pd.DataFrame(
        {
            "money": np.round(generator.lognormal(3, 3, size), 2),
            "days": generator.integers(0, 40, size).astype("int64"),
            # Two thirds of all rows share one value.
            "hot": np.where(generator.random(size) < 0.67, 5.0, generator.normal(5, 1, size)),
        }
    )
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    df = spark.createDataFrame(table).repartition(8).cache()
    found = exact_quantiles(df, ["money", "days", "hot"], probabilities)
    for column in table:
        assert found[column] == pytest.approx(
            np.quantile(table[column], probabilities).tolist(), rel=1e-12
        )
    df.unpersist()


def test_quantiles_ignore_nulls_and_refuse_nothing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]) == {"v": [2.0]}
    with pytest.raises(ValueError, match="no values"):
        exact_quantiles(df.filter("v > 5"), ["v"], [0.5])


def test_quantiles_survive_a_misleading_sketch(spark, monkeypatch):
    """Brackets that miss their rank are widened until the result is exact."""
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 3)
    monkeypatch.setattr(quantiles, "MOST_VALUES", 700)
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    found = exact_quantiles(df, ["v"], [0.25, 0.5, 0.75])
    assert found == {"v": [249.75, 499.5, 749.25]}


@pytest.mark.parametrize("size", [20_000, 200_000])
def test_no_task_sorts_more_than_the_bound(spark, monkeypatch, size):
    """The largest window partition stays under the bound, ten times the rows or not."""
    monkeypatch.setattr(quantiles, "MOST_VALUES", 500)
    seen = []
    original = quantiles._select

    def watched(df, brackets):
        seen.extend(
            df.select(b.row().alias("v")).filter("v IS NOT NULL").distinct().count()
            for b in brackets.values()
        )
        return original(df, brackets)

    monkeypatch.setattr(quantiles, "_select", watched)
    df = spark.range(size).select((F.rand(3) * 1e6).alias("v"), (F.col("id") % 7).alias("few"))
    df = df.cache()
    values = df.toPandas()
    found = exact_quantiles(df, ["v", "few"], [0.25, 0.5, 0.75])
    for column in ("v", "few"):
        wanted = np.quantile(values[column], [0.25, 0.5, 0.75]).tolist()
        assert found[column] == pytest.approx(wanted, rel=1e-12)
    assert max(seen) <= 550
    df.unpersist()


def test_brackets_that_always_miss_are_spread_over_ranges(spark, monkeypatch):
    """Every cut is refused, so all values stay in each bracket; no range passes the bound."""
    monkeypatch.setattr(quantiles, "MOST_VALUES", 1_000)
    monkeypatch.setattr(quantiles._Bracket, "holds", lambda self: False)
    largest = []
    original = quantiles.stage

    def watched(df, label):
        placed = original(df, label)
        largest.append(placed.groupBy("bracket", "range").count().agg(F.max("count")).first()[0])
        return placed

    monkeypatch.setattr(quantiles, "stage", watched)
    df = spark.range(30_000).select((F.rand(5) * 1e6).alias("v"), (F.col("id") % 11).alias("few")).cache()
    values = df.toPandas()
    found = exact_quantiles(df, ["v", "few"], [0.0, 0.25, 0.5, 1.0])
    for column in ("v", "few"):
        assert found[column] == pytest.approx(np.quantile(values[column], [0.0, 0.25, 0.5, 1.0]).tolist(), rel=1e-12)
    assert len(largest) == 1 and largest[0] <= 1_000
    df.unpersist()


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_running_sums_over_ranges_equal_one_sorted_pass(spark, ranges):
    rows = pd.DataFrame({"g": [k % 3 if k < 250 else 9 for k in range(300)], "v": range(300)}).sample(frac=1, random_state=1)
    rows["w"] = rows["v"] % 5 + 1
    found = quantiles.ranked(spark.createDataFrame(rows), ["g", "v"], "w", ranges).toPandas()
    wanted = rows.sort_values("v").assign(upto=lambda t: t.groupby("g")["w"].cumsum())
    assert sorted(map(tuple, found[["g", "v", "w", "upto"]].values.tolist())) == sorted(map(tuple, wanted[["g", "v", "w", "upto"]].values.tolist()))


def test_tier_table(spark):
    expected = {
        (r, f): (
            "Champions" if f >= 3 and r >= 3
            else "Loyal" if f >= 3
            else "New" if r >= 3 and f == 1
            else "At Risk" if r <= 2 and f >= 2
            else "Lost"
        )
        for r in range(1, 5)
        for f in range(1, 5)
    }
    df = spark.createDataFrame(list(expected), "r int, f int")
    found = df.select("r", "f", tier(F.col("r"), F.col("f"))).collect()
    assert {(r, f): name for r, f, name in found} == expected
    assert expected[3, 2] == "Lost"


def test_repeated_edges_leave_a_bin_empty(spark):
    df = spark.createDataFrame([(1,), (2,), (9,)], "v int")
    scored = df.select("v", bin_score(F.col("v"), [1, 1, 5], [4, 3, 2, 1]))
    assert dict(scored.collect()) == {1: 4, 2: 2, 9: 1}
