"""Exact quantiles of several columns without bringing all values to one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.sources.staging import stage

SKETCH_ACCURACY = 10_000

#: Half width of a bracket as a share of the rows it is cut from: far wider than the
#: sketch's own error.
BRACKET_WIDTH = 20 / SKETCH_ACCURACY

#: Distinct values that brackets are cut down to, and that one range of a bracket holds.
MOST_VALUES = 20_000

#: Cuts of a bracket that does not become narrower before its values are taken as they are.
MOST_MISSES = 3


@dataclass
class _Bracket:
    """A closed interval of values meant to hold the ranks around ``position``."""

    column: str
    position: float
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0
    values: int = 0
    width: float = BRACKET_WIDTH
    misses: int = 0

    def row(self) -> Column:
        value = F.col(self.column).cast("double")
        return F.when((value >= F.lit(self.low)) & (value <= F.lit(self.high)), value)

    def holds(self) -> bool:
        """Whether both ranks around the position lie inside."""
        first, last = math.floor(self.position), math.ceil(self.position)
        return self.below <= first and last < self.below + self.inside


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """Linearly interpolated quantiles, ``{column: [value per probability]}``.

    A mergeable sketch brackets every wanted rank, and a count says what lies below and
    inside. A bracket that misses its rank is widened; one with more than ``MOST_VALUES``
    distinct values is cut again by a sketch of what is inside. Each round narrows a bracket
    to about ``2 * BRACKET_WIDTH`` of its rows, so the number of rounds grows with the
    logarithm of the table. Then the values inside, with their counts, are put in order, one
    window partition of bounded size for each quantile. A bracket that could not be cut is
    put in order by ranges (``ranked``), as many as its values need.

    ``df`` is read twice a round: pass a stored table. Only a few numbers reach the driver.
    """
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    empty = [c for c in columns if counts[c] == 0]
    if empty:
        raise ValueError(f"no values in {empty}")
    brackets = {
        (c, p): _Bracket(c, (counts[c] - 1) * p, inside=counts[c], values=counts[c])
        for c in columns
        for p in probabilities
    }
    wide = list(brackets)
    while wide := [key for key in wide if brackets[key].values > MOST_VALUES and brackets[key].misses < MOST_MISSES]:
        for key, cut in zip(wide, _cut(df, [brackets[key] for key in wide])):
            brackets[key] = cut
    found = _select(df, brackets)
    return {c: [found[c, p] for p in probabilities] for c in columns}


def _cut(df: DataFrame, brackets: list[_Bracket]) -> list[_Bracket]:
    """Narrower brackets; one that turns out to miss its rank stays and is cut wider next."""
    measures = []
    for i, b in enumerate(brackets):
        share = (b.position - b.below) / max(b.inside - 1, 1)
        ends = [max(share - b.width, 0.0), min(share + b.width, 1.0)]
        measures.append(F.percentile_approx(b.row(), ends, SKETCH_ACCURACY).alias(f"ends_{i}"))
    ends = df.agg(*measures).first()
    cuts = [
        _Bracket(b.column, b.position, *map(float, ends[f"ends_{i}"]))
        for i, b in enumerate(brackets)
    ]
    measures = []
    for i, cut in enumerate(cuts):
        value = F.col(cut.column).cast("double")
        measures += [
            F.count_if(value < F.lit(cut.low)).alias(f"below_{i}"),
            F.count(cut.row()).alias(f"inside_{i}"),
            F.approx_count_distinct(cut.row()).alias(f"values_{i}"),
        ]
    row = df.agg(*measures).first()
    out = []
    for i, (b, cut) in enumerate(zip(brackets, cuts)):
        cut.below, cut.inside = row[f"below_{i}"], row[f"inside_{i}"]
        cut.values = 1 if cut.low == cut.high else row[f"values_{i}"]
        if not cut.holds():
            b.width *= 10
            b.misses += 1
            out.append(b)
        else:
            # Nothing left to cut if no row fell out: few values, each with many rows.
            cut.misses = MOST_MISSES if cut.inside == b.inside else 0
            out.append(cut)
    return out


def _select(df: DataFrame, brackets: dict) -> dict:
    """The values at the wanted ranks, from the counted values of each bracket."""
    keys = list(brackets)
    entries = [
        F.struct(F.lit(i).alias("bracket"), brackets[key].row().alias("value"))
        for i, key in enumerate(keys)
    ]
    counted = (
        df.select(F.explode(F.array(*entries)).alias("entry"))
        .select("entry.bracket", "entry.value")
        .filter(F.col("value").isNotNull())
        .groupBy("bracket", "value")
        .count()
    )
    if all(b.values <= MOST_VALUES for b in brackets.values()):
        running = Window.partitionBy("bracket").orderBy("value")
        ordered = counted.withColumn("upto", F.sum("count").over(running))
    else:  # ranges of half the bound, as they are cut by a sample
        ranges = 1 + 2 * sum(b.values for b in brackets.values()) // MOST_VALUES
        ordered = ranked(counted, ["bracket", "value"], "count", ranges)
    ranks = {i: b.position - b.below for i, b in enumerate(brackets.values())}

    def value_at(rank_of) -> Column:
        """Smallest value whose running count passes the wanted rank of its bracket."""
        cases = [
            F.when((F.col("bracket") == i) & (F.col("upto") > rank_of(rank)), F.col("value"))
            for i, rank in ranks.items()
        ]
        return F.min(F.coalesce(*cases))

    rows = (
        ordered.groupBy("bracket")
        .agg(value_at(math.floor).alias("lower"), value_at(math.ceil).alias("upper"))
        .collect()
    )
    found = {}
    for row in rows:
        part = brackets[keys[row["bracket"]]].position % 1
        found[keys[row["bracket"]]] = row["lower"] + (row["upper"] - row["lower"]) * part
    return found


def ranked(rows: DataFrame, keys: list[str], weight: str, ranges: int) -> DataFrame:
    """``rows`` with ``upto``: the running sum of ``weight`` in the order of the last key, in each group of the others.

    Rows go to ``ranges`` ranges of their keys (all of them unique). A range sums up its own rows,
    and what the ranges before it hold of the group is added: one short row a range and group. So
    a group of any size is spread over the ranges, and no task orders more than one range.
    """
    group, order = keys[:-1], keys[-1]
    placed = stage(
        rows.repartitionByRange(ranges, *keys).withColumn("range", F.spark_partition_id()), "ranges"
    )
    before = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*group, "range")
        .agg(F.sum(weight).alias("inside"))
        .withColumn("offset", F.coalesce(F.sum("inside").over(before), F.lit(0)))
        .drop("inside")
    )
    running = Window.partitionBy(*group, "range").orderBy(order)
    return (
        placed.withColumn("own", F.sum(weight).over(running))
        .join(offsets, [*group, "range"])
        .withColumn("upto", F.col("own") + F.col("offset"))
        .drop("own", "offset", "range")
    )
