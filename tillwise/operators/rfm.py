"""Recency / frequency / monetary scores and the tier they give."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.operators.quantiles import exact_quantiles

QUARTILES = [0.25, 0.5, 0.75]

# Upper ends of the order-count bins for frequency scores 1, 2, 3 (4 above).
FREQUENCY_BINS = [1, 3, 7]

# Tier names.
CHAMPIONS, LOYAL, NEW, AT_RISK, LOST = "Champions", "Loyal", "New", "At Risk", "Lost"


@dataclass(frozen=True)
class QuartileEdges:
    recency_days: Sequence[float]
    monetary: Sequence[float]


def quartile_edges(features: DataFrame) -> QuartileEdges:
    """Quartile edges over all customers; reads ``features`` twice (pass a stored table)."""
    edges = exact_quantiles(features, ["recency_days", "monetary"], QUARTILES)
    return QuartileEdges(**edges)


def bin_score(value: Column, upper_ends: Sequence[float], labels: Sequence[int]) -> Column:
    """Label of the first right-closed bin that holds the value; the last bin is open.

    Repeated edges simply leave a bin empty.
    """
    score = F.lit(labels[-1])
    for end, label in reversed(list(zip(upper_ends, labels))):
        score = F.when(value <= F.lit(end), F.lit(label)).otherwise(score)
    return score


def tier(recency_score: Column, frequency_score: Column) -> Column:
    """Frequent buyers split by recency; the others are new, lapsed repeaters or lost.

    Recent customers with a middling order count fall to the last tier.
    """
    recent = recency_score >= 3
    frequent = frequency_score >= 3
    single = frequency_score == 1
    return (
        F.when(frequent, F.when(recent, CHAMPIONS).otherwise(LOYAL))
        .when(recent, F.when(single, NEW).otherwise(LOST))
        .otherwise(F.when(single, LOST).otherwise(AT_RISK))
    )


def add_rfm(features: DataFrame, edges: QuartileEdges) -> DataFrame:
    return features.withColumns(
        {
            "r_score": bin_score(F.col("recency_days"), edges.recency_days, [4, 3, 2, 1]),
            "m_score": bin_score(F.col("monetary"), edges.monetary, [1, 2, 3, 4]),
            "f_score": bin_score(F.col("frequency"), FREQUENCY_BINS, [1, 2, 3, 4]),
        }
    ).withColumn("rfm_tier", tier(F.col("r_score"), F.col("f_score")))
