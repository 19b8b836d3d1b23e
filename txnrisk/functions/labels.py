"""Label, prediction and tier expressions over an anomaly score (lower = more anomalous)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(name: str = "is_fraud") -> Column:
    return F.col(name).cast("int")


def anomaly_as_label(decision: Column) -> Column:
    """-1 (anomaly) becomes 1, 1 (normal) becomes 0."""
    return F.when(decision == -1, F.lit(1)).otherwise(F.lit(0))


def decision(score: Column, cut: float) -> Column:
    """-1 below the cut, else 1."""
    return F.when(score < F.lit(cut), F.lit(-1)).otherwise(F.lit(1))


def inverted(score: Column) -> Column:
    """Higher = riskier, as ranking metrics expect."""
    return -score


def predicted_fraud(score: Column, cut: float) -> Column:
    return score < F.lit(cut)


def risk_tier(score: Column, high: float, medium: float) -> Column:
    """Tiers closed on the right: score = high is "high", score = medium is "medium"."""
    return (
        F.when(score <= F.lit(high), F.lit("high"))
        .when(score <= F.lit(medium), F.lit("medium"))
        .otherwise(F.lit("low"))
    )
