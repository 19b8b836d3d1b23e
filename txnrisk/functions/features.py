"""Risk flags, calendar features and the rule-based risk score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnrisk.config import FAST_VELOCITY, FAST_VELOCITY_POINTS, RiskConfig

FLAGS = (
    "is_high_risk_hour",
    "is_high_risk_country",
    "is_high_risk_category",
    "card_not_present",
)


def event_seconds(time: str = "transaction_time") -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.col(time).cast("long")


def zscore(value: Column, mean: Column, sd: Column) -> Column:
    """Distance from the mean in standard deviations; 0 when there is no spread to measure."""
    return F.when(sd > 0, (value - mean) / sd).otherwise(F.lit(0.0))


def risk_flags(cfg: RiskConfig) -> dict[str, Column]:
    return {
        "is_high_risk_hour": F.hour("transaction_time").isin(*cfg.risk_hours),
        "is_high_risk_country": F.col("location_country") != F.lit(cfg.home_country),
        "is_high_risk_category": F.col("merchant_category").isin(*cfg.risk_categories),
        "card_not_present": ~F.col("card_present"),
    }


def flag_as_int(name: str) -> Column:
    """1, 0, and 0 for an unknown flag."""
    return F.coalesce(F.col(name).cast("int"), F.lit(0))


def calendar(time: str = "transaction_time") -> dict[str, Column]:
    """Hour of day and day of week; Monday is 0."""
    return {"transaction_hour": F.hour(time), "transaction_dow": F.weekday(time)}


def fraud_risk_score() -> Column:
    """One point per raised flag plus extra points for a fast run of transactions: 0 to 6."""
    points = F.when(F.col("velocity_1h") >= FAST_VELOCITY, FAST_VELOCITY_POINTS).otherwise(0)
    for flag in FLAGS:
        points = points + flag_as_int(flag)
    return points
