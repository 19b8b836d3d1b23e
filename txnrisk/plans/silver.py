"""Silver: typed, validated, one row per transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.config import RiskConfig
from txnrisk.operators import validation
from txnrisk.operators.keyed import first_per_key

ARRIVAL = ("partition", "offset")


def typed(bronze: DataFrame) -> DataFrame:
    """Event time as a timestamp; text that is none becomes null and fails its rule."""
    return bronze.withColumn("transaction_time", F.try_to_timestamp("transaction_time"))


def rules(cfg: RiskConfig) -> dict[str, Column]:
    return {
        "amount": F.col("amount").between(cfg.min_amount, cfg.max_amount),
        "currency": F.col("currency").isin(*cfg.currencies),
        "transaction_id": F.col("transaction_id").isNotNull(),
        "customer_id": F.col("customer_id").isNotNull(),
        "merchant_id": F.col("merchant_id").isNotNull(),
        "transaction_time": F.col("transaction_time").isNotNull(),
    }


def split_typed(rows: DataFrame, cfg: RiskConfig) -> tuple[DataFrame, DataFrame]:
    return validation.split(rows, rules(cfg))


def split(bronze: DataFrame, cfg: RiskConfig) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid with the names of the broken rules)"""
    return split_typed(typed(bronze), cfg)


def counters(cfg: RiskConfig) -> list[Column]:
    holds = F.coalesce(validation.all_hold(rules(cfg)), F.lit(False))
    return [F.count(F.lit(1)).alias("n_rows"), F.count_if(~holds).alias("n_invalid")]


def deduplicated(valid: DataFrame) -> DataFrame:
    """First arrival per transaction by queue position."""
    return first_per_key(valid, "transaction_id", ARRIVAL)


def stamped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("silver_processed_at", F.current_timestamp())


def build(bronze: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Valid, deduplicated rows of one batch (or of all of Bronze)."""
    valid, _ = split(bronze, cfg)
    return deduplicated(valid)
