"""Bronze: decode queue messages and set apart those without the required fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnrisk.operators.monitor import batch_counters
from txnrisk.operators.validation import all_hold
from txnrisk.schemas import RECORD
from txnrisk.sources.queue import decode

REQUIRED = ("transaction_id", "customer_id", "amount")


def required_present() -> Column:
    """Never unknown, so its negation is its complement."""
    return all_hold({name: F.col(name).isNotNull() for name in REQUIRED})


def parsed(envelope: DataFrame, batch_id: int, record: StructType = RECORD) -> DataFrame:
    return decode(envelope, record).withColumns(
        {"ingested_at": F.current_timestamp(), "batch_id": F.lit(batch_id).cast("bigint")}
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(required_present()).drop("raw_value")


def quarantined(rows: DataFrame) -> DataFrame:
    return rows.where(~required_present())


def batch_metrics(rows: DataFrame) -> DataFrame:
    return rows.agg(*batch_counters(required_present()))
