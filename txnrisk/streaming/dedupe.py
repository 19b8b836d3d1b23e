"""Streaming dedupe with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.config import WATERMARK, RiskConfig
from txnrisk.operators.validation import all_hold
from txnrisk.plans import silver


def deduplicated_stream(
    rows: DataFrame, key: str = "transaction_id", time: str = "transaction_time", delay: str = WATERMARK
) -> DataFrame:
    """Pass the first row of each key; repeats within the watermark delay are dropped.

    Rows later than the watermark are dropped as late (``numRowsDroppedByWatermark`` in the
    query's progress). Keys leave the state once the watermark has passed them, so the state
    holds about one delay's worth of keys.
    """
    return rows.where(f"{key} is not null").withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def watermarked(bronze: DataFrame, cfg: RiskConfig) -> DataFrame:
    """A stream of Bronze rows, typed, without late and repeated ones among those that keep Silver's rules.

    Rows that break a rule, as one without a time, pass unchanged, to be set apart later.
    """
    rows = silver.typed(bronze)
    holds = all_hold(silver.rules(cfg))
    valid = deduplicated_stream(rows.where(holds), delay=cfg.watermark or WATERMARK)
    return valid.unionByName(rows.where(~F.coalesce(holds, F.lit(False))))
