"""Retention as a job: what is past its age and read by every consumer goes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from txnrisk.config import RETENTION_DAYS, Layout
from txnrisk.sinks.maintenance import clean_days, drop_partitions, expired_up_to, oldest_kept
from txnrisk.sinks.progress import committed_up_to
from txnrisk.sources.tables import (
    COVERED,
    INDEX,
    LOG_ID,
    MANIFEST,
    delete_folder,
    key_runs_path,
    keys_path,
    log_path,
    manifest_schema,
    numbers,
    path_exists,
    snapshot_index_path,
    snapshot_path,
)


def _expire_batches(spark, path: str, kind: str, time: str, partition: str, as_of, days: int, read_up_to: int | None) -> int:
    """Delete the batches past their age, no further than ``read_up_to``; returns their number."""
    if not path_exists(spark, path):
        return 0
    rows = spark.read.schema(f"{time} timestamp, {partition} bigint").format(kind).load(path)
    last = expired_up_to(rows, as_of, days, time, partition)
    bounds = [n for n in (last, read_up_to) if n is not None]
    return len(drop_partitions(spark, path, partition, min(bounds))) if last is not None else 0


def _clean_layer(spark, table: str, read_up_to: int | None, oldest_second: int, keep: int) -> dict[str, int]:
    """Delete what the last ``keep`` manifests don't need: days' versions, and log and key batches that a
    snapshot covers and every consumer has read; and runs of keys of which all are past retention.
    """
    gone = {"days": clean_days(spark, snapshot_path(table), snapshot_index_path(table), keep), "log": 0, "keys": 0}
    known = sorted(numbers(spark, snapshot_index_path(table), f"{MANIFEST}="))[-keep:]
    if len(known) == keep and read_up_to is not None:
        rows = spark.read.schema(manifest_schema()).parquet(f"{snapshot_index_path(table)}/{MANIFEST}={known[0]}")
        up_to = min(rows.agg(F.max(COVERED)).first()[0], read_up_to)
        gone["log"] = len(drop_partitions(spark, log_path(table), LOG_ID, up_to))
        gone["keys"] = len(drop_partitions(spark, keys_path(table), LOG_ID, up_to))
    if path_exists(spark, key_runs_path(table)):
        runs = spark.read.schema(f"{INDEX}, {COVERED} bigint").parquet(key_runs_path(table))
        ages = runs.groupBy(COVERED).agg(F.max("event_sec").alias("newest")).where(F.col("newest") < oldest_second)
        for row in ages.collect():
            delete_folder(spark, f"{key_runs_path(table)}/{COVERED}={row[COVERED]}")
    return gone


def expire(spark: SparkSession, layout: Layout, as_of: datetime | str, days: dict[str, int] | None = None, keep: int = 2) -> dict:
    """Delete Bronze, quarantine, log, key and snapshot folders that nobody needs; returns how many of each.

    Bronze goes once it is past its days and Silver's stream has committed it; Silver's log once a snapshot
    covers it and Gold's stream has committed it; Gold's log once a snapshot covers it and the mart, if there
    is one, has taken it over. A consumer without a known position holds everything. Rows of Silver and Gold
    past their days go by ``compact``. Folders are deleted; no row passes through the driver.
    """
    days = days or RETENTION_DAYS
    by_silver = committed_up_to(spark, layout.progress, "silver", layout.checkpoint("silver"))
    by_gold = committed_up_to(spark, layout.progress, "gold", layout.checkpoint("gold"))
    by_mart = committed_up_to(spark, layout.progress, "mart") if path_exists(spark, layout.mart_index) else 1 << 62
    gone = {
        "bronze": 0 if by_silver is None else _expire_batches(
            spark, layout.bronze, "parquet", "ingested_at", "batch_id", as_of, days["bronze"], by_silver
        ),
        "bronze_quarantine": _expire_batches(
            spark, layout.bronze_quarantine, "json", "ingested_at", "batch_id", as_of, days["bronze"], None
        ),
        "silver_quarantine": _expire_batches(
            spark, layout.silver_quarantine, "json", "silver_processed_at", LOG_ID, as_of, days["silver"], None
        ),
    }
    for layer, table, read in (("silver", layout.silver, by_gold), ("gold", layout.gold, by_mart)):
        oldest = spark.range(1).select(oldest_kept(as_of, days[layer]).cast("long")).first()[0]
        for what, n in _clean_layer(spark, table, read, oldest, keep).items():
            gone[f"{layer}_{what}"] = n
    return gone
