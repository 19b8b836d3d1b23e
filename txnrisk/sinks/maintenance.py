"""Retention and compaction jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnrisk.session import staged
from txnrisk.sinks.upsert import write_index
from txnrisk.sources.tables import (
    BUCKET,
    COVERED,
    DAY,
    DAY_SECONDS,
    KEY,
    LOG_ID,
    MANIFEST,
    VERSION,
    Manifest,
    current_view,
    day_of,
    delete_folder,
    key_index,
    key_runs_path,
    log_path,
    lookup,
    manifest_schema,
    numbers,
    path_exists,
    ranges,
    snapshot_index_path,
    snapshot_manifest,
    snapshot_path,
    write_manifest,
)


def retained(df: DataFrame, as_of: datetime | str, days: int, time: str = "transaction_time") -> DataFrame:
    """Rows no older than ``days`` before ``as_of``; a plain comparison that scans push down."""
    return df.where(F.col(time) >= oldest_kept(as_of, days))


def oldest_kept(as_of: datetime | str, days: int) -> Column:
    return F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))


def changed_days(spark: SparkSession, table: str, after: int, up_to: int) -> set[int]:
    """Event days in which log batches after one, up to another, have added, changed or left rows.

    From the key index alone: the days of the batches' own rows and of the earlier versions of their keys.
    """
    new = key_index(spark, table, after).where(F.col(LOG_ID) <= up_to)
    earlier = lookup(spark, table, new).where(F.col(LOG_ID) <= after)
    day = F.floor(F.col("event_sec") / DAY_SECONDS).alias(DAY)
    found = new.select(day).distinct().collect() + earlier.select(day).distinct().collect()
    return {r[0] for r in found if r[0] is not None}


def replace_days(rows: DataFrame, path: str, index: str, before: Manifest | None, covered: int, touched: set[int], first: int | None = None) -> Manifest:
    """Write ``rows``, all those of the touched days, as new versions of these days, and a manifest for them.

    Days before ``first`` leave the manifest. Other days keep the version they have.
    """
    spark = rows.sparkSession
    number = 0 if before is None else before.number + 1
    # Dealing by ranges reads the rows twice, first to find the ranges, so they are stored and not worked out twice.
    with staged(rows, "days") as stored:
        laid_out = (
            stored.withColumns({DAY: day_of(), VERSION: F.lit(number).cast("bigint")})
            .repartitionByRange(DAY, "customer_id", KEY)
            .sortWithinPartitions(DAY, "customer_id")
        )
        (
            laid_out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY, VERSION)
            .parquet(path)
        )
    kept = {} if before is None else {d: v for d, v in before.days.items() if d not in touched}
    written = {d: number for d in touched if path_exists(spark, f"{path}/{DAY}={d}/{VERSION}={number}")}
    days = {d: v for d, v in (kept | written).items() if first is None or d >= first}
    manifest = Manifest(number, covered, days)
    write_manifest(spark, index, manifest)
    return manifest


def compact(
    spark: SparkSession, table: str, schema: StructType, as_of: datetime | str | None = None, days: int | None = None
) -> int | None:
    """Fold the log into a snapshot of latest versions, optionally dropping expired rows.

    Only the event days are written anew in which the log has added, changed or left rows, and the one in
    which retention ends. The snapshot is laid out by day and sorted by customer within its files. It becomes
    visible with its manifest, after all files are written; readers then ignore the log up to
    that batch. The batches' key indexes are merged into one run.
    """
    newest = max(numbers(spark, log_path(table), f"{LOG_ID}="), default=None)
    if newest is None:
        return None
    before = snapshot_manifest(spark, table)
    covered = -1 if before is None else before.covered
    held = set() if before is None else set(before.days)
    touched = changed_days(spark, table, covered, newest) if newest > covered else set()
    first = None
    if as_of is not None:
        oldest = spark.range(1).select(oldest_kept(as_of, days).cast("long")).first()[0]
        first = oldest // DAY_SECONDS
        touched = {d for d in touched | (held & {first}) if d >= first}
    if newest == covered and not touched and (first is None or min(held, default=first) >= first):
        return newest
    rows = current_view(spark, table, schema, days=ranges(touched))
    if as_of is not None:
        rows = retained(rows, as_of, days)
    if newest > covered:
        run = key_index(spark, table, covered).where(F.col(LOG_ID) <= newest).drop(BUCKET)
        write_index(run, f"{key_runs_path(table)}/{COVERED}={newest}")
    replace_days(rows, snapshot_path(table), snapshot_index_path(table), before, newest, touched, first)
    return newest


def clean_days(spark: SparkSession, path: str, index: str, keep: int = 2) -> int:
    """Delete the versions of days that none of the last ``keep`` manifests names, and older manifests.

    Those kept serve readers that began before the last of them was written.
    """
    known = sorted(numbers(spark, index, f"{MANIFEST}="))[-keep:]
    if not known:
        return 0
    drop_partitions(spark, index, MANIFEST, known[0] - 1)
    rows = spark.read.schema(manifest_schema()).parquet(*[f"{index}/{MANIFEST}={n}" for n in known])
    named = {(r[DAY], r[VERSION]) for r in rows.where(F.col(DAY).isNotNull()).select(DAY, VERSION).distinct().collect()}
    gone = 0
    for day in numbers(spark, path, f"{DAY}="):
        versions = numbers(spark, f"{path}/{DAY}={day}", f"{VERSION}=")
        for version in versions:
            # A version above the last manifest's is being written.
            if (day, version) not in named and version <= known[-1]:
                delete_folder(spark, f"{path}/{DAY}={day}/{VERSION}={version}")
                gone += 1
        if not numbers(spark, f"{path}/{DAY}={day}", f"{VERSION}="):
            delete_folder(spark, f"{path}/{DAY}={day}")
    return gone


def drop_partitions(spark: SparkSession, path: str, column: str, up_to: int) -> list[int]:
    """Delete the partition folders ``column=n`` with n <= ``up_to``; returns the numbers gone.

    For log partitions a snapshot covers and every downstream stream has read, and for Bronze
    batches past their retention (see :func:`expired_up_to`).
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(folder):
        name, _, number = status.getPath().getName().partition("=")
        if name == column and number.isdigit() and int(number) <= up_to:
            fs.delete(status.getPath(), True)
            gone.append(int(number))
    return sorted(gone)


def expired_up_to(
    df: DataFrame, as_of: datetime | str, days: int, time: str = "ingested_at", batch: str = "batch_id"
) -> int | None:
    """Newest batch such that it and all before it hold only rows past retention."""
    oldest = oldest_kept(as_of, days)
    per_batch = df.groupBy(batch).agg(F.max(time).alias("newest"))
    first_kept, last = per_batch.agg(F.min(F.when(F.col("newest") >= oldest, F.col(batch))), F.max(batch)).first()
    return last if first_kept is None else (first_kept - 1 if first_kept > 0 else None)
