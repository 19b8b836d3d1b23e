"""Feature mart: the model-ready view of Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnrisk import schemas
from txnrisk.config import FAST_VELOCITY, FAST_VELOCITY_POINTS, FEATURES, Layout
from txnrisk.functions.features import FLAGS, calendar, flag_as_int, fraud_risk_score
from txnrisk.functions.labels import label
from txnrisk.sinks.maintenance import changed_days, replace_days
from txnrisk.sinks.progress import record_progress
from txnrisk.sources.tables import (
    DAY,
    LOG_ID,
    VERSION,
    Manifest,
    current_view,
    log_path,
    numbers,
    ranges,
    read_manifest,
)


def feature_mart(gold: DataFrame) -> DataFrame:
    """Gold with integer flags, calendar features and the risk score; feature nulls become 0."""
    added = {**calendar(), "fraud_risk_score": fraud_risk_score()}
    added.update({flag: flag_as_int(flag) for flag in FLAGS})
    return gold.withColumns(added).fillna(0, list(FEATURES))


def feature_matrix(mart: DataFrame, row_id: str = "transaction_id") -> DataFrame:
    """The ten features in model order, with the row id and the label."""
    return mart.select(row_id, *FEATURES, label().alias("label"))


def create_mart_view(spark: SparkSession, gold_view: str, name: str) -> DataFrame:
    """The mart as a SQL view over a registered Gold view, for SQL users."""
    flags = ",\n".join(f"coalesce(cast({flag} as int), 0) as {flag}" for flag in FLAGS)
    points = " + ".join(f"coalesce(cast({flag} as int), 0)" for flag in FLAGS)
    spark.sql(
        f"""
        create or replace temp view {name} as
        select * except (amount, amount_zscore, velocity_1h, {", ".join(FLAGS)}),
               coalesce(amount, 0) as amount,
               coalesce(amount_zscore, 0) as amount_zscore,
               coalesce(velocity_1h, 0) as velocity_1h,
               {flags},
               coalesce(hour(transaction_time), 0) as transaction_hour,
               coalesce(weekday(transaction_time), 0) as transaction_dow,
               {points} + case when velocity_1h >= {FAST_VELOCITY} then {FAST_VELOCITY_POINTS} else 0 end as fraud_risk_score
        from {gold_view}
        """
    )
    return spark.table(name)


def write_mart(gold: DataFrame, name: str) -> None:
    """The mart as a catalog table, written anew from the whole of Gold."""
    feature_mart(gold).write.mode("overwrite").saveAsTable(name)


def refresh_mart(spark: SparkSession, layout: Layout, name: str, record: StructType = schemas.RECORD) -> Manifest | None:
    """Bring the mart up to Gold's newest batch by replacing the days that have changed since the last time.

    The days' new versions are written aside; then the view ``name`` is replaced, in one step, by one that
    reads them. Whoever reads the view sees the mart before or after, never a part of it or none. The batch of
    Gold that it goes up to is recorded with it. None if Gold has no batch.
    """
    newest = max(numbers(spark, log_path(layout.gold), f"{LOG_ID}="), default=None)
    if newest is None:
        return None
    manifest = read_manifest(spark, layout.mart_index)
    covered = -1 if manifest is None else manifest.covered
    if newest > covered:
        touched = changed_days(spark, layout.gold, covered, newest)
        rows = feature_mart(current_view(spark, layout.gold, schemas.gold(record), days=ranges(touched)))
        manifest = replace_days(rows, layout.mart, layout.mart_index, manifest, newest, touched)
        record_progress(spark, layout.progress, "mart", manifest.number, newest)
    _point_view(spark, name, layout.mart, manifest, feature_mart(spark.createDataFrame([], schemas.gold(record))).schema)
    return manifest


def _point_view(spark: SparkSession, name: str, path: str, manifest: Manifest, schema: StructType) -> None:
    """Replace the view by one over the manifest's versions of days."""
    by_version: dict[int, list[int]] = {}
    for day, version in sorted(manifest.days.items()):
        by_version.setdefault(version, []).append(day)
    if by_version:
        valid = [f"({VERSION} = {v} and {DAY} in ({', '.join(map(str, days))}))" for v, days in by_version.items()]
        body = f"select {', '.join(schema.fieldNames())} from parquet.`{path}` where {' or '.join(valid)}"
    else:
        body = "select " + ", ".join(f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in schema) + " where false"
    spark.sql(f"create or replace view {name} as {body}")


def mart_is_current(spark: SparkSession, layout: Layout) -> bool:
    """Whether the mart goes up to Gold's newest batch; one that no job of this layout has written counts as such."""
    manifest = read_manifest(spark, layout.mart_index)
    newest = max(numbers(spark, log_path(layout.gold), f"{LOG_ID}="), default=-1)
    return manifest is None or manifest.covered >= newest


def has_rows(df: DataFrame, least: int) -> bool:
    """Training gate: are there at least ``least`` rows? Reads partitions only until there are."""
    return len(df.select(F.lit(1)).take(least)) >= least


def mean_label(mart: DataFrame) -> DataFrame:
    return mart.agg(F.avg(label()).alias("label_rate"))
