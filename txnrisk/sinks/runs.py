"""Run parameters and metrics, and the versioned model table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from txnrisk.schemas import MODEL, RUN_METRICS
from txnrisk.sinks.append import append_batch
from txnrisk.sources.tables import create_file, path_exists

VERSION = "model_version"
# Readers pass over folders that start with an underscore.
CLAIMS = "_claimed_versions"


def record_run(spark: SparkSession, path: str, run_id: str, kind: str, values: dict) -> None:
    """One row per named value; ``kind`` is "param" or "metric". A run recorded again replaces its rows."""
    now = datetime.now(timezone.utc)
    rows = [(run_id, kind, name, None if v is None else str(v), now) for name, v in values.items()]
    append_batch(spark.createDataFrame(rows, RUN_METRICS).coalesce(1), path, "run_id", "kind")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_METRICS).parquet(path).select(*RUN_METRICS.fieldNames())


def latest_version(spark: SparkSession, path: str) -> int | None:
    if not path_exists(spark, path):
        return None
    return _models(spark, path).agg(F.max(VERSION)).first()[0]


def _models(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType(MODEL.fields + [StructField(VERSION, LongType())])
    return spark.read.schema(schema).parquet(path)


def save_model(nodes: DataFrame, path: str) -> int:
    """Register a node table under the next version number that nobody else has claimed."""
    version = (latest_version(nodes.sparkSession, path) or 0) + 1
    while not create_file(nodes.sparkSession, f"{path}/{CLAIMS}/{version}"):
        version += 1
    append_batch(nodes.repartition(1).withColumn(VERSION, F.lit(version).cast("bigint")), path, VERSION)
    return version


def load_model(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Nodes of one version, by default the latest."""
    wanted = latest_version(spark, path) if version is None else version
    if wanted is None:
        raise FileNotFoundError(f"no model has been saved in {path}")
    return _models(spark, path).where(F.col(VERSION) == wanted).drop(VERSION)
