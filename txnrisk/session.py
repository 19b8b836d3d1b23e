"""Session helpers: required settings, shared scratch space and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_local_dirs: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that results or table layouts depend on; everything else is the cluster's.

    Hour and weekday features are defined in UTC. Microsecond timestamps, unlike the default
    encoding, carry min/max statistics, which let scans skip row groups by time.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as the session names it in spark.checkpoint.dir.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="txnrisk-")
    return _local_dirs[app]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame once to shared storage and read it back with its lineage cut.

    Unlike a cache it survives executor loss, and unlike a checkpoint it stays columnar, so
    later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like :func:`stage`, for the length of a block: the folder is deleted at its end."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after counting; a larger side is left to a shuffle join."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
