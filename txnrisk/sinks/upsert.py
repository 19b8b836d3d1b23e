"""Upsert sinks: the change log of a layer, or MERGE where the catalog supports it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from txnrisk.sources.tables import (
    BUCKET,
    DAY,
    KEY,
    LOG_ID,
    day_of,
    key_bucket,
    keys_path,
    log_path,
    make_folder,
    rename,
)


def create_layer(spark: SparkSession, table: str) -> None:
    """Make the log's folder, so that a downstream stream can start before the first batch."""
    make_folder(spark, log_path(table))


def upsert_batch(updates: DataFrame, table: str, batch_id: int) -> None:
    """Record updates (unique on the key) as the newest versions.

    The cost is that of the batch alone: the table is neither read nor rewritten. The first batch
    creates the table. The rows are written aside, their keys are indexed, and a rename makes the batch
    visible as a whole; written again, it replaces what it wrote before.
    """
    spark, name = updates.sparkSession, f"{LOG_ID}={batch_id}"
    pending = f"{log_path(table)}/_pending/{name}"
    # Few files per day, and many tasks for a day with many rows.
    updates.withColumn(DAY, day_of()).hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(pending)
    schema = StructType([*updates.schema.fields, StructField(DAY, LongType())])
    index_keys(spark.read.schema(schema).parquet(pending), f"{keys_path(table)}/{name}")
    rename(spark, pending, f"{log_path(table)}/{name}")


def index_keys(rows: DataFrame, path: str) -> None:
    """Write keys, customers and event seconds by bucket of the key, with Bloom filters on the key."""
    second = F.col("transaction_time").cast("long").alias("event_sec")
    write_index(rows.select(KEY, "customer_id", second), path)


def write_index(rows: DataFrame, path: str) -> None:
    dealt = rows.withColumn(BUCKET, key_bucket()).repartition(BUCKET).sortWithinPartitions(BUCKET, KEY)
    (
        dealt.write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{KEY}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")  # sized by the keys there are
        .partitionBy(BUCKET)
        .parquet(path)
    )


def merge_batch(updates: DataFrame, table: str, key: str = KEY) -> None:
    """The same upsert on a catalog table with row-level operations; created if missing."""
    spark = updates.sparkSession
    if not spark.catalog.tableExists(table):
        updates.writeTo(table).create()
        return
    on = F.expr(f"{table}.{key} = updates.{key}")
    updates.alias("updates").mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll().merge()
