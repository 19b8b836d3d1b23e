"""Replay-safe appends: a batch owns one partition and replaces only that."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_batch(df: DataFrame, path: str, *partitions: str) -> None:
    """Append parquet files; writing the same batch again replaces its rows.

    Files of different batches may differ in columns; readers give the widest schema or merge.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(partitions or ("batch_id",)))
        .parquet(path)
    )


def quarantine_batch(df: DataFrame, path: str, partition: str = "batch_id") -> None:
    """Append rejected rows as JSON lines, with the same replay rule. Times keep their microseconds."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .partitionBy(partition)
        .json(path)
    )
