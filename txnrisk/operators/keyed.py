"""One-row-per-key operators: first arrival, latest version, batch merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    # The rank filter lets Spark keep one row per key on the map side already
    # (WindowGroupLimit), so many copies of one key shrink before they are shuffled.
    w = Window.partitionBy(key).orderBy(*order)
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(w))
        .where("_rank = 1")
        .drop("_rank")
    )


def first_per_key(df: DataFrame, key: str, arrival: tuple[str, ...]) -> DataFrame:
    """Keep the earliest arrival of each key; rows without a key are left out."""
    return _one_per_key(df, key, [F.col(c).asc() for c in arrival])


def latest_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """Keep the newest version of each key."""
    return _one_per_key(df, key, [F.col(version).desc()])


def upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Update matched rows whole and insert the rest; ``updates`` must be unique on the key."""
    kept = target.join(updates.select(key), key, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)
