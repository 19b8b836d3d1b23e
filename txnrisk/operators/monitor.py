"""Batch counters and layer latency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.config import LATENCY_TARGET_SECONDS


def batch_counters(accepted: Column) -> list[Column]:
    """Rows in, accepted, rejected, and the fraud share of the accepted rows.

    Usable in ``agg`` and, in the same pass as a write, in ``observe``.
    """
    fraud = F.when(accepted, F.col("is_fraud").cast("int"))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(accepted).alias("n_valid"),
        F.count_if(~accepted).alias("n_quarantined"),
        F.avg(fraud).alias("fraud_rate"),
    ]


def layer_latency(df: DataFrame, targets: dict[str, int] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Seconds from arrival in the queue to each layer's stamp, against the layer's target.

    One scan; three groups whose partial results (counts and quantile sketches) have bounded size.
    """
    targets = targets or LATENCY_TARGET_SECONDS
    stamps = {"bronze": "ingested_at", "silver": "silver_processed_at", "gold": "gold_processed_at"}
    arrival = F.unix_micros("kafka_timestamp")
    per_layer = F.array(
        *[
            F.struct(
                F.lit(layer).alias("layer"),
                F.lit(targets[layer]).cast("double").alias("target_seconds"),
                ((F.unix_micros(stamp) - arrival) / 1e6).alias("seconds"),
            )
            for layer, stamp in stamps.items()
        ]
    )
    late = F.col("seconds") >= F.col("target_seconds")
    return (
        df.select(F.inline(per_layer))
        .groupBy("layer", "target_seconds")
        .agg(
            F.count("seconds").alias("n_rows"),
            F.percentile_approx("seconds", 0.5, accuracy).alias("p50_seconds"),
            F.percentile_approx("seconds", 0.95, accuracy).alias("p95_seconds"),
            F.max("seconds").alias("max_seconds"),
            F.count_if(late).alias("n_late"),
        )
        .withColumn("breached", F.col("p95_seconds") >= F.col("target_seconds"))
    )
