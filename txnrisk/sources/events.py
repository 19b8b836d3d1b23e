"""Transaction records derived from the ``events`` table, the fixture of tests and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.schemas import RECORD

# The merchant categories by event_id modulo 8.
CATEGORIES = (
    "grocery", "electronics", "travel", "restaurant",
    "fuel", "pharmacy", "clothing", "entertainment",
)

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
QUEUE_PARTITIONS = 4


def _padded(prefix: str, number, width: int):
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per event, with null ids, repeated ids, bad currencies and unknown countries."""
    e = F.col("event_id")
    repeats = (e % 53 == 0) & (e % 211 != 1) & (e > 0)
    category = F.element_at(F.array(*map(F.lit, CATEGORIES)), (e % 8 + 1).cast("int"))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.when(e % 211 != 0, _padded("T", e - repeats.cast("int"), 8)).alias("transaction_id"),
        _padded("C", F.col("user_id"), 5).alias("customer_id"),
        _padded("M", e % 200, 4).alias("merchant_id"),
        category.alias("merchant_category"),
        F.col("value").alias("amount"),
        F.when(e % 101 == 0, None).when(e % 97 == 0, "USD").otherwise("AUD").alias("currency"),
        F.col("ts").cast("timestamp").alias("transaction_time"),
        (e % 5 != 0).alias("card_present"),
        F.when(e % 89 == 0, None).when(e % 11 == 0, "US").when(e % 13 == 0, "GB").otherwise("AU")
        .alias("location_country"),
        (e % 50 == 7).alias("is_fraud"),
        (F.col("user_id") % QUEUE_PARTITIONS).cast("int").alias("partition"),
        e.alias("offset"),
    )


def iso_time(name: str):
    return F.concat(F.date_format(name, ISO), F.lit("+00:00"))


def as_text_time(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_time", iso_time("transaction_time"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as queue messages: customer as key, JSON as value."""
    r = records(spark, sf_dir)
    arrival = F.col("transaction_time")
    body = F.struct(*[iso_time(f) .alias(f) if f == "transaction_time" else F.col(f) for f in RECORD.fieldNames()])
    return r.select(
        F.col("customer_id").cast("binary").alias("key"),
        F.to_json(body).cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        "partition",
        "offset",
        arrival.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as Bronze holds them (text time, arrival stamp), without the JSON round trip."""
    r = records(spark, sf_dir).withColumn("kafka_timestamp", F.col("transaction_time"))
    return as_text_time(r)


def rough_bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`bronze_rows` with amounts off the range, missing names and unreadable times: all rules are broken."""
    i = F.col("offset")
    amount = F.when(i % 103 == 0, 0.0).when(i % 107 == 0, 50_000.01).when(i % 109 == 0, None).otherwise(F.col("amount"))
    time = F.when(i % 131 == 0, "not a time").when(i % 137 == 0, None).otherwise(F.col("transaction_time"))
    return bronze_rows(spark, sf_dir).withColumns(
        {
            "amount": amount,
            "customer_id": F.when(i % 113 != 0, F.col("customer_id")),
            "merchant_id": F.when(i % 127 != 0, F.col("merchant_id")),
            "transaction_time": time,
        }
    )


def rough_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`envelopes` in which some messages are not JSON."""
    bad = F.concat(F.lit("{bad "), F.col("offset").cast("string")).cast("binary")
    return envelopes(spark, sf_dir).withColumn("value", F.when(F.col("offset") % 139 == 0, bad).otherwise(F.col("value")))
