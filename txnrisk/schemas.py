"""Schemas of the wire format, the layers, the model table and the metrics table."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """``"name type, ..."`` as a nullable struct, without needing a session at import."""
    pairs = (item.split() for item in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RECORD = _struct(
    "transaction_id string, customer_id string, merchant_id string, merchant_category string, "
    "amount double, currency string, transaction_time string, card_present boolean, "
    "location_country string, is_fraud boolean"
)

QUEUE = _struct(
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)

_INGEST = "kafka_timestamp timestamp, partition int, offset bigint, ingested_at timestamp, batch_id bigint"


def bronze(record: T.StructType = RECORD) -> T.StructType:
    """Bronze layout for a record schema; a widened record widens Bronze with it."""
    return T.StructType(record.fields + _struct(_INGEST).fields)


def silver(record: T.StructType = RECORD) -> T.StructType:
    typed = [
        T.StructField(f.name, T.TimestampType()) if f.name == "transaction_time" else f
        for f in bronze(record).fields
    ]
    return T.StructType(typed + _struct("silver_processed_at timestamp").fields)


def gold(record: T.StructType = RECORD) -> T.StructType:
    added = _struct(
        "velocity_1h bigint, amount_zscore double, is_high_risk_hour boolean, "
        "is_high_risk_country boolean, is_high_risk_category boolean, card_not_present boolean, "
        "gold_processed_at timestamp"
    )
    return T.StructType(silver(record).fields + added.fields)


MODEL = _struct(
    "tree_id int, node_id int, feature string, split double, left int, right int, "
    "size bigint, depth int, sample_size bigint"
)

RUN_METRICS = _struct("run_id string, kind string, name string, value string, ts timestamp")
