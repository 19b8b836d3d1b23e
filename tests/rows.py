"""Hand-made rows for tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from txnrisk import schemas

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def record(**over) -> dict:
    base = {
        "transaction_id": "T1",
        "customer_id": "C1",
        "merchant_id": "M1",
        "merchant_category": "grocery",
        "amount": 10.0,
        "currency": "AUD",
        "transaction_time": START.isoformat(),
        "card_present": True,
        "location_country": "AU",
        "is_fraud": False,
    }
    return {**base, **over}


def bronze(spark, *records: dict):
    """Bronze rows; ``offset`` and ``partition`` may be given, else rows are numbered."""
    rows = []
    for i, r in enumerate(records):
        r = {"partition": 0, "offset": i, "kafka_timestamp": START, "ingested_at": START, "batch_id": 0, **r}
        rows.append(tuple(r[f] for f in schemas.bronze().fieldNames()))
    return spark.createDataFrame(rows, schemas.bronze())


def silver(spark, *records: dict):
    """Silver rows with ``sec`` (seconds after START) as the event time."""
    rows = []
    for i, r in enumerate(records):
        r = {
            "transaction_id": f"T{i}", "partition": 0, "offset": i, "kafka_timestamp": START, "ingested_at": START,
            "batch_id": 0, "silver_processed_at": START, **r,
        }
        full = {**record(), **r, "transaction_time": at(r.get("sec", 0))}
        rows.append(tuple(full[f] for f in schemas.silver().fieldNames()))
    return spark.createDataFrame(rows, schemas.silver())


def envelope(spark, values: list, first_offset: int = 0):
    """Queue messages; dicts are sent as JSON, strings as they are."""
    rows = [
        (b"k", (v if isinstance(v, str) else json.dumps(v)).encode(), "transactions", 0, first_offset + i, START, 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, schemas.QUEUE)


def node_lines(df) -> list[str]:
    """The final physical plan's lines (run ``df`` first for the adaptive one)."""
    return df._jdf.queryExecution().executedPlan().toString().splitlines()
