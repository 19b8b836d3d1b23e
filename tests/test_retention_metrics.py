"""Retention by consumer progress, the watermarked Silver stream, metrics per micro-batch, the mart by days."""

import pytest
from pyspark.sql import functions as F
from rows import at, bronze, envelope, record, silver

from txnrisk import schemas
from txnrisk.config import Layout, RiskConfig
from txnrisk.plans import mart
from txnrisk.sinks.append import append_batch
from txnrisk.sinks.maintenance import compact
from txnrisk.sinks.progress import committed_up_to, record_progress
from txnrisk.sinks.retention import expire
from txnrisk.sinks.upsert import upsert_batch
from txnrisk.sources.queue import queue_files
from txnrisk.sources.tables import (
    LOG_ID,
    NOTE,
    create_file,
    current_view,
    keys_path,
    list_names,
    log_path,
    numbers,
    read_log,
    snapshot_path,
)
from txnrisk.streaming import layers
from txnrisk.streaming.metrics import BatchMetrics, read_metrics

CFG = RiskConfig()
DAY = 86_400


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "layers"))


def committed(spark, layout, consumer, micro_batch, generation=0):
    create_file(spark, f"{layout.checkpoint(consumer)}/{NOTE}{generation}")
    create_file(spark, f"{layout.checkpoint(consumer)}/commits/{micro_batch}")


def test_only_committed_reads_count(spark, layout):
    where = layout.checkpoint("silver")
    assert committed_up_to(spark, layout.progress, "silver", where) is None
    record_progress(spark, layout.progress, "silver", 0, -1)
    record_progress(spark, layout.progress, "silver", 1, 4)
    assert committed_up_to(spark, layout.progress, "silver", where) is None
    committed(spark, layout, "silver", 1)
    record_progress(spark, layout.progress, "silver", 2, 9)
    assert committed_up_to(spark, layout.progress, "silver", where) == 4
    committed(spark, layout, "silver", 2)
    record_progress(spark, layout.progress, "silver", 3, 12)
    assert committed_up_to(spark, layout.progress, "silver", where) == 9
    assert len(list_names(spark, f"{layout.progress}/silver")) == 2
    # A new checkpoint reads from the start.
    committed(spark, layout, "silver", 3, generation=1)
    assert committed_up_to(spark, layout.progress, "silver", where) is None
    assert committed_up_to(spark, layout.progress, "gold") is None


def test_nothing_goes_that_silver_has_still_to_read(spark, layout):
    for batch in range(6):
        append_batch(bronze(spark, record(transaction_id=f"T{batch}", ingested_at=at(batch * DAY), batch_id=batch)), layout.bronze)
    assert expire(spark, layout, at(30 * DAY))["bronze"] == 0
    record_progress(spark, layout.progress, "silver", 0, 3)
    assert expire(spark, layout, at(30 * DAY))["bronze"] == 0
    committed(spark, layout, "silver", 0)
    assert expire(spark, layout, at(9 * DAY))["bronze"] == 2
    assert expire(spark, layout, at(30 * DAY))["bronze"] == 2
    assert sorted(numbers(spark, layout.bronze, "batch_id=")) == [4, 5]


def test_quarantines_expire_by_age(spark, layout):
    layers.bronze_batch(layout)(envelope(spark, ["{bad"]), 0)
    layers.silver_batch(layout, CFG)(bronze(spark, record(currency="USD")), 0)
    assert expire(spark, layout, at(0))["bronze_quarantine"] == 0
    gone = expire(spark, layout, "2100-01-01 00:00:00")
    assert (gone["bronze_quarantine"], gone["silver_quarantine"]) == (1, 1)


def test_folders_stay_bounded(spark, layout):
    """Fifty batches a day apart, with compaction and retention every ten: what is kept does not grow."""
    counts = []
    for batch in range(50):
        rows = silver(spark, {"transaction_id": f"T{batch}", "sec": batch * DAY}, {"transaction_id": "again", "sec": batch * DAY})
        upsert_batch(rows, layout.silver, batch)
        if batch % 10 == 0:
            ten = [record(ingested_at=at(b * DAY), batch_id=b) for b in range(batch, batch + 10)]
            append_batch(bronze(spark, *ten), layout.bronze)
        record_progress(spark, layout.progress, "silver", batch, batch - 1)
        record_progress(spark, layout.progress, "gold", batch, batch - 1)
        if batch % 10 == 9:
            for consumer in ("silver", "gold"):
                committed(spark, layout, consumer, batch)
            compact(spark, layout.silver, schemas.silver(), at(batch * DAY), 12)
            expire(spark, layout, at(batch * DAY), {"bronze": 7, "silver": 12, "gold": 12})
            folders = (layout.bronze, log_path(layout.silver), keys_path(layout.silver), snapshot_path(layout.silver))
            counts.append([len([n for n in list_names(spark, p) if not n.startswith(("_", "."))]) for p in folders])
    assert max(max(c) for c in counts) <= 25 and counts[-1] == counts[-2]
    held = {r.transaction_id for r in current_view(spark, layout.silver, schemas.silver()).collect()}
    assert held == {f"T{d}" for d in range(37, 50)} | {"again"}


def test_watermarked_silver_drops_and_counts_late_rows(spark, layout, tmp_path):
    queue, cfg = str(tmp_path / "queue"), RiskConfig(max_files_per_trigger=1, watermark="10 minutes")
    hour = 3600

    def message(i, sec, **over):
        return {k: v for k, v in record(transaction_id=f"T{i}", transaction_time=at(sec).isoformat(), **over).items()}

    files = [
        [message(1, 0), message(2, hour)],
        [message(3, 5 * hour), message(3, 5 * hour)],
        [message(4, 10), message(5, 5 * hour - 60), message(3, 5 * hour + 5), message(6, 0, currency="USD"), message(7, 0, amount=None)],
    ]  # T4 is late by now; T3 has come before
    for i, messages in enumerate(files):
        envelope(spark, messages, 10 * i).coalesce(1).write.mode("append").parquet(queue)
    metrics = BatchMetrics(spark, layout.stream_metrics).start()
    layers.start_bronze(queue_files(spark, queue, cfg), layout, None, metrics=metrics).awaitTermination()
    layers.start_silver(spark, layout, cfg, None, metrics=metrics).awaitTermination()
    metrics.stop()
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")  # set for the query only
    held = {r.transaction_id for r in current_view(spark, layout.silver, schemas.silver()).collect()}
    assert held == {"T1", "T2", "T3", "T5"}
    assert {r.transaction_id for r in spark.read.json(layout.silver_quarantine).collect()} == {"T6"}
    rows = read_metrics(spark, layout.stream_metrics).collect()
    got = {(r.layer, r.micro_batch, r.name): r.value for r in rows}
    assert [got["silver", i, "n_late"] for i in range(3)] == [0, 0, 1]
    assert [got["silver", i, "n_repeated"] for i in range(3)] == [0, 1, 1]
    assert [got["silver", i, "n_rows"] for i in range(3)] == [2, 1, 2]
    assert [got["bronze", i, "n_quarantined"] for i in range(3)] == [0, 0, 1]
    assert all(got["silver", i, "triggerExecution_ms"] > 0 and got["silver", i, "n_input"] > 0 for i in range(3))
    # Repeating a micro-batch's report replaces its values.
    assert len(rows) == len(got)


def test_mart_replaces_changed_days_and_swaps_at_once(spark, layout):
    cfg, name = RiskConfig(), "mart_by_days"

    def feed(i, *rows):
        layers.silver_batch(layout, cfg)(bronze(spark, *rows), i)
        log = read_log(spark, layout.silver, schemas.silver())
        layers.gold_batch(layout, cfg)(log.where(F.col(LOG_ID) == i), i)

    def txn(i, day, **over):
        return record(transaction_id=f"T{i}", transaction_time=at(day * DAY + i).isoformat(), offset=i, **over)

    assert mart.refresh_mart(spark, layout, name) is None
    try:
        feed(0, txn(1, 0, customer_id="A"), txn(2, 20, customer_id="B"), txn(3, 40, customer_id="C"))
        first = mart.refresh_mart(spark, layout, name)
        before = spark.table(name)
        assert mart.mart_is_current(spark, layout) and before.count() == 3 and set(first.days.values()) == {0}
        feed(1, txn(4, 20, customer_id="B", amount=99.0), txn(1, 60, customer_id="A"))
        assert not mart.mart_is_current(spark, layout)
        second = mart.refresh_mart(spark, layout, name)
        days = sorted(first.days)
        assert second.days == {days[1]: 1, days[2]: 0, days[0] + 60: 1} and second.covered == 1
        want = mart.feature_mart(current_view(spark, layout.gold, schemas.gold()))
        assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, want.select(spark.table(name).columns).collect()))
        assert before.count() == 3  # who had opened the mart before still reads it whole
        assert mart.refresh_mart(spark, layout, name) == second
    finally:
        spark.sql(f"drop view if exists {name}")
