"""The batch writers and the chained streams, on hand-made messages."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from rows import at, bronze, envelope, record

from txnrisk import schemas
from txnrisk.config import Layout, RiskConfig
from txnrisk.plans import gold, mart, silver
from txnrisk.sinks.maintenance import compact
from txnrisk.sources.queue import queue_files
from txnrisk.sources.tables import (
    GENERATION,
    LOG_ID,
    batch_number,
    current_view,
    generation_of,
    log_path,
    read_log,
    snapshot_index_path,
)
from txnrisk.streaming import layers

CFG = RiskConfig()
DAY = 86_400


def txn(i, sec=0, **over):
    return record(transaction_id=f"T{i}", transaction_time=at(sec).isoformat(), offset=i, **over)


def feed(spark, layout, batches, cfg=CFG, first=0, compact_after=()):
    for i, rows in enumerate(batches, start=first):
        layers.silver_batch(layout, cfg)(bronze(spark, *rows), i)
        log = read_log(spark, layout.silver, schemas.silver())
        layers.gold_batch(layout, cfg)(log.where(F.col(LOG_ID) == i), i)
        if i in compact_after:
            compact(spark, layout.silver, schemas.silver())
            compact(spark, layout.gold, schemas.gold())


COMPARED = ["transaction_id", "customer_id", "amount", "velocity_1h", "amount_zscore", "is_high_risk_hour"]


def gold_rows(spark, layout):
    rows = current_view(spark, layout.gold, schemas.gold()).select(*COMPARED)
    return {r.transaction_id: tuple(r) for r in rows.collect()}


def expected(spark, layout):
    """Gold recomputed in full from the current Silver table."""
    rows = gold.features(current_view(spark, layout.silver, schemas.silver()), CFG).select(*COMPARED)
    return {r.transaction_id: tuple(r) for r in rows.collect()}


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "layers"))


def test_late_row_refreshes_later_rows(spark, layout):
    feed(spark, layout, [[txn(1, 0, amount=10.0), txn(2, 3000, amount=30.0)], [txn(3, 1500, amount=80.0)]])
    got = gold_rows(spark, layout)
    assert {k: v[3] for k, v in got.items()} == {"T1": 1, "T3": 2, "T2": 3}
    assert got == expected(spark, layout)


def test_batch_order_does_not_matter(spark, tmp_path):
    batches = [
        [txn(i, s, customer_id=c, amount=a) for i, s, c, a in part]
        for part in (
            [(1, 0, "A", 10.0), (2, 9 * DAY, "A", 20.0), (3, 50, "B", 5.0)],
            [(4, 2 * DAY, "A", 70.0), (5, 60, "B", 6.0)],
            [(6, 2 * DAY + 100, "A", 15.0), (7, 10 * DAY, "B", 9.0)],
        )
    ]
    forward, backward, at_once = (Layout(str(tmp_path / n)) for n in "fbo")
    feed(spark, forward, batches)
    feed(spark, backward, batches[::-1])
    feed(spark, at_once, [sum(batches, [])])
    assert gold_rows(spark, forward) == gold_rows(spark, backward) == gold_rows(spark, at_once)


def test_upsert_replaces_and_moves_between_customers(spark, layout):
    feed(spark, layout, [[txn(1, 0, customer_id="A"), txn(2, 10, customer_id="A"), txn(3, 20, customer_id="B")]])
    assert {k: v[3] for k, v in gold_rows(spark, layout).items()} == {"T1": 1, "T2": 2, "T3": 1}
    feed(spark, layout, [[txn(1, 5, customer_id="B", amount=99.0)]], first=1)
    got = gold_rows(spark, layout)
    assert {k: v[3] for k, v in got.items()} == {"T1": 1, "T2": 1, "T3": 2}
    assert got["T1"][1:3] == ("B", 99.0)
    assert got == expected(spark, layout)


def test_replay_changes_nothing(spark, layout):
    first, second = [txn(1), txn(2, 5)], [txn(2, 6, amount=50.0), txn(3, 9)]
    feed(spark, layout, [first, second])
    before = gold_rows(spark, layout)
    feed(spark, layout, [second], first=1)
    assert gold_rows(spark, layout) == before
    assert spark.read.parquet(log_path(layout.silver)).count() == 4


def test_compacted_tables_give_the_same(spark, tmp_path):
    batches = [
        [txn(1, 0, customer_id="A", amount=10.0), txn(2, DAY, customer_id="A", amount=20.0), txn(9, 0, customer_id="Z")],
        [txn(1, 3 * DAY, customer_id="B", amount=11.0), txn(3, DAY + 60, customer_id="A", amount=60.0)],
        [txn(4, 100, customer_id="A", amount=5.0), txn(3, 8 * DAY, customer_id="A", amount=61.0)],
    ]
    plain, compacted = Layout(str(tmp_path / "p")), Layout(str(tmp_path / "c"))
    feed(spark, plain, batches)
    feed(spark, compacted, batches, compact_after=(0, 1))
    assert gold_rows(spark, compacted) == gold_rows(spark, plain) == expected(spark, plain)


def test_shuffle_join_when_the_batch_is_too_large_to_broadcast(spark, layout):
    cfg = RiskConfig(broadcast_rows=0)
    feed(spark, layout, [[txn(1, 0), txn(2, 60)], [txn(3, 30)]], cfg=cfg)
    assert gold_rows(spark, layout) == expected(spark, layout)


def test_rejected_rows_are_kept_when_none_is_valid(spark, layout):
    layers.silver_batch(layout, CFG)(bronze(spark, txn(1, currency="USD"), txn(2, currency=None)), 0)
    rejected = spark.read.json(layout.silver_quarantine)
    assert sorted(r.transaction_id for r in rejected.collect()) == ["T1", "T2"]
    assert {tuple(r.failed_rules) for r in rejected.collect()} == {("currency",)}


def test_counters_are_reported(spark, layout):
    seen = []
    report = lambda layer, batch_id, counters: seen.append((layer, batch_id, counters))
    layers.bronze_batch(layout, report=report)(envelope(spark, [record(is_fraud=True), "{bad"]), 4)
    layers.silver_batch(layout, CFG, report)(bronze(spark, txn(1), txn(1), txn(2, currency="USD")), 4)
    assert seen[0] == ("bronze", 4, {"n_rows": 2, "n_valid": 1, "n_quarantined": 1, "fraud_rate": 1.0})
    assert seen[1] == ("silver", 4, {"n_rows": 3, "n_invalid": 1, "n_merged": 1})


def test_empty_batch_writes_nothing(spark, layout):
    layers.bronze_batch(layout)(envelope(spark, [record()]).where("false"), 0)
    layers.silver_batch(layout, CFG)(bronze(spark, txn(1)).where("false"), 0)
    assert current_view(spark, layout.silver, schemas.silver()).count() == 0


def run_streams(spark, layout, queue, cfg):
    layers.start_bronze(queue_files(spark, queue, cfg), layout, None).awaitTermination()
    layers.start_silver(spark, layout, cfg, None).awaitTermination()
    layers.start_gold(spark, layout, cfg, None).awaitTermination()


def test_streams_resume_and_equal_the_batch_result(spark, layout, tmp_path):
    queue, cfg = str(tmp_path / "queue"), RiskConfig(max_files_per_trigger=1)

    def message(i, sec, **over):
        return {k: v for k, v in txn(i, sec, **over).items() if k != "offset"}

    first = [message(1, 0), message(2, 100), message(2, 100), "{bad", message(3, 50, currency="USD")]
    envelope(spark, first).coalesce(1).write.mode("append").parquet(queue)
    run_streams(spark, layout, queue, cfg)
    assert {k: v[3] for k, v in gold_rows(spark, layout).items()} == {"T1": 1, "T2": 2}

    envelope(spark, [message(4, 60), message(5, 9 * DAY)], 10).coalesce(1).write.mode("append").parquet(queue)
    run_streams(spark, layout, queue, cfg)
    assert {k: v[3] for k, v in gold_rows(spark, layout).items()} == {"T1": 1, "T4": 2, "T2": 3, "T5": 1}
    assert gold_rows(spark, layout) == expected(spark, layout)

    bronze_rows = spark.read.schema(schemas.bronze()).parquet(layout.bronze)
    assert sorted(r.offset for r in bronze_rows.collect()) == [0, 1, 2, 4, 10, 11]
    assert gold_rows(spark, layout).keys() == {
        r.transaction_id for r in silver.build(bronze_rows, CFG).collect()
    }
    assert spark.read.json(layout.bronze_quarantine).first().raw_value == "{bad"
    gold_table = current_view(spark, layout.gold, schemas.gold())
    assert gold_table.where("gold_processed_at is null or silver_processed_at is null").count() == 0


def test_a_widened_record_schema_reaches_bronze_and_old_rows_read_null(spark, layout):
    wide = StructType([*schemas.RECORD.fields, StructField("device", StringType())])
    layers.bronze_batch(layout)(envelope(spark, [record(transaction_id="A")]), 0)
    layers.bronze_batch(layout, wide)(envelope(spark, [record(transaction_id="B", device="phone")], 1), 1)
    rows = spark.read.schema(schemas.bronze(wide)).parquet(layout.bronze)
    assert {r.transaction_id: r.device for r in rows.collect()} == {"A": None, "B": "phone"}


def test_processing_time_trigger_and_stop(spark, layout, tmp_path):
    queue = str(tmp_path / "queue")
    envelope(spark, [record()]).write.parquet(queue)
    query = layers.start_bronze(queue_files(spark, queue, CFG), layout, "1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert not query.isActive
    assert spark.read.schema(schemas.bronze()).parquet(layout.bronze).count() == 1


def test_interrupt_stops_streams_and_session(spark, layout, tmp_path):
    queue = str(tmp_path / "queue")
    envelope(spark, [record()]).write.parquet(queue)
    query = layers.start_bronze(queue_files(spark, queue, CFG), layout, "1 hour")

    class Session:
        stopped = False

        class streams:
            @staticmethod
            def awaitAnyTermination():
                raise KeyboardInterrupt

        def stop(self):
            self.stopped = True

    session = Session()
    layers.run_until_stopped(session, query)
    assert session.stopped and not query.isActive


def test_a_new_checkpoint_neither_replaces_nor_hides_rows(spark, layout):
    """Batch ids start at 0 again, before and after a compaction."""

    def started(checkpoint):
        written = (log_path(layout.silver), layout.silver_quarantine)
        return generation_of(spark, checkpoint, written, LOG_ID, snapshot_index_path(layout.silver))

    one, two, three = (layout.checkpoint(f"silver-{n}") for n in (1, 2, 3))
    assert started(one) == 0
    layers.silver_batch(layout, CFG, generation=0)(bronze(spark, txn(1)), 0)
    layers.silver_batch(layout, CFG, generation=0)(bronze(spark, txn(2)), 1)
    assert started(two) == 1
    layers.silver_batch(layout, CFG, generation=1)(bronze(spark, txn(3), txn(1, amount=77.0)), 0)
    assert compact(spark, layout.silver, schemas.silver()) == GENERATION == batch_number(1, 0)
    assert started(three) == 2
    layers.silver_batch(layout, CFG, generation=2)(bronze(spark, txn(4)), 0)
    assert (started(one), started(two), started(three)) == (0, 1, 2)
    held = {r.transaction_id: r.amount for r in current_view(spark, layout.silver, schemas.silver()).collect()}
    assert set(held) == {"T1", "T2", "T3", "T4"} and held["T1"] == 77.0


def test_nothing_staged_stays_after_a_gold_batch(spark, layout):
    def staged_folders():
        return [p for p in Path(spark.conf.get("spark.checkpoint.dir")).glob("gold-reached-*")]

    feed(spark, layout, [[txn(1, 0), txn(2, 60)]])
    assert staged_folders() == [] and len(gold_rows(spark, layout)) == 2


def test_mart_table(spark, layout, tmp_path):
    feed(spark, layout, [[txn(1, 0), txn(2, 60)]])
    view = current_view(spark, layout.gold, schemas.gold())
    spark.sql(f"create database mart_db location '{tmp_path / 'db'}'")
    try:
        for _ in range(2):
            mart.write_mart(view, "mart_db.features")
        assert sorted(map(str, spark.table("mart_db.features").collect())) == sorted(
            map(str, mart.feature_mart(view).collect())
        )
    finally:
        spark.sql("drop database mart_db cascade")


def test_read_files_are_archived(spark, layout, tmp_path):
    """The folder of messages does not grow with the batches, over a restart too, and no message is lost or doubled."""
    queue, archive = tmp_path / "queue", tmp_path / "done" / "messages"
    cfg, files = RiskConfig(max_files_per_trigger=1, archive=str(archive)), 0
    for run in range(2):
        for _ in range(8):
            message = {k: v for k, v in txn(files, files * 60).items() if k != "offset"}
            envelope(spark, [message], files).coalesce(1).write.mode("append").parquet(str(queue))
            files += 1
        layers.start_bronze(queue_files(spark, str(queue), cfg), layout, None).awaitTermination()
        left, moved = ({f.name for f in where.rglob("part-*.parquet")} for where in (queue, archive))
        assert len(left | moved) == files and not left & moved
        assert len(left) <= 2 * (run + 1)
    rows = spark.read.schema(schemas.bronze()).parquet(layout.bronze)
    assert sorted(r.offset for r in rows.select("offset").collect()) == list(range(files))
