"""The three chained layer streams.

Bronze reads the queue, Silver reads Bronze's files, Gold reads Silver's change log. Every
batch writes only its own partitions, so a batch that is replayed after a crash replaces what
it wrote before.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from txnrisk import schemas
from txnrisk.config import TRIGGERS, Layout, RiskConfig
from txnrisk.operators.monitor import batch_counters
from txnrisk.plans import bronze, gold, silver
from txnrisk.session import prepare, staged
from txnrisk.sinks.append import append_batch, quarantine_batch
from txnrisk.sinks.progress import record_progress
from txnrisk.sinks.upsert import create_layer, upsert_batch
from txnrisk.sources.tables import (
    LOG_ID,
    batch_number,
    current_view,
    generation_of,
    layer_stream,
    log_path,
    log_stream,
    make_folder,
    positions,
    snapshot_index_path,
)
from txnrisk.streaming.dedupe import watermarked
from txnrisk.streaming.metrics import BatchMetrics

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Batch = Callable[[DataFrame, int], None]
Report = Callable[[str, int, dict], None]

log = logging.getLogger(__name__)


def log_counters(layer: str, batch_id: int, counters: dict) -> None:
    log.info("%s batch %s: %s", layer, batch_id, counters)


def bronze_batch(
    layout: Layout, record: StructType = schemas.RECORD, report: Report = log_counters, generation: int = 0
) -> Batch:
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch_id = batch_number(generation, batch_id)
        seen = Observation(f"bronze-{batch_id}")
        rows = bronze.parsed(batch, batch_id, record)
        counters = batch_counters(bronze.required_present())
        append_batch(bronze.accepted(rows.observe(seen, *counters)), layout.bronze)
        # Counted while writing: messages are fetched and parsed again only if some were rejected.
        if seen.get["n_quarantined"]:
            quarantine_batch(bronze.quarantined(rows), layout.bronze_quarantine)
        report("bronze", batch_id, seen.get)

    return write


def _note(spark: SparkSession, layout: Layout, consumer: str, newest: int | None, generation: int, micro_batch: int) -> None:
    """Note how far a consumer has read. The newest batch may go on in its next micro-batch, so it doesn't count."""
    if newest is not None:
        record_progress(spark, layout.progress, consumer, micro_batch, newest - 1, generation)


def silver_batch(layout: Layout, cfg: RiskConfig, report: Report = log_counters, generation: int = 0) -> Batch:
    def write(batch: DataFrame, micro_batch: int) -> None:
        if batch.isEmpty():
            return
        batch_id = batch_number(generation, micro_batch)
        seen, merged = Observation(f"silver-{batch_id}"), Observation(f"silver-merged-{batch_id}")
        rows = silver.typed(silver.stamped(batch))
        newest = F.max("batch_id").alias("newest")
        valid, _ = silver.split_typed(rows.observe(seen, *silver.counters(cfg), newest), cfg)
        deduplicated = silver.deduplicated(valid).observe(merged, F.count(F.lit(1)).alias("n_merged"))
        upsert_batch(deduplicated, layout.silver, batch_id)
        # Rejected rows are kept even when a batch has no valid row at all.
        if seen.get["n_invalid"]:
            _, invalid = silver.split_typed(rows, cfg)
            marked = invalid.withColumn(LOG_ID, F.lit(batch_id).cast("bigint"))
            quarantine_batch(marked, layout.silver_quarantine, LOG_ID)
        counters = {**seen.get, **merged.get}
        _note(batch.sparkSession, layout, "silver", counters.pop("newest"), generation, micro_batch)
        report("silver", batch_id, counters)

    return write


def gold_batch(
    layout: Layout,
    cfg: RiskConfig,
    record: StructType = schemas.RECORD,
    report: Report = log_counters,
    generation: int = 0,
) -> Batch:
    """Recompute the rows that a Silver batch can affect, from the current Silver table.

    Besides the batch's own customers these are the customers a changed row belonged to when
    its Gold row was last written. The rows in reach are written once, since the features read
    them twice.
    """

    def write(batch: DataFrame, micro_batch: int) -> None:
        if batch.isEmpty():
            return
        batch_id = batch_number(generation, micro_batch)
        spark = batch.sparkSession
        changed = gold.places(batch).unionByName(positions(spark, layout.gold, batch).withColumnRenamed("event_sec", gold.SECOND))
        spans = gold.touched_spans(changed, cfg).persist()
        try:
            reached = current_view(
                spark,
                layout.silver,
                schemas.silver(record),
                narrow=lambda rows: gold.in_reach(rows, spans, cfg),
                days=gold.days_in_reach(spans, cfg),
            )
            written = Observation(f"gold-{batch_id}")
            with staged(reached, "gold-reached") as rows:
                fresh = gold.stamped(gold.refreshed(rows, spans, cfg)).observe(written, F.count(F.lit(1)).alias("n_rows"))
                upsert_batch(fresh.select(*schemas.gold(record).fieldNames()), layout.gold, batch_id)
        finally:
            spans.unpersist()
        _note(spark, layout, "gold", batch.agg(F.max(LOG_ID)).first()[0], generation, micro_batch)
        report("gold", batch_id, written.get)

    return write


def _start(
    stream: DataFrame,
    batch: Batch,
    checkpoint: str,
    interval: str | None,
    layer: str,
    generation: int,
    metrics: BatchMetrics | None = None,
) -> StreamingQuery:
    """``interval`` None means: process what is there, then stop."""
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    query = writer.start()
    if metrics is not None:
        metrics.watch(query, layer, generation)
    return query


def _once(batch: Batch, label: str) -> Batch:
    """Evaluate the rows of a micro-batch once: every further time its state would be worked through, and counted, again."""

    def write(rows: DataFrame, micro_batch: int) -> None:
        with staged(rows, label) as written:
            batch(written, micro_batch)

    return write


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started meanwhile keep their state in RocksDB, outside the JVM's heap."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _log_generation(spark: SparkSession, checkpoint: str, table: str, *others: str) -> int:
    return generation_of(spark, checkpoint, (log_path(table), *others), LOG_ID, snapshot_index_path(table))


def start_bronze(
    envelope: DataFrame,
    layout: Layout,
    interval: str | None = TRIGGERS["bronze"],
    record: StructType = schemas.RECORD,
    report: Report = log_counters,
    metrics: BatchMetrics | None = None,
) -> StreamingQuery:
    report = report if metrics is None else metrics.report
    spark = prepare(envelope.sparkSession)
    make_folder(spark, layout.bronze)
    generation = generation_of(spark, layout.checkpoint("bronze"), (layout.bronze, layout.bronze_quarantine), "batch_id")
    batch = bronze_batch(layout, record, report, generation)
    return _start(envelope, batch, layout.checkpoint("bronze"), interval, "bronze", generation, metrics)


def start_silver(
    spark: SparkSession,
    layout: Layout,
    cfg: RiskConfig,
    interval: str | None = TRIGGERS["silver"],
    record: StructType = schemas.RECORD,
    report: Report = log_counters,
    metrics: BatchMetrics | None = None,
) -> StreamingQuery:
    """With ``cfg.watermark`` rows pass a stateful layer first, which drops late rows and repeats.

    Late rows are counted in the query's progress, and so in the metrics. Rejected rows pass it by.
    """
    report = report if metrics is None else metrics.report
    create_layer(prepare(spark), layout.silver)
    rows = layer_stream(spark, layout.bronze, schemas.bronze(record), cfg.max_files_per_trigger)
    generation = _log_generation(spark, layout.checkpoint("silver"), layout.silver, layout.silver_quarantine)
    batch = silver_batch(layout, cfg, report, generation)
    if cfg.watermark is None:
        return _start(rows, batch, layout.checkpoint("silver"), interval, "silver", generation, metrics)
    with _state_on_disk(spark):
        return _start(watermarked(rows, cfg), _once(batch, "silver-passed"), layout.checkpoint("silver"), interval, "silver", generation, metrics)


def start_gold(
    spark: SparkSession,
    layout: Layout,
    cfg: RiskConfig,
    interval: str | None = TRIGGERS["gold"],
    record: StructType = schemas.RECORD,
    report: Report = log_counters,
    metrics: BatchMetrics | None = None,
) -> StreamingQuery:
    report = report if metrics is None else metrics.report
    create_layer(prepare(spark), layout.gold)
    rows = log_stream(spark, layout.silver, schemas.silver(record), cfg.max_files_per_trigger)
    generation = _log_generation(spark, layout.checkpoint("gold"), layout.gold)
    batch = gold_batch(layout, cfg, record, report, generation)
    return _start(rows, batch, layout.checkpoint("gold"), interval, "gold", generation, metrics)


def run_until_stopped(spark: SparkSession, *queries: StreamingQuery) -> None:
    """Wait for the streams; on an interrupt stop them all, then the session."""
    try:
        spark.streams.awaitAnyTermination()
    except KeyboardInterrupt:
        log.info("stopping %d streams", len(queries))
        for query in queries:
            query.stop()
        spark.stop()
