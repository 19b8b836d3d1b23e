"""Run one layer or job: ``spark-submit`` this package's folder, or ``python -m txnrisk gold``.

The layers run until interrupted; ``--once`` processes what is there and stops.
"""

from __future__ import annotations

import argparse
import logging
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from txnrisk import schemas
from txnrisk.config import RETENTION_DAYS, TRIGGERS, Layout, RiskConfig
from txnrisk.operators.monitor import layer_latency
from txnrisk.plans.mart import feature_mart, mart_is_current, refresh_mart
from txnrisk.plans.scoring import high_risk_sample, scoring_job, tier_counts
from txnrisk.plans.training import training_job
from txnrisk.session import prepare, stage
from txnrisk.sinks.maintenance import compact
from txnrisk.sinks.retention import expire
from txnrisk.sources.queue import queue_files, queue_stream
from txnrisk.sources.tables import current_view, mart_or_gold
from txnrisk.streaming import layers
from txnrisk.streaming.metrics import BatchMetrics


def _mart(spark: SparkSession, layout: Layout, cfg: RiskConfig) -> DataFrame:
    """The mart, brought up to date if it lags behind Gold, or its rows written once from Gold: jobs read them several times."""
    gold = current_view(spark, layout.gold, schemas.gold())
    if not mart_is_current(spark, layout):
        refresh_mart(spark, layout, cfg.mart_table)
    return mart_or_gold(spark, cfg.mart_table, gold, lambda rows: stage(feature_mart(rows), "mart"))


def _stream(
    spark: SparkSession, job: str, layout: Layout, cfg: RiskConfig, once: bool, files: str | None, metrics: BatchMetrics
):
    interval = None if once else TRIGGERS[job]
    if job == "bronze":
        source = queue_files(spark, files, cfg) if files else queue_stream(spark, cfg)
        return layers.start_bronze(source, layout, interval, metrics=metrics)
    start = layers.start_silver if job == "silver" else layers.start_gold
    return start(spark, layout, cfg, interval, metrics=metrics)


def main(argv: list[str] | None = None) -> None:
    jobs = ("bronze", "silver", "gold", "mart", "train", "score", "latency", "compact", "retain")
    parser = argparse.ArgumentParser(prog="txnrisk", description=__doc__)
    parser.add_argument("job", choices=jobs)
    parser.add_argument("--root", help="folder of the layers (default: TXNRISK_ROOT)")
    parser.add_argument("--once", action="store_true", help="process what is there, then stop")
    parser.add_argument("--files", help="read queue messages from parquet files in this folder")
    parser.add_argument("--max-offsets", type=int, help="queue messages per Bronze batch")
    parser.add_argument("--min-partitions", type=int, help="read tasks per Bronze batch, at least")
    parser.add_argument("--watermark", help="drop rows later than this and repeats in Silver's stream, as '10 minutes'")
    parser.add_argument("--max-files", type=int, help="files per batch where messages are read from files")
    parser.add_argument("--archive", help="folder that files of messages move to once they are committed")
    args = parser.parse_args(argv)
    limits = {
        "max_offsets_per_trigger": args.max_offsets,
        "queue_min_partitions": args.min_partitions,
        "max_files_per_trigger": args.max_files,
        "watermark": args.watermark,
        "archive": args.archive,
    }

    logging.basicConfig(level=logging.INFO)
    spark = prepare(SparkSession.builder.appName(f"txnrisk-{args.job}").getOrCreate())
    layout, cfg = (Layout(args.root) if args.root else Layout()), RiskConfig(**{k: v for k, v in limits.items() if v})
    run_id = f"{args.job}-{uuid.uuid4().hex}"

    if args.job in TRIGGERS:
        metrics = BatchMetrics(spark, layout.stream_metrics).start()
        query = _stream(spark, args.job, layout, cfg, args.once, args.files, metrics)
        if args.once:
            query.awaitTermination()
            metrics.stop()
        else:
            layers.run_until_stopped(spark, query)
    elif args.job == "mart":
        refresh_mart(spark, layout, cfg.mart_table)
    elif args.job == "train":
        print(training_job(spark, _mart(spark, layout, cfg), layout, cfg, run_id))
    elif args.job == "score":
        scored = scoring_job(spark, _mart(spark, layout, cfg), layout, cfg, run_id)
        tier_counts(scored).show()
        high_risk_sample(scored).show(truncate=False)
    elif args.job == "latency":
        layer_latency(current_view(spark, layout.gold, schemas.gold())).show()
    elif args.job == "retain":
        print(expire(spark, layout, datetime.now(timezone.utc)))
    else:
        now = datetime.now(timezone.utc)
        for table, schema, layer in (
            (layout.silver, schemas.silver(), "silver"),
            (layout.gold, schemas.gold(), "gold"),
        ):
            compact(spark, table, schema, now, RETENTION_DAYS[layer])


if __name__ == "__main__":
    main()
