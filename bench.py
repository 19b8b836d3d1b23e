"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local threads.
Each query runs in full into the no-op sink; one warm-up query is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "bronze_parsed",
    "bronze_batch_metrics",
    "silver_valid",
    "silver_dedup",
    "silver_upsert",
    "gold_velocity_1h",
    "gold_amount_zscore",
    "gold_features",
    "gold_incremental",
    "feature_mart",
    "score_thresholds",
    "risk_tiers",
    "classification_metrics",
    "roc_auc",
    "forest_nodes",
    "forest_scores",
    "stream_bronze",
    "stream_silver_gold",
    "compaction",
    "sla_latency",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txnrisk-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        # Call-site capture costs more than planning for plans of this size.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from txnrisk.plans.catalog import QUERIES

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    run("gold_features")
    only = sys.argv[1:] or HEADLINE
    times = {name: run(name) for name in only}
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": {name: round(rows / sec) for name, sec in times.items()},
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
