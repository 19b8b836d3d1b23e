"""Plans that must hold when one key has a third of all rows, and the command line."""

import os
import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import at, envelope, node_lines, record, silver

from txnrisk import schemas
from txnrisk.__main__ import main
from txnrisk.config import Layout, RiskConfig
from txnrisk.operators.rolling import Trailing, with_trailing_stats
from txnrisk.plans import gold
from txnrisk.plans import silver as silver_layer
from txnrisk.plans.catalog import QUERIES
from txnrisk.session import shared_dir, stage
from txnrisk.sources.tables import current_view


def plan_of(df) -> str:
    return "\n".join(node_lines(df))


@pytest.fixture
def no_broadcast(spark):
    """Plans as they come out for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_large_refresh_never_partitions_by_customer_alone(spark, no_broadcast):
    cfg = RiskConfig(broadcast_rows=0)
    rows = stage(silver(spark, *[{"sec": s} for s in range(50)]), "silver")
    spans = gold.touched_spans(gold.places(rows), cfg)
    fresh = gold.refreshed(gold.in_reach(rows, spans, cfg), spans, cfg)
    plan = plan_of(fresh)
    assert re.search(r"hashpartitioning\(customer_id#\d+, _salt", plan)
    assert re.search(r"hashpartitioning\(customer_id#\d+, event_sec", plan)
    assert re.search(r"hashpartitioning\(customer_id#\d+, _tile", plan)
    joined_on = re.findall(r"hashpartitioning\(customer_id#\d+, 4\)", plan)
    # Customer alone: only the spans themselves, which are combined to a row per customer and week before.
    assert len(joined_on) <= len(re.findall("partial_min", plan))
    assert fresh.count() == 50


def test_a_small_refresh_moves_no_silver_row_to_find_its_customers(spark):
    cfg = RiskConfig()
    rows = stage(silver(spark, *[{"sec": s} for s in range(5)]), "silver")
    reached = gold.in_reach(rows, gold.touched_spans(gold.places(rows), cfg), cfg)
    assert "BroadcastHashJoin" in plan_of(reached)


def test_adaptive_execution_splits_a_hot_second(spark, no_broadcast):
    keep = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        i = F.col("id")
        rows = stage(
            spark.range(0, 40_000, 1, 16).select(
                F.concat(F.lit("t"), i).alias("id"),
                F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), i % 997)).alias("c"),
                F.when(i % 3 == 0, F.lit(7)).otherwise(i).alias("sec"),
                (i % 100 + 0.5).alias("amount"),
                F.sha2(i.cast("string"), 512).alias("wide"),
            ),
            "hot",
        )
        out = with_trailing_stats(rows, "c", "sec", counted="id", counts=[Trailing("n", 60)])
        got = out.collect()
        assert len(got) == 40_000
        assert {r.n for r in got if r.c == "hot"} == {13_334}
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rules_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    spark.createDataFrame([], schemas.bronze()).write.parquet(path)
    valid, _ = silver_layer.split(spark.read.schema(schemas.bronze()).parquet(path), RiskConfig())
    plan = valid.select("transaction_id", "amount")._jdf.queryExecution().executedPlan().toString()
    for pushed in ("GreaterThanOrEqual(amount,0.01)", "LessThanOrEqual(amount,50000.0)", "IsNotNull(merchant_id)"):
        assert pushed in plan
    assert "location_country" not in plan.split("ReadSchema")[1]


def test_scratch_space_is_the_clusters_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_command_line_runs_all_jobs(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    root, queue = str(tmp_path / "data"), str(tmp_path / "queue")
    messages = [
        record(transaction_id=f"T{i}", customer_id=f"C{i % 7}", amount=10.0 + i, transaction_time=at(i * 60).isoformat(),
               is_fraud=i % 20 == 0)
        for i in range(120)
    ]
    envelope(spark, messages).write.parquet(queue)
    main(["bronze", "--once", "--root", root, "--files", queue])
    main(["silver", "--once", "--root", root])
    main(["gold", "--once", "--root", root])
    for job in ("train", "score", "latency"):
        main([job, "--root", root])
    shown = capsys.readouterr().out
    assert "Trained(version=1" in shown and "high" in shown and "target_seconds" in shown
    assert current_view(spark, Layout(root).gold, schemas.gold()).count() == 120
    main(["compact", "--root", root])
    # All rows are years old by now, hence past retention.
    assert current_view(spark, Layout(root).gold, schemas.gold()).count() == 0


def test_tasks_do_not_need_the_package(tmp_path):
    """A session started elsewhere, with the package importable on the driver only."""
    repo = Path(__file__).resolve().parent.parent
    script = tmp_path / "elsewhere.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {str(repo)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = (SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false')\n"
        "         .config('spark.sql.shuffle.partitions', '4')\n"
        f"         .config('spark.checkpoint.dir', {str(tmp_path / 'shared')!r}).getOrCreate())\n"
        "import __spark_entry__ as contract\n"
        "print('rows', contract.queries()['forest_scores'](spark, '/root/testdata/sf0.001').count())\n"
    )
    ours = ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")
    env = {k: v for k, v in os.environ.items() if k not in ours}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows 960" in done.stdout, done.stderr[-2000:]


def test_rolling_features_evaluate_their_input_once(spark):
    """The records are built, checked and made unique once; the totals read four columns of the result."""
    plan = QUERIES["gold_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "events.parquet" not in plan and "from_json" not in plan and len(read) == 2
    narrow = min(read, key=len)
    assert {c.split(":")[0] for c in narrow.split(",")} == {"transaction_id", "customer_id", "amount", "transaction_time"}
