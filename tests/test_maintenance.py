from pyspark.sql import functions as F
from rows import at, silver, START

from txnrisk import schemas
from txnrisk.operators.monitor import layer_latency
from txnrisk.sinks.maintenance import compact, drop_partitions, expired_up_to, retained
from txnrisk.sinks.upsert import upsert_batch
from txnrisk.sources.tables import LOG_ID, current_view, log_path, scan_tree, snapshot_path

DAY = 86_400


def test_retention_edge(spark):
    rows = silver(spark, {"sec": 0}, {"sec": DAY}, {"sec": 8 * DAY})
    kept = retained(rows, at(8 * DAY), 7)
    assert sorted(r.transaction_id for r in kept.collect()) == ["T1", "T2"]


def test_retention_is_pushed_to_the_scan(spark, tmp_path):
    silver(spark, {}).write.parquet(str(tmp_path / "s"))
    kept = retained(spark.read.parquet(str(tmp_path / "s")), "2024-01-31 00:00:00", 7)
    assert "GreaterThanOrEqual(transaction_time" in kept._jdf.queryExecution().executedPlan().toString()


def test_compaction_with_retention_and_log_clean_up(spark, tmp_path):
    table = str(tmp_path / "silver")
    upsert_batch(silver(spark, {"sec": 0}, {"sec": 20 * DAY}), table, 0)
    upsert_batch(silver(spark, {"sec": 21 * DAY, "transaction_id": "T1", "amount": 7.0}), table, 1)
    assert compact(spark, table, schemas.silver(), as_of=at(30 * DAY), days=15) == 1
    assert [(r.transaction_id, r.amount) for r in current_view(spark, table, schemas.silver()).collect()] == [("T1", 7.0)]

    upsert_batch(silver(spark, {"sec": 22 * DAY, "transaction_id": "T5"}), table, 2)
    assert drop_partitions(spark, log_path(table), LOG_ID, up_to=1) == [0, 1]
    assert sorted(r.transaction_id for r in current_view(spark, table, schemas.silver()).collect()) == ["T1", "T5"]
    assert compact(spark, table, schemas.silver()) == 2
    assert current_view(spark, table, schemas.silver()).count() == 2


def test_an_older_version_does_not_come_back_through_a_time_limit(spark, tmp_path):
    table = str(tmp_path / "silver")
    upsert_batch(silver(spark, {"sec": 0}), table, 0)
    upsert_batch(silver(spark, {"sec": 9 * DAY}), table, 1)
    first = int(START.timestamp())
    early = (first, first + DAY)
    assert current_view(spark, table, schemas.silver(), seconds=early).count() == 0
    compact(spark, table, schemas.silver())
    upsert_batch(silver(spark, {"sec": 1}), table, 2)
    assert current_view(spark, table, schemas.silver(), seconds=early).count() == 1
    late = (first + 9 * DAY, first + 9 * DAY)
    assert current_view(spark, table, schemas.silver(), seconds=late).count() == 0


def test_time_limits_prune_snapshot_days(spark, tmp_path):
    table = str(tmp_path / "silver")
    upsert_batch(silver(spark, *[{"sec": d * DAY} for d in range(10)]), table, 0)
    compact(spark, table, schemas.silver())
    first = int(START.timestamp())
    view = current_view(spark, table, schemas.silver(), seconds=(first + 3 * DAY, first + 4 * DAY))
    assert view.count() == 2
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_day" in plan
    assert "GreaterThanOrEqual(transaction_time" in plan
    assert len(spark.read.parquet(snapshot_path(table)).select("event_day").distinct().collect()) == 10


def test_expired_batches(spark):
    rows = spark.createDataFrame([(0, at(0)), (1, at(DAY)), (1, at(9 * DAY)), (2, at(0))], "batch_id bigint, ingested_at timestamp")
    assert expired_up_to(rows, at(10 * DAY), 7) == 0
    assert expired_up_to(rows, at(30 * DAY), 7) == 2
    assert expired_up_to(rows, at(1 * DAY), 7) is None


def test_tree_scan_by_name(spark, tmp_path):
    path = str(tmp_path / "tree")
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(f"{path}/one")
    spark.createDataFrame([("y", 2.5)], "b string, c double").write.parquet(f"{path}/deep/er/two")
    want = [(None, "y", 2.5), (1, "x", None)]
    assert sorted(map(tuple, scan_tree(spark, path).select("a", "b", "c").collect()), key=str) == sorted(want, key=str)
    typed = scan_tree(spark, path, spark.createDataFrame([], "a int, b string, c double").schema)
    assert sorted(map(tuple, typed.collect()), key=str) == sorted(want, key=str)


def test_latency_report(spark):
    rows = silver(spark, *[{"offset": i} for i in range(20)]).withColumns(
        {
            "ingested_at": F.timestamp_micros(F.unix_micros("kafka_timestamp") + 1_000_000),
            "silver_processed_at": F.timestamp_micros(F.unix_micros("kafka_timestamp") + F.col("offset") * 2_000_000),
            "gold_processed_at": F.timestamp_micros(F.unix_micros("kafka_timestamp") + 119_999_999),
        }
    )
    got = {r.layer: r for r in layer_latency(rows).collect()}
    assert (got["bronze"].max_seconds, got["bronze"].n_late, got["bronze"].breached) == (1.0, 0, False)
    assert (got["silver"].p50_seconds, got["silver"].n_late, got["silver"].breached) == (18.0, 5, True)
    assert (got["gold"].target_seconds, got["gold"].n_late) == (120.0, 0)
