from rows import bronze, node_lines, record
from pyspark.sql import functions as F

from txnrisk.operators.keyed import first_per_key, latest_per_key, upsert


def test_first_arrival_wins(spark):
    rows = bronze(spark, record(amount=5.0, offset=5), record(amount=3.0, offset=3))
    assert [r.offset for r in first_per_key(rows, "transaction_id", ("partition", "offset")).collect()] == [3]


def test_rows_without_key_are_never_merged_into_one(spark):
    rows = bronze(spark, record(transaction_id=None), record(transaction_id=None))
    assert first_per_key(rows, "transaction_id", ("partition", "offset")).count() == 0


def test_copies_of_one_key_shrink_before_the_shuffle(spark):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    kept = first_per_key(rows, "k", ("id",))
    lines = node_lines(kept)
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(k" in line)
    assert any(i > exchange and "Partial" in lines[i] for i in limits)
    assert kept.count() == spark.range(100_000).where("id % 3 <> 0").count() + 1
    assert kept.where("k = 'hot'").first().id == 0


def test_upsert_updates_inserts_and_keeps(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "transaction_id string, amount int")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "transaction_id string, amount int")
    once = upsert(old, new, "transaction_id")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 20), ("c", 30)]
    again = upsert(once, new, "transaction_id")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_latest_version(spark):
    log = spark.createDataFrame([("a", 1, 0), ("a", 2, 3), ("b", 5, 1)], "k string, x int, v int")
    assert sorted(map(tuple, latest_per_key(log, "k", "v").collect())) == [("a", 2, 3), ("b", 5, 1)]
