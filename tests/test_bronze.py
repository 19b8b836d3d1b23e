from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import envelope, node_lines, record

from txnrisk.plans import bronze
from txnrisk.schemas import RECORD


def test_malformed_and_mistyped_messages_are_quarantined_with_their_text(spark):
    mistyped = '{"transaction_id":"T2","customer_id":"C1","amount":"x"}'
    rows = bronze.parsed(envelope(spark, [record(), "{bad", mistyped]), 7)
    assert [r.transaction_id for r in bronze.accepted(rows).collect()] == ["T1"]
    kept = {r.offset: r.raw_value for r in bronze.quarantined(rows).collect()}
    assert kept == {1: "{bad", 2: mistyped}
    assert "raw_value" not in bronze.accepted(rows).columns


def test_null_ids_are_all_quarantined(spark):
    rows = bronze.parsed(envelope(spark, [record(transaction_id=None), record(transaction_id=None)]), 0)
    assert bronze.accepted(rows).count() == 0
    assert bronze.quarantined(rows).count() == 2


def test_metrics(spark):
    messages = [record(is_fraud=True), record(), record(), record(amount=None), "{"]
    got = bronze.batch_metrics(bronze.parsed(envelope(spark, messages), 3)).first()
    assert (got.n_rows, got.n_valid, got.n_quarantined) == (5, 3, 2)
    assert abs(got.fraud_rate - 1 / 3) < 1e-12


def test_stamp_types(spark):
    kinds = dict(bronze.parsed(envelope(spark, [record()]), 2**40).dtypes)
    assert kinds["batch_id"] == "bigint" and kinds["ingested_at"] == "timestamp"


def test_a_widened_schema_keeps_new_fields(spark):
    wide = T.StructType(RECORD.fields + [T.StructField("device", T.StringType())])
    rows = bronze.parsed(envelope(spark, [record(device="phone"), record()]), 0, wide)
    assert [r.device for r in rows.orderBy("offset").collect()] == ["phone", None]


def test_each_message_is_parsed_once(spark):
    rows = bronze.parsed(envelope(spark, [record()]).repartition(2), 0)
    for part in (bronze.accepted(rows), bronze.quarantined(rows), bronze.batch_metrics(rows)):
        assert "\n".join(node_lines(part)).count("from_json") == 1


def test_a_message_without_value_is_quarantined(spark):
    empty = envelope(spark, [record()]).withColumn("value", F.lit(None).cast("binary"))
    rows = bronze.quarantined(bronze.parsed(empty, 0)).collect()
    assert len(rows) == 1 and rows[0].transaction_id is None and rows[0].raw_value is None


def test_a_backfilled_file_with_an_old_time_is_read(spark, tmp_path):
    import os
    import time
    from datetime import datetime

    from txnrisk.config import RiskConfig
    from txnrisk.schemas import QUEUE
    from txnrisk.sources.queue import queue_files

    folder, out, seen = tmp_path / "in", str(tmp_path / "out"), set()
    for name, days in ((b"new", 0), (b"old", 15)):
        row = (b"k", name, "t", 0, 1, datetime.now(), 0)
        spark.createDataFrame([row], QUEUE).coalesce(1).write.mode("append").parquet(str(folder))
        for file in set(folder.glob("part-*")) - seen:
            seen.add(file)
            os.utime(file, (time.time() - days * 86400,) * 2)
        stream = queue_files(spark, str(folder), RiskConfig()).writeStream.format("parquet").option("path", out)
        stream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(bytes(r.value) for r in spark.read.parquet(out).collect()) == [b"new", b"old"]
