from rows import at

from txnrisk.streaming.dedupe import deduplicated_stream

SCHEMA = "transaction_id string, transaction_time timestamp"


def test_repeats_and_late_rows_are_dropped(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def arrive(*rows):
        df = spark.createDataFrame([(k, at(s)) for k, s in rows], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        query = (
            deduplicated_stream(stream)
            .writeStream.format("parquet")
            .option("checkpointLocation", check)
            .trigger(availableNow=True)
            .start(out)
        )
        query.awaitTermination()
        return query

    arrive(("a", 0), ("a", 5), ("b", 10), (None, 20))
    arrive(("a", 300), ("c", 4000))
    # The watermark stands at 4000 - 600 seconds now.
    last = arrive(("late", 100), ("d", 3500), ("c", 4100))
    got = sorted(r.transaction_id for r in spark.read.schema(SCHEMA).parquet(out).collect())
    assert got == ["a", "b", "c", "d"]
    dropped = sum(op.numRowsDroppedByWatermark for p in last.recentProgress for op in p.stateOperators)
    assert dropped == 1
