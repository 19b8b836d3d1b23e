from collections import defaultdict

from llm.rows import documents, empty, plain
from pyspark.sql import functions as F

from txnrisk.llm import lines, mixing


def test_targets_follow_weights_and_stop_at_the_limit(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), (None, 1000), ("z", 0)], "source string, source_size long")
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0), (None, 2.0), ("z", 5.0)], "source string, weight double")
    got = {r["source"]: r["target"] for r in plain(mixing.source_targets(sizes, weights, 1.5, 2.0))}
    assert got == {"a": 200.0, "b": 20.0, "z": 0.0, None: 1445.0}


def test_every_row_is_kept_and_copies_follow_the_rate(spark):
    docs = documents(spark)
    mixed = plain(mixing.mix_sources(docs, mixing.cyclic_weights(docs)))
    assert len(mixed) == docs.count()
    again = plain(mixing.mix_sources(docs.repartition(7), mixing.cyclic_weights(docs)))
    key = lambda r: (str(r["doc_id"]), str(r["text"]), r["size"], r["copies"])
    assert sorted(map(key, mixed)) == sorted(map(key, again))
    by = defaultdict(int)
    for r in mixed:
        assert r["size"] == len((r["text"] or "").split(None)) or not (r["text"] or "").isascii()
        assert int(r["rate"]) <= r["copies"] <= int(r["rate"]) + 1 and r["copies"] <= 2
        by[r["source"]] += r["size"]
    assert all(r["source_size"] == by[r["source"]] for r in mixed)
    emitted = mixing.emit_copies(mixing.mix_sources(docs, mixing.cyclic_weights(docs)))
    assert emitted.count() == sum(r["copies"] for r in mixed)


def test_a_source_comes_near_its_target(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("one two three").alias("text"), (F.col("id") % 3).cast("string").alias("source")
    )
    mixed = mixing.mix_sources(docs, mixing.cyclic_weights(docs))
    for r in mixed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n"), F.max("target").alias("t")).collect():
        assert abs(r["n"] - r["t"]) < 0.08 * r["t"]


def test_empty_table(spark):
    docs = empty(spark)
    assert mixing.mix_sources(docs, mixing.cyclic_weights(docs)).count() == 0
    assert lines.drop_lines(docs).count() == 0


def test_large_facts_are_joined_by_shuffle(spark, monkeypatch):
    from txnrisk.llm import common

    docs = documents(spark)
    one = sorted(str(r) for r in lines.drop_lines(docs, ratio=0.05).collect())
    monkeypatch.setattr(common, "small", lambda *_: False)
    assert one == sorted(str(r) for r in lines.drop_lines(docs, ratio=0.05).collect())


def test_lines_on_many_pages_of_a_host_go(spark):
    rows = [(i, f"  Home \nline {i}\n\n{'News' if i < 3 else 'x' + str(i)}\r", "h") for i in range(10)]
    rows += [(20 + i, "Home\nNews", None) for i in range(2)] + [(30, None, "h"), (31, "", "h"), (32, "Home", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in plain(lines.drop_lines(docs, ratio=0.25, min_pages=3, counts=True))}
    assert got[5]["text"] == "line 5\n\nx5\r" and got[5]["n_dropped"] == 1 and got[5]["n_lines"] == 4
    assert got[0]["text"] == "line 0\n\nNews\r"  # on 3 of 13 pages
    assert got[20]["text"] == "Home\nNews"  # too few pages with it
    assert got[30]["text"] is None and got[31]["text"] == "" and got[32]["text"] == ""
    assert len(got) == len(rows)
