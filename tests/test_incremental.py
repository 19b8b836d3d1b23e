"""What incremental jobs read and rewrite: intervals, key buckets, touched days."""

import re

import pytest
from pyspark.sql import functions as F
from rows import START, at, bronze, node_lines, record, silver

from txnrisk import schemas
from txnrisk.config import Layout, RiskConfig
from txnrisk.operators.intervals import islands, within
from txnrisk.plans import gold
from txnrisk.sinks.maintenance import clean_days, compact
from txnrisk.sinks.upsert import upsert_batch
from txnrisk.sources.tables import (
    LOG_ID,
    current_view,
    key_runs_path,
    keys_path,
    log_path,
    lookup,
    numbers,
    path_exists,
    positions,
    ranges,
    read_log,
    snapshot_index_path,
    snapshot_manifest,
    snapshot_path,
)
from txnrisk.streaming import layers

CFG = RiskConfig()
DAY = 86_400
FIRST_DAY = int(START.timestamp()) // DAY


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "layers"))


def txn(i, sec=0, **over):
    return record(transaction_id=f"T{i}", transaction_time=at(sec).isoformat(), offset=i, **over)


def feed(spark, layout, rows, i, cfg=CFG):
    layers.silver_batch(layout, cfg)(bronze(spark, *rows), i)
    layers.gold_batch(layout, cfg)(read_log(spark, layout.silver, schemas.silver()).where(F.col(LOG_ID) == i), i)


def gold_rows(spark, layout):
    rows = current_view(spark, layout.gold, schemas.gold())
    return {r.transaction_id: (r.customer_id, r.amount, r.velocity_1h, r.amount_zscore) for r in rows.collect()}


def recomputed(spark, layout):
    rows = gold.features(current_view(spark, layout.silver, schemas.silver()), CFG)
    return {r.transaction_id: (r.customer_id, r.amount, r.velocity_1h, r.amount_zscore) for r in rows.collect()}


def test_islands(spark):
    points = [("a", 0), ("a", 10), ("a", 21), ("a", 31), ("a", 32), ("b", 5), ("a", 100), (None, 7), ("a", -15), ("a", -4)]
    df = spark.createDataFrame(points, "c string, s bigint")
    got = {tuple(r) for r in islands(df, "c", "s", 10).collect()}
    assert got == {("a", -15, -15), ("a", -4, 10), ("a", 21, 32), ("a", 100, 100), ("b", 5, 5), (None, 7, 7)}


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_rows_within_any_interval_once(spark, max_rows):
    rows = spark.range(-200, 400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("s"), F.lit("a").alias("c"))
    spans = [("a", 0, 5), ("a", 8, 8), ("a", 100, 220), ("b", -200, 400), ("a", -150, -150)]
    df = spark.createDataFrame(spans, "c string, first_sec bigint, last_sec bigint")
    got = within(rows, F.col("s"), df, "c", before=3, after=7, tile=10, spread_by="k", max_rows=max_rows, salts=3)
    want = [s for s in range(-200, 400) if any(a - 3 <= s <= b + 7 for c, a, b in spans if c == "a")]
    assert sorted(r.s for r in got.collect()) == want and got.columns == rows.columns


def test_two_distant_changes_rewrite_what_they_affect(spark, layout):
    feed(spark, layout, [txn(i, i * DAY, amount=10.0 + i) for i in range(60)], 0)
    feed(spark, layout, [txn(100, 5, amount=1.0), txn(101, 59 * DAY - 5, amount=2.0)], 1)
    written = read_log(spark, layout.gold, schemas.gold()).where(F.col(LOG_ID) == 1)
    # The first is in the frames of days 1 to 7, the second in that of day 59.
    assert sorted(int(r.transaction_id[1:]) for r in written.collect()) == [*range(1, 8), 59, 100, 101]
    assert gold_rows(spark, layout) == recomputed(spark, layout)


def test_a_row_of_1970_does_not_open_the_scan(spark, layout):
    rows = [{"sec": d * DAY, "customer_id": "A", "transaction_id": f"A{d}"} for d in range(40)]
    upsert_batch(silver(spark, *rows), layout.silver, 0)
    compact(spark, layout.silver, schemas.silver())
    changed = silver(spark, {"sec": -(54 * 365) * DAY, "customer_id": "B"}, {"sec": 39 * DAY, "customer_id": "A"})
    spans = gold.touched_spans(gold.places(changed), CFG)
    days = gold.days_in_reach(spans, CFG)
    assert len(days) == 2 and days[1] == (FIRST_DAY + 32, FIRST_DAY + 46) and days[0][1] < FIRST_DAY - 10_000
    view = current_view(spark, layout.silver, schemas.silver(), narrow=lambda r: gold.in_reach(r, spans, CFG), days=days)
    assert sorted(r.transaction_id for r in view.collect()) == [f"A{d}" for d in range(32, 40)]
    scans = [x for x in node_lines(view) if "Scan parquet" in x and "snapshot" in x]
    kept = {int(d) for x in scans for part in re.findall(r"event_day#\d+L? IN \(([\d,]+)\)", x) for d in part.split(",")}
    assert kept == set(range(FIRST_DAY + 32, FIRST_DAY + 40))


def test_a_lookup_reads_its_buckets_alone(spark, layout):
    n = 200
    for batch in range(3):
        upsert_batch(silver(spark, *[{"transaction_id": f"K{batch}-{i}", "sec": i} for i in range(n)]), layout.gold, batch)
    keys = spark.createDataFrame([("K1-7",), ("K2-9",), (None,)], "transaction_id string")
    found = lookup(spark, layout.gold, keys)
    assert sorted((r.transaction_id, r[LOG_ID], r.event_sec - int(START.timestamp())) for r in found.collect()) == [("K1-7", 1, 7), ("K2-9", 2, 9)]
    plan = "\n".join(node_lines(found))
    assert "Exchange" not in plan and re.search(r"PartitionFilters: \[.*key_bucket", plan) and "PushedFilters: [In(transaction_id" in plan
    many = spark.createDataFrame([(f"K1-{i}",) for i in range(0, n, 2)], "transaction_id string")
    assert lookup(spark, layout.gold, many).count() == n / 2


def test_a_gold_batch_shuffles_no_key_of_the_log(spark, layout):
    """Only index rows of the keys in reach are moved to find their newest versions."""
    upsert_batch(silver(spark, *[{"sec": d * DAY, "customer_id": f"C{d % 5}"} for d in range(50)]), layout.silver, 0)
    upsert_batch(silver(spark, {"transaction_id": "T3", "sec": 3 * DAY + 1, "customer_id": "C3"}), layout.silver, 1)
    changed = silver(spark, {"sec": 3 * DAY, "customer_id": "C3"})
    spans = gold.touched_spans(gold.places(changed), CFG)
    view = current_view(spark, layout.silver, schemas.silver(), narrow=lambda r: gold.in_reach(r, spans, CFG), days=gold.days_in_reach(spans, CFG))
    got = {r.transaction_id: r.transaction_time.second for r in view.collect()}
    assert got == {"T3": 1, "T8": 0}
    plan = "\n".join(node_lines(view))
    logs = [x for x in plan.splitlines() if "Scan parquet" in x and "/log]" in x.replace("/log,", "/log]")]
    assert all("event_day" in x.split("PartitionFilters")[1].split("PushedFilters")[0] for x in logs)
    for x in plan.splitlines():
        if "Scan parquet" in x and "key_bucket" in x:
            assert "In(transaction_id" in x


def test_positions_are_of_the_latest_version(spark, layout):
    upsert_batch(silver(spark, {"transaction_id": "X", "sec": 1}, {"transaction_id": "Y", "sec": 2}), layout.gold, 0)
    upsert_batch(silver(spark, {"transaction_id": "X", "sec": 90, "customer_id": "C9"}), layout.gold, 1)
    keys = spark.createDataFrame([("X",), ("Y",), ("Z",)], "transaction_id string")
    base = int(START.timestamp())
    want = {("C9", base + 90), ("C1", base + 2)}
    assert {tuple(r) for r in positions(spark, layout.gold, keys).collect()} == want
    compact(spark, layout.gold, schemas.silver())
    assert {tuple(r) for r in positions(spark, layout.gold, keys).collect()} == want
    assert path_exists(spark, f"{key_runs_path(layout.gold)}/covered_batch_id=1")


def test_a_change_of_one_day_rewrites_one_day(spark, layout):
    table = layout.silver
    upsert_batch(silver(spark, *[{"sec": d * DAY} for d in range(10)]), table, 0)
    assert compact(spark, table, schemas.silver()) == 0 and compact(spark, table, schemas.silver()) == 0
    upsert_batch(silver(spark, {"transaction_id": "T4", "sec": 4 * DAY + 9}, {"transaction_id": "N", "sec": 4 * DAY}), table, 1)
    assert compact(spark, table, schemas.silver()) == 1
    manifest = snapshot_manifest(spark, table)
    assert {d - FIRST_DAY: v for d, v in manifest.days.items()} == {d: int(d == 4) for d in range(10)}
    # A key that moves away leaves its day, here an empty one.
    upsert_batch(silver(spark, {"transaction_id": "T7", "sec": 2 * DAY}), table, 2)
    compact(spark, table, schemas.silver())
    manifest = snapshot_manifest(spark, table)
    assert {d - FIRST_DAY: v for d, v in manifest.days.items()} == {0: 0, 1: 0, 2: 2, 3: 0, 4: 1, 5: 0, 6: 0, 8: 0, 9: 0}
    want = {f"T{d}": d for d in range(10)} | {"N": 4, "T7": 2}
    view = current_view(spark, table, schemas.silver())
    assert {r.transaction_id: (r.transaction_time - START.replace(tzinfo=None)).days for r in view.collect()} == want
    assert clean_days(spark, snapshot_path(table), snapshot_index_path(table), keep=1) == 3
    assert sum(len(numbers(spark, f"{snapshot_path(table)}/event_day={d}", "day_version=")) for d in manifest.days) == 9
    assert {r.transaction_id for r in current_view(spark, table, schemas.silver()).collect()} == set(want)


def test_a_batch_appears_whole_and_is_replaced_whole(spark, layout):
    upsert_batch(silver(spark, {"sec": 0}, {"sec": DAY}), layout.silver, 3)
    upsert_batch(silver(spark, {"sec": DAY, "transaction_id": "T1"}), layout.silver, 3)
    assert [r.transaction_id for r in read_log(spark, layout.silver, schemas.silver()).collect()] == ["T1"]
    assert numbers(spark, log_path(layout.silver), f"{LOG_ID}=") == [3] == numbers(spark, keys_path(layout.silver), f"{LOG_ID}=")
    assert not numbers(spark, f"{log_path(layout.silver)}/_pending", f"{LOG_ID}=")


def test_ranges():
    assert ranges({5, 1, 2, 3, 9, 8}) == [(1, 3), (5, 5), (8, 9)] and ranges(set()) == []


def test_a_large_refresh_is_never_broadcast_whatever_its_spans_are_guessed_at(spark):
    """The planner sees few bytes of spans, not the tiles and salts that they are multiplied by."""
    cfg = RiskConfig(broadcast_rows=0)
    rows = silver(spark, *[{"sec": s * DAY, "customer_id": f"C{s % 3}"} for s in range(20)])
    spans = gold.touched_spans(gold.places(rows), cfg).persist()
    try:
        spans.count()
        reached = gold.in_reach(rows, spans, cfg)
        assert reached.count() == 20
        assert not any("Broadcast" in x for x in node_lines(reached))
    finally:
        spans.unpersist()


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_rows_in_reach_tell_which_are_affected(spark, max_rows):
    rows = spark.range(-50, 100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("s"), F.lit("a").alias("c"))
    spans = [("a", 0, 5), ("a", 8, 8), ("a", 40, 41), (None, 60, 60)]
    df = spark.createDataFrame(spans, "c string, first_sec bigint, last_sec bigint")
    got = within(rows, F.col("s"), df, "c", before=9, after=7, tile=10, spread_by="k", max_rows=max_rows, salts=3, mark=("hit", 0))
    want = {s: any(a <= s <= b + 7 for _, a, b in spans[:3]) for s in range(-50, 100) if any(a - 9 <= s <= b + 7 for _, a, b in spans[:3])}
    found = [(r.s, r.hit) for r in got.collect()]
    assert dict(found) == want and len(found) == len(want)


def test_many_versions_read_the_index_without_their_keys(spark, layout, monkeypatch):
    """Many rows are worked out once to be counted and once to be returned; the newest version wins all the same."""
    from txnrisk.sources import tables

    monkeypatch.setattr(tables, "MOST_BROADCAST", 3)
    upsert_batch(silver(spark, *[{"sec": d * DAY} for d in range(10)]), layout.silver, 0)
    upsert_batch(silver(spark, {"transaction_id": "T3", "sec": 4 * DAY}, {"transaction_id": "T5", "sec": 40 * DAY}), layout.silver, 1)
    view = current_view(spark, layout.silver, schemas.silver(), days=[(FIRST_DAY, FIRST_DAY + 20)])
    base = START.replace(tzinfo=None)
    assert {r.transaction_id: (r.transaction_time - base).days for r in view.collect()} == {
        **{f"T{d}": d for d in range(10) if d != 5}, "T3": 4
    }
    assert sum("Scan parquet" in x for x in node_lines(view)) == 2 * (1 + any("Initial Plan" in x for x in node_lines(view)))


def test_days_are_stored_before_they_are_dealt_by_ranges(spark, layout, monkeypatch):
    """Finding the ranges reads the rows once more, so what is dealt is a stored table, and it is gone afterwards."""
    from txnrisk.sinks import maintenance

    kept = []
    real = maintenance.staged
    monkeypatch.setattr(maintenance, "staged", lambda df, label: kept.append(label) or real(df, label))
    upsert_batch(silver(spark, {"sec": 0}, {"sec": DAY}), layout.silver, 0)
    compact(spark, layout.silver, schemas.silver())
    assert kept == ["days"] and current_view(spark, layout.silver, schemas.silver()).count() == 2


def event_rows(spark, n, step):
    """Rows of the events table, ``step`` seconds apart, in four files."""
    second = F.lit(int(START.timestamp())) + F.col("id") * step
    return spark.range(0, n, 1, 4).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(second).cast("timestamp_ntz").alias("ts"), (F.col("id") % 3).alias("user_id"),
        F.lit("x").alias("event_type"), F.lit(1.5).alias("value"), F.lit("").alias("props"),
    )


def test_arrivals_are_read_from_their_own_partitions(spark, tmp_path):
    from txnrisk.plans import catalog

    event_rows(spark, 30, DAY).write.parquet(f"{tmp_path}/events.parquet")
    rows = catalog._stored_arrivals(spark, str(tmp_path))
    for batch, n in ((0, 10), (1, 10), (2, 10)):
        part = catalog._arrival(rows, batch)
        assert part.count() == n and any("PartitionFilters: [isnotnull(batch_id" in x for x in node_lines(part))


def test_a_fifth_of_the_queue_is_one_micro_batch_however_many_files_it_has(spark, tmp_path):
    from txnrisk.plans import catalog
    from txnrisk.streaming.metrics import read_metrics

    event_rows(spark, 340, 3600).write.parquet(f"{tmp_path}/events.parquet")
    layout = catalog._late_streams(spark, str(tmp_path))
    files = spark.read.parquet(layout.bronze).select("batch_id", F.input_file_name()).distinct().groupBy("batch_id").count()
    assert max(r[1] for r in files.collect()) > 1
    seen = read_metrics(spark, layout.stream_metrics).where("name = 'n_rows' and value is not null")
    assert {r[0]: r[1] for r in seen.groupBy("layer").agg(F.countDistinct("micro_batch")).collect()} == {"bronze": 5, "silver": 5}
    late = {i for i in range(340) if i % 17 == 5 and i * 5 // 340 < 3}
    passed = {r[0] for r in current_view(spark, layout.silver, schemas.silver()).select("offset").collect()}
    assert not late & passed and len(passed) > 250
    # Rows of the fourth fifth that come with the last are not late yet: the watermark lags a micro-batch with data.
    assert any(i % 17 == 5 and i * 5 // 340 == 3 for i in passed)
