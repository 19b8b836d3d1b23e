import math
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from rows import node_lines, silver

from txnrisk.config import RiskConfig
from txnrisk.operators.rolling import Trailing, trailing_stats, with_trailing_stats
from txnrisk.plans import gold

CFG = RiskConfig()


def frame(spark, rows):
    return spark.createDataFrame(
        [(f"t{i}", c, s, float(a)) for i, (c, s, a) in enumerate(rows)], "id string, c string, sec bigint, amount double"
    )


def rolled(df, count_s, moment_s, tile=None):
    out = with_trailing_stats(
        df, "c", "sec", counted="id", counts=[Trailing("n", count_s)], value="amount",
        moments=[Trailing("a", moment_s)], tile=tile,
    )
    return {r.id: (r.n, r.a_mean, r.a_stddev) for r in out.collect()}


def brute(rows, count_s, moment_s):
    out = {}
    for i, (c, s, _) in enumerate(rows):
        n = sum(1 for c2, s2, _ in rows if c2 == c and s - count_s <= s2 <= s)
        near = [a for c2, s2, a in rows if c2 == c and s - moment_s <= s2 <= s]
        out[f"t{i}"] = (n, float(np.mean(near)), float(np.std(near, ddof=1)) if len(near) > 1 else None)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for key, (n, mean, sd) in want.items():
        assert got[key][0] == n, key
        assert math.isclose(got[key][1], mean, rel_tol=1e-12, abs_tol=1e-9), key
        if sd is None:
            assert got[key][2] is None
        else:
            assert math.isclose(got[key][2], sd, rel_tol=1e-9, abs_tol=1e-7), key


def test_window_edges_and_peers(spark):
    rows = silver(spark, *[{"sec": s} for s in (0, 3600, 3601, 3601)])
    got = {r.transaction_id: r.velocity_1h for r in gold.velocity(rows, CFG).collect()}
    assert got == {"T0": 1, "T1": 2, "T2": 3, "T3": 3}


def test_zscore_is_zero_without_spread(spark):
    rows = silver(spark, *[{"sec": s, "amount": 0.1} for s in range(5)], {"sec": 9, "customer_id": "C2"})
    assert {r.amount_zscore for r in gold.features(rows, CFG).collect()} == {0.0}


def test_small_spread_far_from_the_mean_of_other_windows(spark):
    """Two near-equal payments, then large ones: no digits may be lost to the later sums."""
    week = CFG.baseline_seconds
    rows = [("c", 0, 100.00), ("c", 1, 100.01)] + [("c", week - 5 + i, 49_999.99) for i in range(50)]
    rows += [("c", 2 * week, 100.00), ("c", 2 * week + 1, 100.01)]
    same(rolled(frame(spark, rows), 60, week), brute(rows, 60, week))


def test_microsecond_times_floor_to_seconds(spark):
    rows = silver(spark, {"sec": 0.999999}, {"sec": 3600.5})
    got = {r.transaction_id: r.velocity_1h for r in gold.velocity(rows, CFG).collect()}
    assert got == {"T0": 1, "T1": 2}


def test_burst(spark):
    rows = silver(spark, *[{"sec": 6 * i} for i in range(11)], {"sec": 500})
    got = {r.transaction_id: (r.velocity_60s, r.is_burst) for r in gold.bursts(rows, CFG).collect()}
    assert got["T8"] == (9, False) and got["T9"] == (10, True) and got["T10"] == (11, True) and got["T11"] == (1, False)


@pytest.mark.parametrize("tile", [1, 7, 50, 1000, None])
def test_any_tile_length_gives_the_same(spark, tile):
    rng = np.random.default_rng(3)
    rows = [(f"c{rng.integers(3)}", int(rng.integers(-200, 200)), round(float(rng.uniform(0.01, 500)), 2)) for _ in range(300)]
    same(rolled(frame(spark, rows), 13, 50, tile), brute(rows, 13, 50))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b"]),
            st.integers(-(10**6), 10**6),
            st.integers(1, 5_000_000).map(lambda cents: cents / 100),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_equals_brute_force(spark, rows):
    same(rolled(frame(spark, rows), 3600, 604_800), brute(rows, 3600, 604_800))


def hot(spark, n=60_000):
    """A third of the rows belong to one customer, and a third of those fall in one second."""
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("t"), i).alias("id"),
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), i % 997)).alias("c"),
        F.when(i % 9 == 0, F.lit(1_000_000)).otherwise(i * 37 % 2_000_000).alias("sec"),
        (i * 7919 % 50_000 / 100 + 0.01).alias("amount"),
    )


def test_hot_customer_equals_plain_windows(spark):
    df = hot(spark, 20_000)
    w = Window.partitionBy("c").orderBy("sec")
    plain = df.select(
        "id",
        F.count("id").over(w.rangeBetween(-3600, 0)).alias("n0"),
        F.avg("amount").over(w.rangeBetween(-604_800, 0)).alias("m0"),
        F.stddev_samp("amount").over(w.rangeBetween(-604_800, 0)).alias("s0"),
    )
    tiled = with_trailing_stats(
        df, "c", "sec", counted="id", counts=[Trailing("n", 3600)], value="amount", moments=[Trailing("a", 604_800)]
    )
    bad = tiled.join(plain, "id").where(
        "n <> n0 or abs(a_mean - m0) > 1e-7 or abs(coalesce(a_stddev, -1) - coalesce(s0, -1)) > 1e-6"
    )
    assert tiled.count() == 20_000
    assert bad.count() == 0


def test_no_task_holds_a_hot_customer(spark):
    df = hot(spark)
    stats = trailing_stats(
        df, "c", "sec", counted="id", counts=[Trailing("n", 3600)], value="amount", moments=[Trailing("a", 604_800)]
    )
    plan = "\n".join(node_lines(stats))
    # One window pass over (customer, tile), fed by partial sums per (customer, second).
    assert len(re.findall(r"\bWindow \[", plan)) == 1
    assert re.search(r"hashpartitioning\(c#\d+, _tile", plan)
    assert re.search(r"hashpartitioning\(c#\d+, sec", plan)
    assert not re.search(r"hashpartitioning\(c#\d+L?, \d+\)", plan)
    assert "partial_sum" in plan
    # A tile of one customer has at most one record per second, however many rows it has.
    per_group = df.select("c", "sec").distinct().groupBy("c", F.floor(F.col("sec") / 1_209_600)).count()
    assert per_group.agg(F.max("count")).first()[0] <= 1_209_600


def test_results_do_not_depend_on_partitioning(spark):
    df = hot(spark, 5_000)
    spec = dict(counted="id", counts=[Trailing("n", 60)], value="amount", moments=[Trailing("a", 604_800)])
    one = with_trailing_stats(df.repartition(1), "c", "sec", **spec)
    many = with_trailing_stats(df.repartition(13, "amount"), "c", "sec", **spec)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
