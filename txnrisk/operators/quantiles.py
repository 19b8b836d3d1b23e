"""Exact percentiles with linear interpolation, without gathering the values anywhere."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.session import staged

#: Size of the sketch that tells where to look, some 30 KB, and twice its error in rank at 99 % confidence.
SKETCH_K = 1024
SKETCH_MARGIN = 2 * 2.296 / SKETCH_K**0.9021
# Sketches of the tasks are merged in this many groups first.
SKETCH_GROUPS = 64


def exact_percentiles(df: DataFrame, column: str, fractions: list[float], bins: int = 4096) -> list[float | None]:
    """Percentiles of a numeric column; nulls are ignored, and no rows give ``None`` each.

    The column is scanned twice. The first scan counts, and gathers a mergeable sketch, from which the
    surroundings of every wanted rank follow. The second counts the values below and between these
    surroundings, and each distinct value within them; the latter, a few per cent of the values, are
    written aside. There each rank is closed in on: a pass counts rows per equal-width bin (at most
    ``bins`` per open bracket, combined on the map side), and the bin that contains the rank becomes the
    next bracket, until it holds a single value. If a rank is not where the sketch suggests, the second
    scan is made again with wider surroundings. Infinities and NaN are only counted; they stand at the
    ends in Spark's order, NaN last.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where("x is not null")
    x, endless = F.col("x"), float("inf")
    finite = ~F.isnan(x) & (F.abs(x) < endless)
    counted = values.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))).agg(
        F.count_if(x == -endless).alias("c0"), F.count_if(finite).alias("c1"),
        F.count_if(x == endless).alias("c2"), F.count_if(F.isnan(x)).alias("c3"),
        F.min(F.when(finite, x)).alias("lo"), F.max(F.when(finite, x)).alias("hi"),
        F.kll_sketch_agg_double(F.when(finite, x), SKETCH_K).alias("sketch"),
    )
    row = counted.agg(
        *[F.coalesce(F.sum(f"c{i}"), F.lit(0)) for i in range(4)], F.min("lo"), F.max("hi"),
        F.kll_merge_agg_double(F.when(F.col("c1") > 0, F.col("sketch")), SKETCH_K),
    ).first()
    counts, (lo, hi, sketch) = row[:4], row[4:]
    n = sum(counts)
    if not n:
        return [None] * len(fractions)

    below = counts[0]
    positions = [(n - 1) * f for f in fractions]
    ranks = {rank for p in positions for rank in (math.floor(p), math.ceil(p))}
    inner = sorted(r - below for r in ranks if below <= r < below + counts[1])
    found = {r + below: v for r, v in _around(values.where(finite), inner, counts[1], lo, hi, sketch, bins).items()}
    for rank in ranks - set(found):
        if rank < below:
            found[rank] = -endless
        else:
            found[rank] = endless if rank < below + counts[1] + counts[2] else float("nan")
    picked = []
    for p in positions:
        low, high, share = found[math.floor(p)], found[math.ceil(p)], p - math.floor(p)
        if low == high or share == 0:
            picked.append(low)
        else:
            # Two products, as the difference of two values may exceed a double.
            apart = math.isinf(high - low)
            picked.append(low * (1 - share) + high * share if apart else low + (high - low) * share)
    return picked


def _surroundings(spark, ranks: list[int], n: int, lo: float, hi: float, sketch: bytearray, margin: float) -> list:
    """Stretches of values that should hold the wanted ranks, in order and apart from each other."""
    ends = [((r + 0.5) / n - margin, (r + 0.5) / n + margin) for r in ranks]
    asked = F.array(*[F.lit(min(max(f, 0.0), 1.0)) for pair in ends for f in pair])
    (at,) = spark.range(1).select(F.kll_sketch_get_quantile_double(F.lit(sketch), asked)).first()
    joined: list[tuple[float, float]] = []
    for (first, last), low, high in zip(ends, at[::2], at[1::2]):
        low, high = lo if first <= 0 else low, hi if last >= 1 else high
        if joined and low <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(joined[-1][1], high))
        else:
            joined.append((low, high))
    return joined


def _around(values: DataFrame, ranks: list[int], n: int, lo, hi, sketch, bins: int) -> dict[int, float]:
    """Value at each 0-based rank, looked for near where the sketch has it."""
    if not ranks:
        return {}
    margin = max(SKETCH_MARGIN, 1.0 / n)
    while True:
        # Zones in order: below the first stretch, in it, between it and the second, and so on.
        stretches = _surroundings(values.sparkSession, ranks, n, lo, hi, sketch, margin)
        zone = F.lit(2 * len(stretches))
        for i, (low, high) in reversed(list(enumerate(stretches))):
            zone = F.when(F.col("x") < low, 2 * i).when(F.col("x") <= high, 2 * i + 1).otherwise(zone)
        zoned = values.select(zone.alias("zone"), "x").withColumn("x", F.when(F.col("zone") % 2 == 1, F.col("x")))
        with staged(zoned.groupBy("zone", "x").agg(F.count(F.lit(1)).alias("n")), "percentiles") as near:
            total = {r[0]: r[1:] for r in near.groupBy("zone").agg(F.sum("n"), F.min("x"), F.max("x")).collect()}
            brackets, before = {}, 0
            for number in sorted(total):
                held, low, high = total[number]
                if number % 2:
                    brackets |= {r: (low, high, before) for r in ranks if before <= r < before + held}
                before += held
            if len(brackets) == len(ranks):
                return _values_at(near.where("x is not null"), brackets, bins)
        margin *= 4


def _values_at(values: DataFrame, brackets: dict, bins: int) -> dict[int, float]:
    """Value at each 0-based rank, of values ``x`` with their counts ``n``.

    A bracket is (lowest value, highest value, rows below it).
    """
    found: dict[int, float] = {}
    brackets = dict(brackets)
    while brackets:
        for rank, (low, high, _) in list(brackets.items()):
            if low == high:
                found[rank] = low
                del brackets[rank]
        if brackets:
            narrower = _narrow(values, brackets, bins)
            if any(narrower[rank] == bracket for rank, bracket in brackets.items()):
                raise ArithmeticError(f"a pass over {bins} bins did not narrow {brackets}")
            brackets = narrower
    return found


def _narrow(values: DataFrame, brackets: dict, bins: int) -> dict:
    """One pass: replace every bracket by the bin of it that holds the wanted rank."""
    spans = sorted(set(brackets.values()))
    which, bin_of, below = (F.lit(None) for _ in range(3))
    for i, (low, high, before) in enumerate(spans):
        inside = F.col("x").between(low, high)
        by = 0.5 if math.isinf(high - low) else 1.0  # halves, where the span exceeds a double
        part = F.floor((F.col("x") * by - low * by) / F.lit(high * by - low * by) * bins).cast("int")
        which = F.when(inside, i).otherwise(which)
        bin_of = F.when(inside, F.least(part, F.lit(bins - 1))).otherwise(bin_of)
        below = F.when(F.col("span") == i, F.lit(before).cast("bigint")).otherwise(below)
    in_any = _any_of([F.col("x").between(low, high) for low, high, _ in spans])

    counted = (
        values.where(in_any)
        .select(which.alias("span"), bin_of.alias("bin"), "x", "n")
        .groupBy("span", "bin")
        .agg(F.sum("n").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    )
    up_to = Window.partitionBy("span").orderBy("bin")
    placed = counted.select(
        "span", "low", "high", "n", (below + F.sum("n").over(up_to) - F.col("n")).alias("first_rank")
    )
    wanted = _any_of(
        [
            (F.col("span") == spans.index(bracket))
            & (F.col("first_rank") <= rank)
            & (F.col("first_rank") + F.col("n") > rank)
            for rank, bracket in brackets.items()
        ]
    )
    # At most one record per wanted rank comes back to the driver.
    hits = placed.where(wanted).collect()
    return {
        rank: next(
            (h["low"], h["high"], h["first_rank"])
            for h in hits
            if h["span"] == spans.index(bracket) and h["first_rank"] <= rank < h["first_rank"] + h["n"]
        )
        for rank, bracket in brackets.items()
    }


def _any_of(conditions: list[Column]) -> Column:
    either = conditions[0]
    for condition in conditions[1:]:
        either = either | condition
    return either
