"""Trailing-window statistics per entity that survive hot entities and dense histories.

A window function over ``partitionBy(customer)`` sends a customer's whole history to one task
and re-reads the frame for every row. Here no task ever holds more than a bounded number of
records, whatever share of the rows one entity has:

1. Rows of one entity in the same second share the same frame, so they are first summed up per
   (entity, second). The partial sums are taken on the map side.
2. The timeline of an entity is cut into tiles. A tile holds at most ``tile`` seconds plus the
   look-back copied over from its predecessor, hence a bounded number of records.
3. Inside a tile every frame is the difference of two running totals. Amounts are summed as
   exact integers, so differences lose nothing and results do not depend on the partitioning.
4. The results go back to the rows by an equi-join on (entity, second), which spreads a hot
   entity over all of its seconds; adaptive execution splits what is still skewed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Values are summed in units of 1e-8. A value up to 50,000 is 5e12 units, its square 2.5e25, so
# a 38-digit sum holds 4e12 rows per entity and tile; beyond that Spark raises an error.
UNIT_DIGITS = 8
UNITS = 10.0**UNIT_DIGITS
_WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class Trailing:
    """A frame ``[t - seconds, t]``, both ends included."""

    name: str
    seconds: int


def _running(column: str, group: Window, seconds: int | None) -> Column:
    """Total up to now, or up to just before the frame of ``seconds`` begins."""
    last = 0 if seconds is None else -(seconds + 1)
    total = F.sum(column).over(group.rangeBetween(Window.unboundedPreceding, last))
    return total if seconds is None else F.coalesce(total, F.lit(0))


def _in_frame(column: str, group: Window, seconds: int) -> Column:
    return _running(column, group, None) - _running(column, group, seconds)


def _mean(prefix: str) -> Column:
    n, quotient, rest = (F.col(f"{prefix}_{part}") for part in ("n", "q", "r"))
    exact = (quotient.cast("double") + rest.cast("double") / n) / F.lit(UNITS)
    return F.when(n > 0, exact)


def _stddev(prefix: str) -> Column:
    """Sample standard deviation from exact sums.

    For any integer q and r = s1 - q*n the sum of squared deviations is s2 - q*(s1 + r) - r*r/n.
    All but the last term are integers, so equal values give exactly zero; with q next to the
    mean r is small and the subtraction loses nothing.
    """
    n, s1, s2, q, r = (F.col(f"{prefix}_{part}") for part in ("n", "s1", "s2", "q", "r"))
    whole = (s2 - (q * (s1 + r)).cast(_WIDE)).cast("double")
    rest = r.cast("double")
    spread = F.greatest(whole - rest * rest / n, F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (n - 1)) / F.lit(UNITS))


def per_second_totals(rows: DataFrame, entity: str, second: str, counted: str, value: str | None) -> DataFrame:
    """One record per (entity, second): the count of ``counted`` and exact sums of ``value``."""
    columns = [F.col(entity), F.col(second), F.col(counted).alias("_counted")]
    totals = [F.count("_counted").alias("_events")]
    if value is not None:
        units = F.round(F.col(value) * F.lit(UNITS)).cast("bigint").cast("decimal(19,0)")
        columns.append(units.alias("_units"))
        totals += [
            F.count("_units").alias("_n"),
            F.sum("_units").cast(_WIDE).alias("_s1"),
            F.sum((F.col("_units") * F.col("_units")).cast(_WIDE)).cast(_WIDE).alias("_s2"),
        ]
    return rows.select(*columns).groupBy(entity, second).agg(*totals)


def trailing_stats(
    rows: DataFrame,
    entity: str,
    second: str,
    counted: str,
    counts: list[Trailing],
    value: str | None = None,
    moments: list[Trailing] | None = None,
    tile: int | None = None,
) -> DataFrame:
    """Frame statistics, one record per (entity, second).

    Each of ``counts`` gives a column with its name; each of ``moments`` gives ``<name>_mean``
    and ``<name>_stddev`` (sample, null below two values). ``tile`` is the tile length in
    seconds; by default twice the longest look-back, at least a day.
    """
    moments = moments or []
    longest = max(t.seconds for t in [*counts, *moments])
    tile = tile or max(2 * longest, 86_400)

    totals = per_second_totals(rows, entity, second, counted, value if moments else None)
    own_tile = F.floor(F.col(second) / F.lit(tile))
    last_tile = F.floor((F.col(second) + F.lit(longest)) / F.lit(tile))
    tiled = totals.withColumn("_own", own_tile).withColumn("_tile", F.explode(F.sequence(own_tile, last_tile)))

    group = Window.partitionBy(entity, "_tile").orderBy(second)
    columns = [F.col(entity), F.col(second), F.col("_own"), F.col("_tile")]
    columns += [_in_frame("_events", group, t.seconds).alias(t.name) for t in counts]
    for t in moments:
        columns.append(_in_frame("_n", group, t.seconds).alias(f"{t.name}_n"))
        columns.append(_in_frame("_s1", group, t.seconds).cast(_WIDE).alias(f"{t.name}_s1"))
        columns.append(_in_frame("_s2", group, t.seconds).cast(_WIDE).alias(f"{t.name}_s2"))
    framed = tiled.select(*columns).where("_own = _tile")

    for t in moments:
        n, s1, q = (F.col(f"{t.name}_{part}") for part in ("n", "s1", "q"))
        near_mean = F.round(s1.cast("double") / F.nullif(n, F.lit(0))).cast("bigint").cast("decimal(19,0)")
        framed = framed.withColumn(f"{t.name}_q", near_mean)
        framed = framed.withColumn(f"{t.name}_r", (s1 - (q * n.cast("decimal(19,0)")).cast(_WIDE)).cast(_WIDE))

    out = [F.col(entity), F.col(second)] + [F.col(t.name) for t in counts]
    for t in moments:
        out += [_mean(t.name).alias(f"{t.name}_mean"), _stddev(t.name).alias(f"{t.name}_stddev")]
    return framed.select(*out)


def with_trailing_stats(rows: DataFrame, entity: str, second: str, **spec) -> DataFrame:
    """``rows`` with the columns of :func:`trailing_stats` joined on; no row is lost or added.

    ``rows`` should be a stored table: it is read twice, for the totals (the entity, time and value
    columns only) and for the rows themselves.
    """
    return rows.join(trailing_stats(rows, entity, second, **spec), [entity, second], "left")
