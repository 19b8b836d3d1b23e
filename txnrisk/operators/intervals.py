"""Intervals per entity: neighbouring points merged to islands, and rows that lie in any of many intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(points: DataFrame, entity: str, second: str, gap: int) -> DataFrame:
    """(entity, first_sec, last_sec): stretches in which points follow each other within ``gap`` seconds.

    Points of one tile of ``gap`` seconds belong together, so they are reduced to the tile's first and last
    on the map side; what is ordered per entity is a record per tile that it has points in.
    """
    tiles = points.groupBy(entity, F.floor(F.col(second) / gap).alias("_tile")).agg(
        F.min(second).alias("first_sec"), F.max(second).alias("last_sec")
    )
    in_order = Window.partitionBy(entity).orderBy("_tile")
    before = F.lag("last_sec").over(in_order)
    begins = F.when(before.isNull() | (F.col("first_sec") - before > gap), 1).otherwise(0)
    marked = tiles.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(in_order))
    merged = marked.groupBy(entity, "_island").agg(F.min("first_sec").alias("first_sec"), F.max("last_sec").alias("last_sec"))
    return merged.drop("_island")


def within(
    rows: DataFrame,
    second: Column,
    spans: DataFrame,
    entity: str,
    before: int,
    after: int,
    tile: int,
    spread_by: str,
    max_rows: int,
    salts: int,
    mark: tuple[str, int] | None = None,
) -> DataFrame:
    """The rows in any interval [first_sec - before, last_sec + after] of their entity, each once.

    An equi-join on (entity, tile of time) instead of a comparison with all of an entity's intervals;
    each is entered in the tiles it touches, a tile's intervals in one entry. Few entries are broadcast, after
    counting them; otherwise rows of one entity and tile are spread over salts, of which the entries have a
    copy each, and both sides are shuffled whatever sizes the planner guesses: it does not see what the tiles
    and salts multiply. ``mark`` (a name and another ``before``) adds a column that tells the rows that are in
    an interval with that one, so that a second join isn't needed.
    """
    low, high = F.col("first_sec") - before, F.col("last_sec") + after
    touched = F.sequence(F.floor(low / tile), F.floor(high / tile))
    each = spans.select(F.col(entity).alias("_entity"), "first_sec", "last_sec", F.explode(touched).alias("_in"))
    entries = each.groupBy("_entity", "_in").agg(F.collect_list(F.struct("first_sec", "last_sec")).alias("_spans"))
    tiled = rows.withColumns({"_sec": second, "_tile": F.floor(second / tile)})
    same = (F.col(entity) == F.col("_entity")) & (F.col("_tile") == F.col("_in"))

    def inside(early: int) -> Column:
        return F.exists("_spans", lambda x: F.col("_sec").between(x["first_sec"] - early, x["last_sec"] + after))

    def found(joined: DataFrame) -> DataFrame:
        kept = joined.where(inside(before))
        names = [F.col(c) for c in rows.columns]
        return kept.select(*names) if mark is None else kept.select(*names, inside(mark[1]).alias(mark[0]))

    if entries.count() <= max_rows:
        return found(tiled.join(F.broadcast(entries), same))
    salted = tiled.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    every = F.sequence(*[F.lit(salt).cast("bigint") for salt in (0, salts - 1)])
    copies = entries.withColumn("_of_salt", F.explode(every)).hint("merge")
    both = (F.col(entity) == F.col("_entity")) & (F.col("_salt") == F.col("_of_salt")) & (F.col("_tile") == F.col("_in"))
    return found(salted.join(copies, both))
