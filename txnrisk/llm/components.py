"""Connected components by alternating large-star and small-star (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import discard, stage


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _with_least(pairs: DataFrame) -> DataFrame:
    """Pairs with the least of u and all its v. A sum per key and a join: a hub's pairs can be split."""
    least = pairs.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
    least = least.select("_u", F.least("_u", "m").alias("m"))
    return pairs.join(least, pairs["u"] == least["_u"]).drop("_u")


def large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least node of its neighbourhood."""
    pairs = _with_least(_neighbours(edges)).filter(F.col("v") > F.col("u"))
    return pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them. Edges run from larger to smaller."""
    pairs = _with_least(edges.select("u", "v"))
    below = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v"))
    return below.unionByName(pairs.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node with a link.

    Links with a null end, and links of a node to itself, say nothing. Each round is written to the
    shared folder; rounds go on until the set of links is the same as before, which takes about the logarithm of
    the longest path. Only the links' number and two checksums come to the driver.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = stage(ends.filter(ends[ends.columns[2]]).select("u", "v").filter("u <> v").distinct(), "links")
    before = None
    while True:
        sums = [F.sum(F.xxhash64("u", "v", F.lit(i)).cast("decimal(38,0)")) for i in (0, 1)]
        now = tuple(edges.agg(F.count(F.lit(1)), *sums).first())
        if now == before or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
        last, edges = edges, stage(small_star(large_star(edges)), "links")
        discard(last)
