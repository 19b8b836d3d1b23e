"""Line dedup by site-relative frequency, with DataFrame functions only.

Per host, the share of its pages that hold a line is the line's ratio; lines above the limit are
boilerplate of that host and are dropped from its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import join_facts, stage


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def normal(line: Column) -> Column:
    """What lines are compared by: without blanks, tabs and returns at either end."""
    return F.trim(line, F.lit(" \t\r"))


def line_key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = 0.1, min_pages: int = 3) -> DataFrame:
    """(host, a, b, pages, host_pages): lines on more than ``ratio`` of their host's pages.

    A page counts once per line; pages that repeat, or copy, another count each. Lines on fewer
    than ``min_pages`` pages, and blank lines, are never boilerplate. Null is a host like any other.
    Lines are named and counted by two 64-bit hashes (a, b), summed on the map side, so that no
    text goes through the shuffle.
    """
    lines = F.array_distinct(F.transform(split_lines(F.col("text")), normal))
    host_pages = docs.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("host_pages"))
    hashes = F.transform(F.filter(lines, lambda x: x != ""), line_key)
    each = docs.select(F.col(host).alias("host"), F.explode(hashes).alias("h"))
    pages = each.groupBy("host", "h.a", "h.b").agg(F.count(F.lit(1)).alias("pages"))
    pages = pages.filter(F.col("pages") >= min_pages).withColumnRenamed("host", "_host")
    joined = pages.join(host_pages, F.col("_host").eqNullSafe(F.col("host")))
    return joined.filter(F.col("pages") > F.lit(float(ratio)) * F.col("host_pages")).select(
        "host", "a", "b", "pages", "host_pages"
    )


def drop_lines(
    docs: DataFrame, host: str = "source", ratio: float = 0.1, min_pages: int = 3, counts: bool = False
) -> DataFrame:
    """The documents with boilerplate lines taken out of ``text``; all columns and rows stay.

    Null texts stay null; a text of boilerplate only becomes empty. Other lines keep their order,
    blanks included. A host has fewer than (its lines per page) / ratio boilerplate lines, so its
    list stays small however many pages it has. With ``counts``, n_lines and n_dropped are added.
    """
    found = boilerplate(docs, host, ratio, min_pages)
    lists = found.groupBy(F.col("host").alias("_host")).agg(F.collect_list(F.struct("a", "b")).alias("_bad"))
    lists = stage(lists, "boilerplate")
    spread = F.coalesce(F.col("text"), F.lit(""))
    named = docs.withColumn("_host", F.col(host))
    joined = join_facts(named, lists, "_host", spread).drop("_host")
    hashed = F.transform(split_lines(F.col("text")), lambda x: line_key(normal(x)))
    nothing = F.col("_bad").isNull() | F.col("text").isNull()
    here = F.when(nothing, F.lit(None)).otherwise(F.array_intersect(hashed, F.col("_bad")))
    joined = joined.withColumn("_here", here).drop("_bad")
    kept = F.filter(split_lines(F.col("text")), lambda x: ~F.array_contains(F.col("_here"), line_key(normal(x))))
    touched = F.size("_here") > 0
    joined = joined.withColumn("_kept", F.when(touched, kept))
    text = F.when(touched, F.array_join("_kept", "\n")).otherwise(F.col("text"))
    lines = F.size(split_lines(F.col("text")))
    joined = joined.withColumn("_n", F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long"))
    joined = joined.withColumn("text", text)
    if counts:
        dropped = F.when(touched, F.col("_n") - F.size("_kept")).otherwise(0).cast("long")
        joined = joined.withColumn("n_lines", F.col("_n")).withColumn("n_dropped", dropped)
    return joined.drop("_here", "_kept", "_n")
