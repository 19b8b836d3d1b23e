"""Mixing sources to target weights.

Words are summed per source; weights share out a budget of words, no source getting more than
``most`` times what it has; each document is then emitted floor(rate) times, plus one copy with
probability equal to the fraction, decided by a hash of its id and the seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import WORD, join_facts, ranked, stage


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the key, the same in every run and on every layout.

    Rows that repeat a key share its draw; a null key counts as the text "null".
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: DataFrame, budget: float, most: float) -> DataFrame:
    """(source, source_size, target): the budget times all words, shared by weight, with limits.

    A share above ``most`` times its source's size stops there and what is left is shared anew
    among the others, until no share is above. Sources without a weight get 0; if all sources are
    at their limits, the rest of the budget is not used. One aggregate of three numbers per round.
    """
    known = sizes.join(weights.withColumnRenamed("source", "_w"), sizes["source"].eqNullSafe(F.col("_w")), "left")
    known = known.select("source", "source_size", F.coalesce("weight", F.lit(0.0)).cast("double").alias("weight"))
    known = known.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    known = stage(known, "mix-sources")
    total = float(known.agg(F.sum("source_size")).first()[0] or 0) * budget
    level = 0.0
    while True:
        above = F.col("weight") * F.lit(level) > F.col("limit")
        used, left, at_limit = known.agg(
            F.coalesce(F.sum(F.when(above, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
            F.count_if(above),
        ).first()
        new = (total - used) / left if left > 0 else level
        if new <= level:
            break
        level = new
    target = F.least(F.col("weight") * F.lit(level), F.col("limit"))
    return known.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame, weights: DataFrame, budget: float = 1.5, most: float = 2.0, seed: int = 17, key: str = "doc_id"
) -> DataFrame:
    """All documents with size, source_size, target, rate and copies (0 or more).

    ``weights`` has (source, weight), one row per source; null is a source like any other. Null
    and blank texts have size 0 and take no words. A source without words has rate 0. Rows that
    repeat an id are counted each and share the draw, so both get the same number of copies. Other
    columns pass through; the names of the added ones replace existing columns of those names.
    """
    sized = docs.withColumn("size", n_words(F.col("text")))
    totals = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    targets = stage(source_targets(totals, weights, budget, most), "mix-targets")
    added = sized.drop("source_size", "target", "rate", "copies")
    joined = join_facts(added, targets, "source", F.col(key))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = joined.withColumn("rate", F.least(rate, F.lit(float(most))))
    whole = F.floor("rate")
    extra = (draw(F.col(key), seed) < F.col("rate") - whole).cast("long")
    return joined.withColumn("copies", (whole + extra).cast("long"))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """One row per copy, numbered from 1 in ``copy``; documents without a copy go."""
    numbers = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return mixed.filter(F.col("copies") > 0).withColumn("copy", F.explode(numbers))


def cyclic_weights(docs: DataFrame, cycle: tuple[float, ...] = (3.0, 1.0, 2.0)) -> DataFrame:
    """Weights for the sources in order of their code points, null last, repeating the cycle."""
    names = ranked(docs.select("source").distinct(), F.col("source").asc_nulls_last(), "_rank")
    pick = F.element_at(F.array(*map(F.lit, cycle)), (F.col("_rank") % len(cycle) + 1).cast("int"))
    return names.select("source", pick.alias("weight"))
