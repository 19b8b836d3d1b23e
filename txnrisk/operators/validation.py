"""Row rules and the complementary split they induce."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_hold(rules: dict[str, Column]) -> Column:
    """Conjunction of the rules as a plain predicate, so that scans can push parts of it down."""
    return reduce(and_, rules.values())


def failed(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks, in rule order; an unknown outcome counts as broken."""
    checks = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return F.array_compact(F.array(*checks))


def split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid); every input row lands in exactly one of them.

    ``where`` keeps only rows whose predicate is true, so the second half must turn an unknown
    outcome into false before negating it.
    """
    holds = all_hold(rules)
    valid = df.where(holds)
    invalid = df.where(~F.coalesce(holds, F.lit(False))).withColumn("failed_rules", failed(rules))
    return valid, invalid


def rule_counts(invalid: DataFrame) -> DataFrame:
    """Rows broken per rule (a row that breaks two rules counts under both)."""
    return (
        invalid.select(F.explode("failed_rules").alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
