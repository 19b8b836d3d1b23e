"""A corpus pipeline of five stages, each applying one operator to all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the rows are written
and read again, so that a stage's work is done once and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import decontaminate, langid, lines, mixing, neardup
from txnrisk.llm.common import stage, table


OWN = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_other_columns(stage: Stage) -> Stage:
    """Let a stage see its own columns under their names and all others under names that nothing else has.

    So a column of any name, as ``copy`` or ``size``, passes through the stage as it is.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = {name: f"__passed_{i}" for i, name in enumerate(docs.columns) if name not in OWN}
        out = stage(spark, docs.select(*[F.col(f"`{n}`").alias(others.get(n, n)) for n in docs.columns]), sf_dir)
        added = []
        for name in out.columns:
            if name not in OWN and name not in others.values():
                free = name
                while free in docs.columns:
                    free += "_"
                added.append(F.col(name).alias(free))
        return out.select(*[F.col(others.get(n, n)).alias(n) for n in docs.columns], *added)

    return run


@with_other_columns
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages stay; those without a letter go.

    Profiles are learned from all documents with a label. A document's label is replaced by the
    language found. Null and empty texts have no letter; repeated rows are judged each; ties between
    languages go to the smaller name. Without any label nothing can be found, and all documents go.
    """
    profiles = langid.load(langid.learn(docs))
    found = langid.identify(docs, profiles, ("_lang", "_score")).filter(F.col("_lang") != langid.UNKNOWN)
    return found.withColumn("lang", F.col("_lang")).select(*docs.columns)


@with_other_columns
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of a source's documents, and on 3 or more, are taken out of them; n_chars follows.

    All rows stay, with null texts as they are. Null is a source like any other; repeated rows count each.
    """
    kept = lines.drop_lines(docs, host="source", ratio=0.1, min_pages=3)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@with_other_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, Jaccard 0.8 or more) the smallest doc_id stays.

    Rows without a doc_id, and null or blank texts, stay. Rows that share a doc_id are one document: they
    stay or go together, exact repeats of a row included.
    """
    return neardup.drop_near_duplicates(docs, size=5, threshold_percent=80).select(*docs.columns)


@with_other_columns
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with 0.8 or more of a benchmark item's five-word shingles go.

    Every row is judged by its own text, with or without an id; null and blank texts hold nothing and stay, as
    all do without a benchmark item.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), size=5, containment=0.8)


@with_other_columns
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents such that the sources' shares of words follow the weights.

    ``copy`` numbers a document's copies from 1 (``copy_`` if documents have a column copy). Sources in order of
    code points, null last, weigh 3, 1, 2, repeating; the budget is 1.5 times all words, and no source takes more
    than twice its own. Rows that share a doc_id share the draw. Texts without words follow their source's rate.
    """
    mixed = mixing.mix_sources(docs, mixing.cyclic_weights(docs), budget=1.5, most=2.0)
    return mixing.emit_copies(mixed).select(*docs.columns, "copy")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: The learned language profiles and the stages on them can't be put in SQL; tests/llm/test_pipeline.py
#: compares the rows of run() with a brute-force version in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
