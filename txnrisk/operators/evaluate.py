"""Label-based measures of a prediction, from counts that combine on the map side."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def sample_counts(df: DataFrame, label: str) -> DataFrame:
    y = F.col(label).cast("int")
    return df.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(y == 1).alias("n_fraud"),
        F.count_if(y == 0).alias("n_legit"),
    )


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return (
        df.groupBy(F.col(label).cast("int").alias("label"), F.col(predicted).cast("int").alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def classification_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 (0 where undefined) and sample counts in one aggregation."""
    y, p = F.col(label).cast("int"), F.col(predicted).cast("int")
    counts = df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(y == 1).alias("n_fraud"),
        F.count_if(y == 0).alias("n_legit"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "n_samples",
        "n_fraud",
        "n_legit",
    )


def roc_auc(df: DataFrame, label: str, risk: str) -> float | None:
    """Area under the ROC curve, ties counted half; ``None`` unless both classes occur.

    Equal scores collapse into weighted points before the evaluator sorts them, so a score
    shared by many rows is one point. ``numBins=0`` keeps every distinct score.
    """
    rows = df.select(F.col(label).cast("double").alias("label"), F.col(risk).cast("double").alias("risk"))
    rows = rows.where("label is not null and risk is not null")
    lowest, highest = rows.agg(F.min("label"), F.max("label")).first()
    if lowest == highest:
        return None
    points = rows.groupBy("risk", "label").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="risk", labelCol="label", weightCol="weight", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(points)
