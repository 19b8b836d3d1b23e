"""Training: gate, fit, decide, evaluate, register."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.config import FEATURES, Layout, RiskConfig
from txnrisk.functions.labels import anomaly_as_label, decision, inverted, label
from txnrisk.operators.evaluate import classification_metrics, roc_auc
from txnrisk.operators.forest import train_forest
from txnrisk.operators.quantiles import exact_percentiles
from txnrisk.plans.mart import has_rows
from txnrisk.plans.scoring import SCORE, score_mart
from txnrisk.session import staged
from txnrisk.sinks.runs import load_model, record_run, save_model


class TooFewRows(ValueError):
    """Raised instead of training on too little data."""


@dataclass(frozen=True)
class Trained:
    version: int
    cut: float
    metrics: dict


def decided(scored: DataFrame, cut: float) -> DataFrame:
    """Training-time decision: 1 for rows scored below the contamination cut."""
    return scored.withColumn("predicted", anomaly_as_label(decision(F.col(SCORE), cut)))


def evaluation(scored: DataFrame) -> dict:
    """Precision, recall, F1, ranking quality and sample counts of decided rows."""
    rows = scored.select(label().alias("label"), "predicted", inverted(F.col(SCORE)).alias("risk"))
    report = classification_metrics(rows, "label", "predicted").first().asDict()
    report["roc_auc"] = roc_auc(rows, "label", "risk")
    return report


def training_job(spark: SparkSession, mart: DataFrame, layout: Layout, cfg: RiskConfig, run_id: str) -> Trained:
    """``mart`` should be a stored table: it is read to count, to sample and to score.

    Only the scores and labels are written out for the measures, two narrow columns.
    """
    if not has_rows(mart, cfg.min_training_rows):
        raise TooFewRows(f"training needs at least {cfg.min_training_rows} rows")
    matrix = mart.select("transaction_id", *FEATURES, "is_fraud")
    parameters = {
        "model_type": "IsolationForest",
        "contamination": cfg.contamination,
        "n_estimators": cfg.n_trees,
        "max_samples": cfg.max_samples,
        "random_state": cfg.seed,
        "n_features": len(FEATURES),
        "features": ",".join(FEATURES),
    }
    record_run(spark, layout.run_metrics, run_id, "param", parameters)

    version = save_model(train_forest(matrix, "transaction_id", FEATURES, matrix.count(), cfg), layout.models)
    scores = score_mart(spark, matrix, load_model(spark, layout.models, version), cfg)
    with staged(scores.select("is_fraud", SCORE), "train-scores") as scored:
        (cut,) = exact_percentiles(scored, SCORE, [cfg.contamination])
        report = evaluation(decided(scored, cut))
    record_run(spark, layout.run_metrics, run_id, "metric", report)
    return Trained(version, cut, report)
