"""Scoring: percentile cuts, predicted fraud, risk tiers, run summary."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.config import FEATURES, SAMPLE_ROWS, Layout, RiskConfig
from txnrisk.functions.labels import label, predicted_fraud, risk_tier
from txnrisk.operators.forest import anomaly_score, load_forest
from txnrisk.operators.quantiles import exact_percentiles
from txnrisk.sinks.append import append_batch
from txnrisk.sinks.runs import load_model, read_runs, record_run

SCORE = "anomaly_score"


@dataclass(frozen=True)
class Cuts:
    fraud: float
    high: float
    medium: float


def score_cuts(scored: DataFrame, cfg: RiskConfig, **how) -> Cuts:
    """The three percentiles of the score column of a stored table."""
    return Cuts(*exact_percentiles(scored, SCORE, [cfg.fraud_fraction, cfg.high_fraction, cfg.medium_fraction], **how))


def with_predictions(scored: DataFrame, cuts: Cuts) -> DataFrame:
    score = F.col(SCORE)
    return scored.withColumns(
        {
            "is_predicted_fraud": predicted_fraud(score, cuts.fraud),
            "risk_tier": risk_tier(score, cuts.high, cuts.medium),
        }
    )


def tier_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n_rows"))


def high_risk_sample(scored: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The most anomalous high-tier rows."""
    return (
        scored.where("risk_tier = 'high'")
        .select("transaction_id", "customer_id", "amount", SCORE, "risk_tier", "is_fraud")
        .orderBy(SCORE, "transaction_id")
        .limit(rows)
    )


def run_summary(scored: DataFrame) -> DataFrame:
    """Totals and rates of predictions, and of labels where the rows carry them."""
    total = F.count(F.lit(1))
    flagged = F.count_if("is_predicted_fraud")
    out = [
        total.alias("n_scored"),
        flagged.alias("n_predicted_fraud"),
        F.try_divide(flagged, total).alias("predicted_fraud_rate"),
    ]
    if "is_fraud" in scored.columns:
        actual = F.count_if(label() == 1)
        out += [actual.alias("n_actual_fraud"), F.try_divide(actual, total).alias("actual_fraud_rate")]
    return scored.agg(*out)


def score_mart(spark: SparkSession, mart: DataFrame, nodes: DataFrame, cfg: RiskConfig) -> DataFrame:
    forest = load_forest(nodes, FEATURES, cfg)
    return mart.withColumn(SCORE, anomaly_score(spark, forest, FEATURES))


def scored_rows(spark: SparkSession, layout: Layout, run_id: str) -> DataFrame:
    """A run's rows with their predictions, from the stored scores and the cuts of the run."""
    run = (F.col("run_id") == run_id) & (F.col("kind") == "metric")
    values = {r["name"]: r["value"] for r in read_runs(spark, layout.run_metrics).where(run).collect()}
    cuts = Cuts(*[float(values[f"cut_{f.name}"]) for f in fields(Cuts)])
    return with_predictions(spark.read.parquet(layout.scored).where(F.col("run_id") == run_id), cuts)


def scoring_job(spark: SparkSession, mart: DataFrame, layout: Layout, cfg: RiskConfig, run_id: str) -> DataFrame:
    """Load the latest model, score, store, find the cuts, record the run.

    The scored rows are written once. Flags and tiers depend on percentiles of all the scores, so
    they would need a second write of every row; instead the cuts are stored with the run and
    applied on reading.
    """
    scored = score_mart(spark, mart, load_model(spark, layout.models), cfg)
    append_batch(scored.withColumn("run_id", F.lit(run_id)), layout.scored, "run_id")
    stored = spark.read.parquet(layout.scored).where(F.col("run_id") == run_id)
    cuts = score_cuts(stored, cfg)
    summary = run_summary(with_predictions(stored, cuts)).first().asDict()
    summary.update({f"cut_{name}": value for name, value in asdict(cuts).items()})
    record_run(spark, layout.run_metrics, run_id, "metric", summary)
    return scored_rows(spark, layout, run_id)
