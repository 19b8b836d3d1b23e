import pytest

from txnrisk.operators import evaluate
from txnrisk.plans import scoring


def labelled(spark, labels, predicted):
    return spark.createDataFrame(list(zip(labels, predicted)), "y int, p int")


def test_auc_counts_ties_half(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0), (0.1, 0)], "risk double, y int")
    assert evaluate.roc_auc(rows, "y", "risk") == pytest.approx(0.916667, abs=1e-6)


def test_auc_needs_both_classes(spark):
    assert evaluate.roc_auc(spark.createDataFrame([(0.9, 1)], "risk double, y int"), "y", "risk") is None


def test_classification_metrics(spark):
    got = evaluate.classification_metrics(labelled(spark, [1, 1, 0, 0, 1], [1, 0, 1, 0, 1]), "y", "p").first()
    assert got.precision == pytest.approx(2 / 3) and got.recall == pytest.approx(2 / 3)
    assert got.f1 == pytest.approx(2 / 3)
    assert (got.n_samples, got.n_fraud, got.n_legit) == (5, 3, 2)


def test_nothing_predicted_gives_zeros(spark):
    got = evaluate.classification_metrics(labelled(spark, [1, 0], [0, 0]), "y", "p").first()
    assert (got.precision, got.recall, got.f1) == (0.0, 0.0, 0.0)


def test_confusion_matrix(spark):
    got = evaluate.confusion_matrix(labelled(spark, [1, 1, 0], [1, 0, 0]), "y", "p").collect()
    assert {(r.label, r.predicted): r.n_rows for r in got} == {(1, 1): 1, (1, 0): 1, (0, 0): 1}


def scored(spark, scores):
    rows = [(f"T{i}", "C", 1.0, i == 0, float(s)) for i, s in enumerate(scores)]
    return spark.createDataFrame(
        rows, "transaction_id string, customer_id string, amount double, is_fraud boolean, anomaly_score double"
    )


def test_tier_edges_and_strict_fraud_cut(spark):
    rows = scored(spark, [1, 2, 3, 4])
    flagged = scoring.with_predictions(rows, scoring.Cuts(fraud=1.0, high=2.0, medium=3.0)).orderBy("transaction_id")
    assert [r.risk_tier for r in flagged.collect()] == ["high", "high", "medium", "low"]
    assert [r.is_predicted_fraud for r in flagged.collect()] == [False] * 4


def test_equal_cuts_do_not_fail(spark):
    flagged = scoring.with_predictions(scored(spark, [1, 1, 2]), scoring.Cuts(1.0, 1.0, 1.0))
    assert {r.risk_tier: r.n_rows for r in scoring.tier_counts(flagged).collect()} == {"high": 2, "low": 1}


def test_summary_and_sample(spark):
    flagged = scoring.with_predictions(scored(spark, range(40)), scoring.Cuts(1.0, 20.0, 30.0))
    got = scoring.run_summary(flagged).first()
    assert (got.n_scored, got.n_predicted_fraud, got.n_actual_fraud) == (40, 1, 1)
    assert got.predicted_fraud_rate == 0.025
    assert "n_actual_fraud" not in scoring.run_summary(flagged.drop("is_fraud")).columns
    assert [r.anomaly_score for r in scoring.high_risk_sample(flagged).collect()] == [float(i) for i in range(10)]
    empty = scoring.run_summary(flagged.where("false")).first()
    assert empty.n_scored == 0 and empty.predicted_fraud_rate is None
