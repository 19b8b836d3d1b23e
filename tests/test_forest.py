from hashlib import md5

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnrisk.config import FEATURES, Layout, RiskConfig
from txnrisk.functions.labels import anomaly_as_label, decision
from txnrisk.operators.forest import DRAWS, Forest, average_path, load_forest, train_forest, tree_samples
from txnrisk.operators.quantiles import exact_percentiles
from txnrisk.plans import scoring, training
from txnrisk.session import stage
from txnrisk.sinks.runs import CLAIMS, load_model, read_runs, record_run, save_model
from txnrisk.sources.tables import create_file

CFG = RiskConfig(n_trees=40)
OUTLIERS = 8


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(2000, len(FEATURES)))
    points[:OUTLIERS] += 9
    frame = pd.DataFrame(points, columns=FEATURES)
    frame.insert(0, "transaction_id", [f"T{i:05d}" for i in range(len(frame))])
    frame["is_fraud"] = frame.index < OUTLIERS
    return stage(spark.createDataFrame(frame), "forest-matrix")


@pytest.fixture(scope="module")
def nodes(matrix):
    return stage(train_forest(matrix, "transaction_id", FEATURES, 2000, CFG), "forest-nodes")


@pytest.fixture(scope="module")
def scored(spark, matrix, nodes):
    return stage(scoring.score_mart(spark, matrix, nodes, CFG), "forest-scored")


def test_average_path():
    assert average_path(np.array([1, 2])).tolist() == [0.0, 1.0]
    assert float(average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_planted_outliers_rank_lowest(scored):
    lowest = scored.orderBy(scoring.SCORE).limit(OUTLIERS).select("transaction_id").collect()
    assert {r[0] for r in lowest} == {f"T{i:05d}" for i in range(OUTLIERS)}


def test_score_range(scored):
    low, high = scored.agg(F.min(scoring.SCORE), F.max(scoring.SCORE)).first()
    assert -1.0 <= low < high < 0.0


def test_flagged_share_is_at_most_the_contamination(scored):
    (cut,) = exact_percentiles(scored, scoring.SCORE, [CFG.contamination])
    flagged = scored.where(anomaly_as_label(decision(F.col(scoring.SCORE), cut)) == 1).count()
    assert 0 < flagged <= 0.02 * 2000 + 1


def test_same_seed_same_model_whatever_the_partitioning(matrix, nodes):
    again = train_forest(matrix.repartition(11, "amount"), "transaction_id", FEATURES, 2000, CFG)
    assert sorted(map(str, again.collect())) == sorted(map(str, nodes.collect()))
    other = train_forest(matrix, "transaction_id", FEATURES, 2000, RiskConfig(n_trees=40, seed=7))
    assert sorted(map(str, other.collect())) != sorted(map(str, nodes.collect()))


def test_tree_shape(nodes):
    roots = nodes.where("node_id = 1").collect()
    assert len(roots) == CFG.n_trees and {r["size"] for r in roots} == {256}
    assert nodes.agg(F.max("depth")).first()[0] <= 8
    leaves = nodes.where("feature is null").groupBy("tree_id").agg(F.sum("size").alias("n")).collect()
    assert {r.n for r in leaves} == {256}


@pytest.mark.parametrize("n, trees", [(2000, 40), (2000, 5), (100, 5)])
def test_samples_are_distinct_rows_of_the_right_number(spark, n, trees):
    rows = spark.range(n).select(F.concat(F.lit("T"), "id").alias("transaction_id"))
    picked = tree_samples(rows, "transaction_id", n, RiskConfig(n_trees=trees))
    per_tree = picked.groupBy("tree_id").agg(F.count("*").alias("n"), F.count_distinct("transaction_id").alias("d"))
    assert {(r.n, r.d) for r in per_tree.collect()} == {(min(256, n),) * 2}
    assert per_tree.count() == trees


@pytest.mark.parametrize("n", [300, 50_000])
def test_each_tree_takes_its_lowest_hashes(spark, n):
    """The same draw at every size: few rows, and many that the cut thins."""
    rows = spark.range(n).select(F.concat(F.lit("T"), "id").alias("transaction_id"))
    cfg = RiskConfig(n_trees=4)
    drawn = tree_samples(rows, "transaction_id", n, cfg)
    ids = [f"T{i}" for i in range(n)]
    digests = [md5(f"{cfg.seed}:{i}".encode()).hexdigest() for i in ids]
    for tree in range(cfg.n_trees):
        draws = [(int(d[:12], 16) + tree * int(d[12:24], 16)) % DRAWS for d in digests]
        mine = drawn.where(F.col("tree_id") == tree).select("transaction_id").collect()
        assert sorted(r[0] for r in mine) == sorted(i for _, i in sorted(zip(draws, ids))[:256])


def test_draws_stay_below_a_prime_and_within_a_long():
    assert all(DRAWS % k for k in range(2, 2**24 + 1))
    assert 2**48 * RiskConfig().n_trees < 2**63


def test_trees_take_different_rows(spark):
    """Of 5,000 rows two trees share some 13; each row has the same chance in each."""
    rows = spark.range(5000).select(F.concat(F.lit("T"), "id").alias("transaction_id"))
    drawn = tree_samples(rows, "transaction_id", 5000, RiskConfig(n_trees=20))
    taken = drawn.groupBy("tree_id").agg(F.collect_set("transaction_id")).collect()
    shared = [len(set(a[1]) & set(b[1])) for a in taken for b in taken if a[0] < b[0]]
    assert 10 < np.mean(shared) < 16.5 and max(shared) < 35


def test_cut_is_widened_when_rows_were_overcounted(spark):
    rows = spark.range(600).select(F.concat(F.lit("T"), "id").alias("transaction_id"))
    drawn = tree_samples(rows, "transaction_id", 2000, RiskConfig(n_trees=3))
    assert {r["count"] for r in drawn.groupBy("tree_id").count().collect()} == {256}


def test_scores_equal_a_plain_walk_of_the_node_table(matrix, nodes, scored):
    held = nodes.toPandas()
    by_tree = {t: g.set_index("node_id") for t, g in held.groupby("tree_id")}
    for row in scored.orderBy("transaction_id").limit(5).collect():
        depths = []
        for tree in by_tree.values():
            at = 1
            while pd.notna(tree.loc[at, "feature"]):
                at = 2 * at if row[tree.loc[at, "feature"]] <= tree.loc[at, "split"] else 2 * at + 1
            depths.append(tree.loc[at, "depth"] + float(average_path(int(tree.loc[at, "size"]))))
        assert row[scoring.SCORE] == pytest.approx(-(2 ** (-np.mean(depths) / float(average_path(256)))), abs=1e-12)


def test_constant_rows_give_one_leaf(spark):
    rows = spark.range(60).select(F.concat(F.lit("T"), "id").alias("transaction_id"), *[F.lit(1.0).alias(f) for f in FEATURES])
    model = train_forest(rows, "transaction_id", FEATURES, 60, CFG)
    assert model.count() == CFG.n_trees
    forest = load_forest(model, FEATURES, CFG)
    assert isinstance(forest, Forest) and len(set(forest.score(np.ones((3, len(FEATURES)))))) == 1


def test_oversized_model_is_refused(nodes):
    with pytest.raises(ValueError):
        load_forest(nodes, FEATURES, RiskConfig(n_trees=2))


def test_versions(tmp_path, spark, nodes):
    path = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    assert save_model(nodes, path) == 1
    assert save_model(nodes.where("tree_id < 3"), path) == 2
    assert load_model(spark, path).select("tree_id").distinct().count() == 3
    assert load_model(spark, path, 1).count() == nodes.count()


def test_a_claimed_version_is_left_alone(tmp_path, spark, nodes):
    """Another trainer has claimed version 1 and not written it yet."""
    path = str(tmp_path / "models")
    assert create_file(spark, f"{path}/{CLAIMS}/1") and not create_file(spark, f"{path}/{CLAIMS}/1")
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    assert save_model(nodes, path) == 2


def test_a_run_recorded_again_replaces_its_rows(tmp_path, spark):
    path = str(tmp_path / "runs")
    record_run(spark, path, "1", "param", {"a": 1})
    record_run(spark, path, "1", "metric", {"cut": 0.1, "old": None})
    record_run(spark, path, "2", "metric", {"cut": 0.2})
    record_run(spark, path, "1", "metric", {"cut": 0.3})
    rows = {(r.run_id, r.kind, r.name, r.value) for r in read_runs(spark, path).collect()}
    assert rows == {("1", "param", "a", "1"), ("1", "metric", "cut", "0.3"), ("2", "metric", "cut", "0.2")}


def test_training_gate(spark, matrix, tmp_path):
    layout = Layout(str(tmp_path))
    with pytest.raises(training.TooFewRows):
        training.training_job(spark, matrix.limit(49), layout, CFG, "run")
    few = stage(matrix.orderBy("transaction_id").limit(50), "fifty")
    assert training.training_job(spark, few, layout, CFG, "run").version == 1


def test_jobs_record_their_runs_and_store_scores(spark, matrix, tmp_path):
    layout = Layout(str(tmp_path))
    rows = matrix.withColumn("customer_id", F.lit("C"))
    done = training.training_job(spark, rows, layout, CFG, "train")
    assert done.metrics["roc_auc"] == 1.0 and done.metrics["recall"] == 1.0 and done.metrics["n_fraud"] == OUTLIERS
    stored = scoring.scoring_job(spark, rows, layout, CFG, "score")
    assert stored.count() == 2000
    runs = {(r.run_id, r.kind, r.name): r.value for r in read_runs(spark, layout.run_metrics).collect()}
    assert runs["train", "param", "features"].startswith("amount,amount_zscore,velocity_1h")
    assert runs["train", "param", "n_features"] == "10"
    assert runs["score", "metric", "n_scored"] == "2000"
    assert float(runs["score", "metric", "predicted_fraud_rate"]) == pytest.approx(0.02)
