from pyspark.sql import functions as F
from rows import silver

from txnrisk.config import FEATURES, RiskConfig
from txnrisk.plans import gold, mart
from txnrisk.sources.tables import mart_or_gold

CFG = RiskConfig()
HOUR, DAY = 3600, 86_400


def one(spark, **over):
    return gold.features(silver(spark, over), CFG).first()


def test_risk_hours(spark):
    seen = [one(spark, sec=s).is_high_risk_hour for s in (HOUR - 1, HOUR, 6 * HOUR - 1, 6 * HOUR)]
    assert seen == [False, True, True, False]


def test_country_category_and_card(spark):
    assert one(spark, location_country="US").is_high_risk_country is False
    assert one(spark, location_country="AU").is_high_risk_country is True
    assert one(spark, location_country=None).is_high_risk_country is None
    assert one(spark, merchant_category="travel").is_high_risk_category is True
    assert one(spark, merchant_category="fuel").is_high_risk_category is False
    assert one(spark, card_present=False).card_not_present is True


def test_home_country_is_a_setting(spark):
    rows = gold.features(silver(spark, {"location_country": "AU"}), RiskConfig(home_country="AU"))
    assert rows.first().is_high_risk_country is False


def test_mart_values(spark):
    rows = silver(spark, {"sec": 0}, {"sec": 6 * DAY, "location_country": None, "card_present": None})
    got = {r.transaction_id: r for r in mart.feature_mart(gold.features(rows, CFG)).collect()}
    assert got["T0"].transaction_dow == 0 and got["T1"].transaction_dow == 6
    assert got["T1"].is_high_risk_country == 0 and got["T1"].card_not_present == 0


def test_score_weights(spark):
    flags = {"merchant_category": "travel", "location_country": "GB", "card_present": False}
    rows = silver(spark, *[{"sec": 2 * HOUR + i, **flags} for i in range(3)])
    got = {r.transaction_id: (r.velocity_1h, r.fraud_risk_score) for r in mart.feature_mart(gold.features(rows, CFG)).collect()}
    assert got == {"T0": (1, 4), "T1": (2, 4), "T2": (3, 6)}


def test_feature_nulls_become_zero(spark):
    rows = gold.features(silver(spark, {}), CFG).withColumn("amount_zscore", F.lit(None).cast("double"))
    assert mart.feature_mart(rows).first().amount_zscore == 0.0


def test_matrix_order_and_label(spark):
    matrix = mart.feature_matrix(mart.feature_mart(gold.features(silver(spark, {"is_fraud": True}), CFG)))
    assert matrix.columns == ["transaction_id", *FEATURES, "label"]
    assert matrix.first().label == 1


def test_sql_view_equals_the_dataframe_mart(spark):
    rows = gold.features(silver(spark, {"sec": 5, "card_present": None}, {"sec": 3 * DAY, "amount": 99.5}), CFG)
    rows.createOrReplaceTempView("gold_for_view")
    view = mart.create_mart_view(spark, "gold_for_view", "mart_for_test")
    table = mart.feature_mart(rows)
    assert sorted(view.columns) == sorted(table.columns)
    assert sorted(map(str, view.select(*FEATURES).collect())) == sorted(map(str, table.select(*FEATURES).collect()))
    assert mart_or_gold(spark, "mart_for_test", rows, None).columns == view.columns


def test_missing_mart_falls_back_to_gold(spark):
    rows = gold.features(silver(spark, {}), CFG)
    assert mart_or_gold(spark, "not_there", rows, mart.feature_mart).count() == 1
