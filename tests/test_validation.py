from rows import bronze, record

from txnrisk.config import RiskConfig
from txnrisk.operators.validation import rule_counts
from txnrisk.plans import silver

CFG = RiskConfig()


def check(spark, **over):
    valid, invalid = silver.split(bronze(spark, record(**over)), CFG)
    broken = [r.failed_rules for r in invalid.collect()]
    assert valid.count() + len(broken) == 1
    return broken[0] if broken else None


def test_good_row(spark):
    assert check(spark) is None


def test_amount_bounds_are_inclusive(spark):
    assert check(spark, amount=0.01) is None
    assert check(spark, amount=50000.00) is None
    assert check(spark, amount=0.009) == ["amount"]
    assert check(spark, amount=50000.01) == ["amount"]
    assert check(spark, amount=None) == ["amount"]
    assert check(spark, amount=float("nan")) == ["amount"]


def test_currency(spark):
    assert check(spark, currency="USD") == ["currency"]
    assert check(spark, currency=None) == ["currency"]


def test_unreadable_time_is_invalid_and_does_not_fail(spark):
    assert check(spark, transaction_time="nope") == ["transaction_time"]
    assert check(spark, transaction_time=None) == ["transaction_time"]


def test_all_broken_rules_are_named(spark):
    got = check(spark, amount=-1.0, currency=None, transaction_id=None, customer_id=None, merchant_id=None)
    assert got == ["amount", "currency", "transaction_id", "customer_id", "merchant_id"]


def test_split_is_complete_and_counts_rules(spark):
    rows = bronze(
        spark,
        record(transaction_id="A"),
        record(transaction_id=None),
        record(transaction_id=None, currency="USD"),
        record(transaction_id="B", currency=None),
    )
    valid, invalid = silver.split(rows, CFG)
    assert valid.count() == 1 and invalid.count() == 3
    assert {r.rule: r.n_rows for r in rule_counts(invalid).collect()} == {"currency": 2, "transaction_id": 2}
