"""Gold: per-customer rolling features and risk flags over Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.config import RiskConfig
from txnrisk.functions.features import event_seconds, risk_flags, zscore
from txnrisk.operators.intervals import islands, within
from txnrisk.operators.rolling import Trailing, with_trailing_stats
from txnrisk.sources.tables import DAY_SECONDS, ranges

SECOND = "event_sec"
AFFECTED = "_affected"


def _rolled(silver: DataFrame, counts: list[Trailing], moments: list[Trailing]) -> DataFrame:
    return with_trailing_stats(
        silver.withColumn(SECOND, event_seconds()),
        "customer_id",
        SECOND,
        counted="transaction_id",
        counts=counts,
        value="amount",
        moments=moments,
    )


def velocity(silver: DataFrame, cfg: RiskConfig) -> DataFrame:
    return _rolled(silver, [Trailing("velocity_1h", cfg.velocity_seconds)], []).drop(SECOND)


def bursts(silver: DataFrame, cfg: RiskConfig, count: int | None = None) -> DataFrame:
    """Card-testing signal: many transactions of one customer within a minute."""
    least = cfg.burst_count if count is None else count
    rolled = _rolled(silver, [Trailing("velocity_60s", cfg.burst_seconds)], []).drop(SECOND)
    return rolled.withColumn("is_burst", F.col("velocity_60s") >= least)


def baseline(silver: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Mean and sample standard deviation of the customer's amounts over the baseline span, per row."""
    return _rolled(silver, [], [Trailing("amount_7d", cfg.baseline_seconds)]).drop(SECOND)


def features(silver: DataFrame, cfg: RiskConfig) -> DataFrame:
    """All Gold columns but the processing stamp; ``silver`` must be unique by transaction."""
    rolled = _rolled(
        silver,
        [Trailing("velocity_1h", cfg.velocity_seconds)],
        [Trailing("amount_7d", cfg.baseline_seconds)],
    )
    score = zscore(F.col("amount"), F.col("amount_7d_mean"), F.col("amount_7d_stddev"))
    return rolled.withColumns({"amount_zscore": score, **risk_flags(cfg)}).drop(
        SECOND, "amount_7d_mean", "amount_7d_stddev"
    )


def stamped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("gold_processed_at", F.current_timestamp())


def _reach(cfg: RiskConfig) -> int:
    return max(cfg.baseline_seconds, cfg.velocity_seconds)


def places(rows: DataFrame) -> DataFrame:
    return rows.select("customer_id", event_seconds().alias(SECOND))


def touched_spans(places: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Stretches of event time per customer with new, changed or replaced rows (customer_id, event_sec).

    Rows further apart than the longest look-back are in different stretches, since what is between
    them is affected by neither.
    """
    return islands(places, "customer_id", SECOND, _reach(cfg))


def days_in_reach(spans: DataFrame, cfg: RiskConfig) -> list[tuple[int, int]]:
    """The event days of which :func:`in_reach` can keep rows, over all customers, as stretches.

    Days of no customer's stretch are not among them, however far apart the stretches are.
    """
    low, high = ((F.col(c) + d * _reach(cfg)) / DAY_SECONDS for c, d in (("first_sec", -1), ("last_sec", 1)))
    days = spans.select(F.explode(F.sequence(F.floor(low), F.floor(high))).alias("day")).distinct()
    return ranges({r[0] for r in days.collect()})


def in_reach(silver: DataFrame, spans: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Rows needed to refresh what changes within the stretches affect.

    A change at time t alters the frames of that customer's rows in [t, t + look-back]; to
    compute those, rows from t - look-back on are needed. The column ``AFFECTED`` tells them apart.
    """
    return within(
        silver, event_seconds(), spans, "customer_id", before=_reach(cfg), after=_reach(cfg), tile=_reach(cfg),
        spread_by="transaction_id", max_rows=cfg.broadcast_rows, salts=cfg.salts, mark=(AFFECTED, 0),
    )


def refreshed(reached: DataFrame, spans: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Features of the affected rows among those :func:`in_reach` of the current Silver table for the same stretches."""
    return features(reached, cfg).where(AFFECTED).drop(AFFECTED)
