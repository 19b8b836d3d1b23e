"""Settings for every layer, gathered in one immutable object."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# Rules, feature constants, model settings and targets that results depend on.
MIN_AMOUNT = 0.01
MAX_AMOUNT = 50000.00
VALID_CURRENCIES = ("AUD",)
HIGH_RISK_CATEGORIES = ("electronics", "travel")
HIGH_RISK_HOURS = (1, 2, 3, 4, 5)
HOME_COUNTRY = "US"
VELOCITY_SECONDS = 3600
BASELINE_SECONDS = 604800
BURST_SECONDS = 60
BURST_COUNT = 10
FAST_VELOCITY = 3
FAST_VELOCITY_POINTS = 2
CONTAMINATION = 0.02
N_TREES = 100
MAX_SAMPLES = 256
SEED = 42
MIN_TRAINING_ROWS = 50
FRAUD_FRACTION = 0.02
HIGH_FRACTION = 0.10
MEDIUM_FRACTION = 0.25
SAMPLE_ROWS = 10
LATENCY_TARGET_SECONDS = {"bronze": 5, "silver": 30, "gold": 120}
RETENTION_DAYS = {"bronze": 7, "silver": 30, "gold": 90}
TRIGGERS = {"bronze": "2 seconds", "silver": "10 seconds", "gold": "30 seconds"}
WATERMARK = "10 minutes"
FEATURES = (
    "amount",
    "amount_zscore",
    "velocity_1h",
    "is_high_risk_hour",
    "is_high_risk_country",
    "is_high_risk_category",
    "card_not_present",
    "fraud_risk_score",
    "transaction_hour",
    "transaction_dow",
)


def _env(name: str, default: str):
    return field(default_factory=lambda: os.environ.get(name, default))


MAX_FILE_AGE = "36500d"


@dataclass(frozen=True)
class RiskConfig:
    """Rules and parameters; the defaults are the fixed values above."""

    bootstrap_servers: str = _env("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
    topic: str = _env("KAFKA_TOPIC", "transactions")
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int = 1000
    # More read tasks than queue partitions: a partition with a hot key is read in pieces.
    queue_min_partitions: int | None = None
    max_files_per_trigger: int | None = None
    # File streams skip files much older than the newest one read; backfills must not be skipped.
    max_file_age: str = MAX_FILE_AGE
    # Folder that message files move to once their batch is committed, so that listings do not grow.
    archive: str | None = None

    min_amount: float = MIN_AMOUNT
    max_amount: float = MAX_AMOUNT
    currencies: tuple[str, ...] = VALID_CURRENCIES

    # Event time that rows may be late in Silver's stream, such as WATERMARK; later ones and repeats are
    # dropped there. None: rows of any age are taken and refresh what they affect.
    watermark: str | None = None

    velocity_seconds: int = VELOCITY_SECONDS
    baseline_seconds: int = BASELINE_SECONDS
    burst_seconds: int = BURST_SECONDS
    burst_count: int = BURST_COUNT
    risk_hours: tuple[int, ...] = HIGH_RISK_HOURS
    risk_categories: tuple[str, ...] = HIGH_RISK_CATEGORIES
    home_country: str = HOME_COUNTRY

    contamination: float = CONTAMINATION
    n_trees: int = N_TREES
    max_samples: int = MAX_SAMPLES
    seed: int = SEED
    min_training_rows: int = MIN_TRAINING_ROWS
    fraud_fraction: float = FRAUD_FRACTION
    high_fraction: float = HIGH_FRACTION
    medium_fraction: float = MEDIUM_FRACTION

    mart_table: str = _env("TXNRISK_MART_TABLE", "fct_features")

    # Sides with more rows than this are joined by shuffle, never by broadcast.
    broadcast_rows: int = 500_000
    # Pieces a customer's rows are cut into when such a join is on the customer.
    salts: int = 16


@dataclass(frozen=True)
class Layout:
    """Where the layers live; every path sits below one root."""

    root: str = _env("TXNRISK_ROOT", "txnrisk-data")

    def _at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def bronze(self) -> str:
        return self._at("bronze")

    @property
    def bronze_quarantine(self) -> str:
        return self._at("quarantine", "bronze")

    @property
    def silver(self) -> str:
        return self._at("silver")

    @property
    def silver_quarantine(self) -> str:
        return self._at("quarantine", "silver")

    @property
    def gold(self) -> str:
        return self._at("gold")

    @property
    def scored(self) -> str:
        return self._at("scored")

    @property
    def models(self) -> str:
        return self._at("models")

    @property
    def run_metrics(self) -> str:
        return self._at("run_metrics")

    @property
    def stream_metrics(self) -> str:
        return self._at("stream_metrics")

    @property
    def progress(self) -> str:
        return self._at("progress")

    @property
    def mart(self) -> str:
        return self._at("mart", "days")

    @property
    def mart_index(self) -> str:
        return self._at("mart", "index")

    def checkpoint(self, layer: str) -> str:
        return self._at("checkpoints", layer)
