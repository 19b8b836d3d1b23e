"""Named queries over the ``events`` table: one per operator or group of operators.

Each takes (spark, sf_dir) and returns a DataFrame over the whole table. Times come out as text
and measured values rounded to six digits, so that other engines can be compared with.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnrisk import schemas
from txnrisk.config import FEATURES, WATERMARK, Layout, RiskConfig
from txnrisk.functions.features import FLAGS
from txnrisk.functions.labels import inverted, label
from txnrisk.operators import evaluate, monitor, validation
from txnrisk.operators.forest import train_forest
from txnrisk.operators.keyed import latest_per_key, upsert
from txnrisk.plans import bronze, gold, mart, scoring, silver, training
from txnrisk.session import new_folder, prepare, stage
from txnrisk.sinks.append import append_batch
from txnrisk.sinks.maintenance import compact, retained
from txnrisk.sinks.retention import expire
from txnrisk.sinks.runs import read_runs, record_run
from txnrisk.sinks.upsert import upsert_batch
from txnrisk.sources import events
from txnrisk.sources.queue import queue_files
from txnrisk.sources.tables import (
    LOG_ID,
    current_view,
    day_of,
    mart_or_gold,
    read_days,
    read_log,
    scan_tree,
    snapshot_manifest,
    snapshot_path,
)
from txnrisk.streaming import layers
from txnrisk.streaming.dedupe import deduplicated_stream
from txnrisk.streaming.metrics import BatchMetrics, read_metrics

Query = Callable[[SparkSession, str], DataFrame]
CFG = RiskConfig()
QUERIES: dict[str, Query] = {}

RECORD_COLUMNS = tuple(schemas.RECORD.fieldNames())
GOLD_ADDED = ("velocity_1h", "amount_zscore", *FLAGS)


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepare(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def six(name: str | Column, alias: str | None = None) -> Column:
    """Six decimals, and no negative zero."""
    value = F.col(name) if isinstance(name, str) else name
    return (F.round(value, 6) + F.lit(0.0)).alias(alias or name)


def shown(name: str) -> Column:
    if name == "transaction_time":
        return events.iso_time(name).alias(name)
    if name == "amount_zscore":
        return six(name)
    return F.col(name)


def show(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[shown(n) for n in names])


# -- shared inputs ---------------------------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.build(events.bronze_rows(spark, sf_dir), CFG)


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a table: rolling features read it twice, for the totals per second and for the rows."""
    return stage(_silver(spark, sf_dir), "silver")


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.features(_stored_silver(spark, sf_dir), CFG)


def _mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.feature_mart(_gold(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a deterministic stand-in score, stored as a scoring run stores them."""
    score = six(-F.abs("amount_zscore"), scoring.SCORE)
    rows = _gold(spark, sf_dir).select("transaction_id", "customer_id", "amount", "is_fraud", score)
    return stage(rows, "stand-in-scores")


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    return scoring.with_predictions(scored, scoring.score_cuts(scored, CFG))


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows as three arrival batches, whole ranges of days, the second and third late."""
    day = F.dayofmonth("kafka_timestamp")
    arrival = F.when(day.between(11, 20), 0).when(day <= 10, 1).otherwise(2)
    rows = events.bronze_rows(spark, sf_dir).withColumns(
        {"batch_id": arrival.cast("bigint"), "ingested_at": F.current_timestamp()}
    )
    return rows.select(*schemas.bronze().fieldNames())


def _stored_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrival batches as Bronze stores them, a partition each: a batch is read several times."""
    path = new_folder(spark, "arrivals")
    append_batch(_ingested(spark, sf_dir), path)
    return spark.read.schema(schemas.bronze()).parquet(path)


ARRIVALS = (0, 1, 2)


def _arrival(rows: DataFrame, batch_id: int) -> DataFrame:
    return rows.where(F.col("batch_id") == batch_id)


# -- records and Bronze ----------------------------------------------------------------------


@query
def txn_records(spark, sf_dir):
    return show(events.records(spark, sf_dir), *RECORD_COLUMNS, "partition", "offset")


def _decoded(spark, sf_dir):
    return bronze.parsed(events.envelopes(spark, sf_dir), 0)


@query
def bronze_parsed(spark, sf_dir):
    return _decoded(spark, sf_dir).select(*RECORD_COLUMNS, "partition", "offset", "batch_id")


@query
def bronze_valid(spark, sf_dir):
    return bronze.accepted(_decoded(spark, sf_dir)).select(*RECORD_COLUMNS, "partition", "offset")


@query
def bronze_quarantine(spark, sf_dir):
    rows = bronze.quarantined(_decoded(spark, sf_dir))
    has_raw = F.col("raw_value").contains(F.col("customer_id")).alias("has_raw_value")
    return rows.select(*RECORD_COLUMNS, "partition", "offset", has_raw)


@query
def quarantine_written(spark, sf_dir):
    """What Bronze's writer sets apart, read back: records without a required field, and messages that are no JSON."""
    layout = Layout(new_folder(spark, "quarantine"))
    layers.bronze_batch(layout)(events.rough_envelopes(spark, sf_dir), 0)
    no_json = F.col("raw_value").startswith("{bad")
    return spark.read.json(layout.bronze_quarantine, schema=schemas.bronze().add("raw_value", "string")).select(
        "transaction_id", "customer_id", "amount", "partition", "offset",
        events.iso_time("kafka_timestamp").alias("kafka_time"),
        F.when(no_json, F.col("raw_value")).alias("raw_value"),
    )


@query
def bronze_batch_metrics(spark, sf_dir):
    counted = bronze.batch_metrics(_decoded(spark, sf_dir))
    return counted.select("n_rows", "n_valid", "n_quarantined", six("fraud_rate"))


# -- Silver ----------------------------------------------------------------------------------


def _split(spark, sf_dir):
    return silver.split(events.bronze_rows(spark, sf_dir), CFG)


@query
def silver_valid(spark, sf_dir):
    return show(_split(spark, sf_dir)[0], *RECORD_COLUMNS, "offset")


@query
def silver_invalid_reasons(spark, sf_dir):
    invalid = _split(spark, sf_dir)[1]
    return invalid.select("offset", "amount", "currency", F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def silver_rule_counts(spark, sf_dir):
    return validation.rule_counts(_split(spark, sf_dir)[1])


@query
def silver_rules_broken(spark, sf_dir):
    """Rows that break each of the six rules, in records of which some break any."""
    return validation.rule_counts(silver.split(events.rough_bronze_rows(spark, sf_dir), CFG)[1])


@query
def silver_rows_broken(spark, sf_dir):
    """The rejected rows themselves, with the rules each breaks."""
    invalid = silver.split(events.rough_bronze_rows(spark, sf_dir), CFG)[1]
    return invalid.select("offset", "amount", "customer_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def silver_dedup(spark, sf_dir):
    return show(_silver(spark, sf_dir), *RECORD_COLUMNS, "partition", "offset")


@query
def silver_upsert(spark, sf_dir):
    """Three batches merged in turn; within a batch the first arrival wins, across batches the last."""
    rows = _ingested(spark, sf_dir)
    table = silver.build(_arrival(rows, 0), CFG)
    for batch_id in ARRIVALS[1:]:
        table = upsert(table, silver.build(_arrival(rows, batch_id), CFG), "transaction_id")
    return show(table, *RECORD_COLUMNS, "offset")


# -- Gold ------------------------------------------------------------------------------------


@query
def gold_velocity_1h(spark, sf_dir):
    return gold.velocity(_stored_silver(spark, sf_dir), CFG).select("transaction_id", "customer_id", "velocity_1h")


@query
def gold_amount_zscore(spark, sf_dir):
    return show(_gold(spark, sf_dir), "transaction_id", "amount", "amount_zscore")


@query
def gold_risk_flags(spark, sf_dir):
    return show(_gold(spark, sf_dir), "transaction_id", *FLAGS)


@query
def gold_rolling_stats(spark, sf_dir):
    rows = gold.baseline(_stored_silver(spark, sf_dir), CFG)
    return rows.select("transaction_id", six("amount_7d_mean"), six("amount_7d_stddev"))


@query
def gold_features(spark, sf_dir):
    return show(_gold(spark, sf_dir), *RECORD_COLUMNS, *GOLD_ADDED)


@query
def gold_burst_60s(spark, sf_dir):
    """Two per minute count as a burst here: the events are sparse."""
    rows = gold.bursts(_stored_silver(spark, sf_dir), CFG, count=2)
    return rows.select("transaction_id", "customer_id", "velocity_60s", "is_burst")


def _write_layers(spark, sf_dir, layout):
    """Feed the arrival batches through the Silver and Gold batch writers, one after the other; gives their ids."""
    rows = _stored_arrivals(spark, sf_dir)
    to_silver, to_gold = layers.silver_batch(layout, CFG), layers.gold_batch(layout, CFG)
    for batch_id in ARRIVALS:
        to_silver(_arrival(rows, batch_id), batch_id)
        log = read_log(spark, layout.silver, schemas.silver())
        to_gold(log.where(F.col(LOG_ID) == batch_id), batch_id)
        yield batch_id


@query
def gold_incremental(spark, sf_dir):
    """Gold built batch by batch, late batches refreshing what they affect."""
    layout = Layout(new_folder(spark, "gold-incremental"))
    for _ in _write_layers(spark, sf_dir, layout):
        pass
    return show(current_view(spark, layout.gold, schemas.gold()), *RECORD_COLUMNS, *GOLD_ADDED)


# -- tables ----------------------------------------------------------------------------------


@query
def union_by_name_scan(spark, sf_dir):
    """Files written before and after the country column was added, read as one table."""
    path = new_folder(spark, "tree")
    rows = _silver(spark, sf_dir)
    early = F.dayofmonth("transaction_time") <= 15
    kept = rows.select("transaction_id", "customer_id", "amount", "location_country", "transaction_time")
    kept.where(early).drop("location_country", "transaction_time").write.parquet(f"{path}/v1")
    kept.where(~early).drop("transaction_time").write.parquet(f"{path}/v2")
    return scan_tree(spark, path).select("transaction_id", "customer_id", "amount", "location_country")


@query
def append_schema_merge(spark, sf_dir):
    """Bronze batches of which the later ones carry a new column; replaying one adds nothing."""
    path = new_folder(spark, "evolving")
    rows = _ingested(spark, sf_dir).select("transaction_id", "amount", "offset", "batch_id", "card_present")
    append_batch(_arrival(rows, 0).drop("card_present"), path)
    append_batch(rows.where("batch_id > 0"), path)
    append_batch(_arrival(rows, 2), path)
    merged = spark.read.option("mergeSchema", True).parquet(path)
    return merged.select("transaction_id", "amount", "offset", F.col("batch_id").cast("bigint"), "card_present")


def _silver_log(spark, sf_dir, table):
    rows = _ingested(spark, sf_dir)
    for batch_id in ARRIVALS:
        upsert_batch(silver.stamped(silver.build(_arrival(rows, batch_id), CFG)), table, batch_id)
        yield batch_id


@query
def compaction(spark, sf_dir):
    """A snapshot taken after two batches, a third batch on top of it."""
    table = new_folder(spark, "compacted")
    for batch_id in _silver_log(spark, sf_dir, table):
        if batch_id == 1:
            compact(spark, table, schemas.silver())
    return show(current_view(spark, table, schemas.silver()), *RECORD_COLUMNS, "offset")


@query
def change_log_latest(spark, sf_dir):
    """Latest version per key straight from the change log, with the batch it came from."""
    table = new_folder(spark, "log")
    for _ in _silver_log(spark, sf_dir, table):
        pass
    log = read_log(spark, table, schemas.silver())
    return latest_per_key(log, "transaction_id", LOG_ID).select("transaction_id", "amount", "offset", LOG_ID)


@query
def retention_filter(spark, sf_dir):
    kept = retained(_silver(spark, sf_dir), "2024-01-31 00:00:00", 7)
    return show(kept, "transaction_id", "customer_id", "amount", "transaction_time")


@query
def bronze_retention(spark, sf_dir):
    """Daily Bronze batches, half of them read by Silver's stream when the retention job runs on the 31st.

    Those past seven days would go, but what Silver has not read, or may still read on in, stays.
    """
    layout = Layout(new_folder(spark, "retention"))
    day = F.dayofmonth("kafka_timestamp")
    rows = events.bronze_rows(spark, sf_dir).withColumns({"batch_id": (day - 1).cast("bigint"), "ingested_at": F.col("kafka_timestamp")})
    rows = rows.select(*schemas.bronze().fieldNames())
    append_batch(rows.where("batch_id < 15"), layout.bronze)
    layers.start_silver(spark, layout, CFG, None).awaitTermination()
    append_batch(rows.where("batch_id >= 15"), layout.bronze)
    expire(spark, layout, "2024-01-31 00:00:00")
    kept = spark.read.schema(schemas.bronze()).parquet(layout.bronze)
    return kept.select(*RECORD_COLUMNS, "offset", "batch_id")


@query
def compaction_days(spark, sf_dir):
    """The valid versions of the days of a snapshot after each arrival batch, and their rows.

    A batch rewrites only the days in which it adds, changes or leaves rows.
    """
    table = new_folder(spark, "compacted-days")
    for _ in _silver_log(spark, sf_dir, table):
        compact(spark, table, schemas.silver())
    manifest = snapshot_manifest(spark, table)
    versions = spark.createDataFrame(sorted(manifest.days.items()), "day bigint, version bigint")
    rows = read_days(spark, snapshot_path(table), schemas.silver(), manifest)
    return rows.groupBy(day_of().alias("day")).agg(F.count(F.lit(1)).alias("n_rows")).join(versions, "day")


# -- feature mart ----------------------------------------------------------------------------

MART_COLUMNS = ("transaction_id", "customer_id", "is_fraud", *FEATURES)


@query
def feature_mart(spark, sf_dir):
    return show(_mart(spark, sf_dir), *MART_COLUMNS)


@query
def mart_sql_view(spark, sf_dir):
    """The mart through SQL: a view over a Gold view, found in the catalog by name."""
    _gold(spark, sf_dir).createOrReplaceTempView("gold_current")
    mart.create_mart_view(spark, "gold_current", "fct_features_view")
    found = mart_or_gold(spark, "fct_features_view", spark.table("gold_current"), mart.feature_mart)
    return show(found, *MART_COLUMNS)


@query
def mart_fallback(spark, sf_dir):
    """No mart table of that name exists, so the features are derived from Gold."""
    found = mart_or_gold(spark, "no_such_mart", _gold(spark, sf_dir), mart.feature_mart)
    return show(found, *MART_COLUMNS)


@query
def mart_table(spark, sf_dir):
    """The mart in the catalog, brought up to date after the second and the third arrival batch."""
    layout = Layout(new_folder(spark, "mart"))
    name = f"fct_features_{uuid.uuid4().hex}"
    for batch_id in _write_layers(spark, sf_dir, layout):
        if batch_id > 0:
            mart.refresh_mart(spark, layout, name)
    return show(spark.table(name), *MART_COLUMNS)


@query
def feature_matrix(spark, sf_dir):
    rows = mart.feature_matrix(_mart(spark, sf_dir))
    return rows.select("transaction_id", *[shown(f) for f in FEATURES], "label")


@query
def label_rate(spark, sf_dir):
    return mart.mean_label(_silver(spark, sf_dir)).select(six("label_rate"))


@query
def sample_counts(spark, sf_dir):
    return evaluate.sample_counts(_silver(spark, sf_dir), "is_fraud")


# -- scoring ---------------------------------------------------------------------------------


def _cuts_row(spark, cuts):
    # Scores have six decimals, so values interpolated between two of them need more.
    row = spark.createDataFrame([(cuts.fraud, cuts.high, cuts.medium)], "p2 double, p10 double, p25 double")
    return row.select(*[(F.round(c, 9) + F.lit(0.0)).alias(c) for c in row.columns])


@query
def score_thresholds(spark, sf_dir):
    return _cuts_row(spark, scoring.score_cuts(_scored(spark, sf_dir), CFG))


@query
def score_thresholds_by_bins(spark, sf_dir):
    """The same cuts with 64 bins a pass, so in more passes over the rows near them."""
    return _cuts_row(spark, scoring.score_cuts(_scored(spark, sf_dir), CFG, bins=64))


@query
def predicted_fraud(spark, sf_dir):
    return _flagged(spark, sf_dir).select("transaction_id", scoring.SCORE, "is_predicted_fraud")


@query
def risk_tiers(spark, sf_dir):
    return _flagged(spark, sf_dir).select("transaction_id", scoring.SCORE, "risk_tier")


@query
def tier_counts(spark, sf_dir):
    return scoring.tier_counts(_flagged(spark, sf_dir))


@query
def scoring_run_metrics(spark, sf_dir):
    totals = scoring.run_summary(_flagged(spark, sf_dir))
    return totals.select(
        "n_scored", "n_predicted_fraud", six("predicted_fraud_rate"), "n_actual_fraud", six("actual_fraud_rate")
    )


@query
def run_metrics_log(spark, sf_dir):
    """The run summary as rows of the metrics table."""
    path = new_folder(spark, "runs")
    record_run(spark, path, "run-1", "metric", scoring.run_summary(_flagged(spark, sf_dir)).first().asDict())
    return read_runs(spark, path).select("run_id", "kind", "name", six(F.col("value").cast("double"), "value"))


@query
def top_risk_sample(spark, sf_dir):
    return scoring.high_risk_sample(_flagged(spark, sf_dir))


# -- evaluation ------------------------------------------------------------------------------


@query
def classification_metrics(spark, sf_dir):
    report = evaluate.classification_metrics(_flagged(spark, sf_dir), "is_fraud", "is_predicted_fraud")
    return report.select(six("precision"), six("recall"), six("f1"), "n_samples", "n_fraud", "n_legit")


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_flagged(spark, sf_dir), "is_fraud", "is_predicted_fraud")


@query
def roc_auc(spark, sf_dir):
    rows = _scored(spark, sf_dir).select(label().alias("label"), inverted(F.col(scoring.SCORE)).alias("risk"))
    return spark.createDataFrame([(evaluate.roc_auc(rows, "label", "risk"),)], "roc_auc double").select(six("roc_auc"))


# -- forest ----------------------------------------------------------------------------------


def _rounded_mart(spark, sf_dir):
    """The mart with z-scores of six digits, since sums in another order change their last ones."""
    return stage(_mart(spark, sf_dir).withColumn("amount_zscore", six("amount_zscore")), "mart")


def _scores(df):
    return df.select("transaction_id", six(scoring.SCORE), "is_predicted_fraud", "risk_tier")


def _forest(spark, sf_dir):
    matrix = stage(mart.feature_matrix(_rounded_mart(spark, sf_dir)), "matrix")
    return matrix, train_forest(matrix, "transaction_id", FEATURES, matrix.count(), CFG)


@query
def forest_nodes(spark, sf_dir):
    nodes = _forest(spark, sf_dir)[1]
    return nodes.select(*[six(c) if c == "split" else F.col(c) for c in nodes.columns])


@query
def forest_tree_sizes(spark, sf_dir):
    """Rows each tree was grown on, read off its root."""
    nodes = _forest(spark, sf_dir)[1]
    return nodes.where("node_id = 1").select("tree_id", "size", "sample_size")


@query
def forest_scores(spark, sf_dir):
    matrix, nodes = _forest(spark, sf_dir)
    scored = stage(scoring.score_mart(spark, matrix, stage(nodes, "nodes"), CFG), "forest-scores")
    return _scores(scoring.with_predictions(scored, scoring.score_cuts(scored, CFG)))


@query
def train_and_score(spark, sf_dir):
    """Both jobs end to end: gate, fit, register, load the latest version, score, store."""
    layout = Layout(new_folder(spark, "runs"))
    rows = _rounded_mart(spark, sf_dir)
    training.training_job(spark, rows, layout, CFG, "train-1")
    return _scores(scoring.scoring_job(spark, rows, layout, CFG, "score-1"))


@query
def training_run_log(spark, sf_dir):
    """Parameters (``value``) and evaluation (``measure``) that a training run records."""
    layout = Layout(new_folder(spark, "runs"))
    training.training_job(spark, _rounded_mart(spark, sf_dir), layout, CFG, "train-1")
    is_param = F.col("kind") == "param"
    return read_runs(spark, layout.run_metrics).select(
        "run_id", "kind", "name",
        F.when(is_param, F.col("value")).alias("value"),
        six(F.when(~is_param, F.col("value")).cast("double"), "measure"),
    )


# -- streams ---------------------------------------------------------------------------------


def _queue_files(spark, sf_dir):
    path = new_folder(spark, "queue")
    events.envelopes(spark, sf_dir).select(*schemas.QUEUE.fieldNames()).write.parquet(path)
    return path


def _bronze_stream(spark, sf_dir, label):
    layout = Layout(new_folder(spark, label))
    layers.start_bronze(queue_files(spark, _queue_files(spark, sf_dir), CFG), layout, None).awaitTermination()
    return layout


@query
def stream_bronze(spark, sf_dir):
    layout = _bronze_stream(spark, sf_dir, "stream-bronze")
    rows = spark.read.schema(schemas.bronze()).parquet(layout.bronze)
    return rows.select(*RECORD_COLUMNS, "partition", "offset")


@query
def stream_silver_gold(spark, sf_dir):
    """Queue to Gold through the three chained streams."""
    layout = _bronze_stream(spark, sf_dir, "stream-gold")
    layers.start_silver(spark, layout, CFG, None).awaitTermination()
    layers.start_gold(spark, layout, CFG, None).awaitTermination()
    return show(current_view(spark, layout.gold, schemas.gold()), *RECORD_COLUMNS, *GOLD_ADDED)


@query
def stream_dedup_watermark(spark, sf_dir):
    source, out = new_folder(spark, "silver-valid"), new_folder(spark, "deduped")
    valid = _split(spark, sf_dir)[0].select("transaction_id", "customer_id", "transaction_time")
    valid.write.parquet(source)
    stream = spark.readStream.schema(valid.schema).parquet(source)
    (
        deduplicated_stream(stream)
        .select("transaction_id")
        .writeStream.option("checkpointLocation", new_folder(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(out, format="parquet")
        .awaitTermination()
    )
    return spark.read.schema("transaction_id string").parquet(out)


FILES, IDLE_AFTER = 5, (2, 4)
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _arrival_file(spark, sf_dir, path, i, last):
    """A fifth of the messages in the order of events, of which every 17th comes two fifths late.

    Any number of tasks write it, so what is one file of a small queue is several of a large one.
    """
    rows = events.envelopes(spark, sf_dir)
    late = F.when(F.col("offset") % 17 == 5, 2).otherwise(0)
    number = F.least(F.lit(FILES - 1), F.floor(F.col("offset") * FILES / (last + 1)) + late)
    rows.where(number == i).select(*schemas.QUEUE.fieldNames()).write.mode("append").parquet(path)


def _late_streams(spark, sf_dir):
    """Bronze and Silver with a watermark, a fifth of the queue per micro-batch, idle after three and after five.

    What one run finds is one micro-batch of either layer, in whatever number of files it lies. A limit of
    files per micro-batch would cut a fifth that several tasks wrote, and move the watermark in between.
    Only where the streams are idle does a micro-batch without data move it on.
    """
    layout, queue = Layout(new_folder(spark, "late-streams")), new_folder(spark, "late-queue")
    cfg = RiskConfig(watermark=WATERMARK)
    last = events.records(spark, sf_dir).agg(F.max("offset")).first()[0]
    for i in range(FILES):
        _arrival_file(spark, sf_dir, queue, i, last)
        metrics = BatchMetrics(spark, layout.stream_metrics).start()
        before = spark.conf.get(IDLE_BATCHES)
        spark.conf.set(IDLE_BATCHES, str(i in IDLE_AFTER).lower())
        try:
            layers.start_bronze(queue_files(spark, queue, cfg), layout, None, metrics=metrics).awaitTermination()
            layers.start_silver(spark, layout, cfg, None, metrics=metrics).awaitTermination()
        finally:
            spark.conf.set(IDLE_BATCHES, before)
            metrics.stop()
    return layout


@query
def stream_silver_watermark(spark, sf_dir):
    """Transactions that pass Silver's watermark: the late ones of a file don't."""
    layout = _late_streams(spark, sf_dir)
    return current_view(spark, layout.silver, schemas.silver()).select("transaction_id")


@query
def stream_batch_metrics(spark, sf_dir):
    """Counters of every micro-batch with rows, by file, from the metrics table; late rows as Spark's progress has them."""
    metrics = read_metrics(spark, _late_streams(spark, sf_dir).stream_metrics)
    wide = metrics.groupBy("layer", "micro_batch").pivot(
        "name", ["n_rows", "n_valid", "n_quarantined", "fraud_rate", "n_invalid", "n_late", "triggerExecution_ms"]
    ).agg(F.first("value"))
    wide = wide.where("n_rows is not null")
    file = F.row_number().over(Window.partitionBy("layer").orderBy("micro_batch")) - 1
    counts = [F.col(c).cast("bigint").alias(c) for c in ("n_rows", "n_valid", "n_quarantined", "n_invalid", "n_late")]
    timed = (F.col("triggerExecution_ms") > 0).alias("has_time")
    return wide.select("layer", file.alias("file"), *counts, six("fraud_rate"), timed)


# -- monitoring ------------------------------------------------------------------------------


@query
def sla_latency(spark, sf_dir):
    """Stamps set a fixed, row-dependent time after arrival."""
    arrival = F.unix_micros("kafka_timestamp")

    def after(step: int, most_ms: int) -> Column:
        return F.timestamp_micros(arrival + F.col("offset") * step % most_ms * 1000)

    rows = _silver(spark, sf_dir).withColumns(
        {
            "ingested_at": after(37, 7_000),
            "silver_processed_at": after(101, 29_000),
            "gold_processed_at": after(977, 130_000),
        }
    )
    report = monitor.layer_latency(rows, accuracy=1_000_000)
    return report.select(
        "layer", "target_seconds", "n_rows", six("p50_seconds"), six("p95_seconds"), six("max_seconds"),
        "n_late", "breached",
    )
