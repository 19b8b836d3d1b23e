"""The message queue, or files with the same envelope where no queue connector is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnrisk.config import RiskConfig
from txnrisk.schemas import QUEUE, RECORD


def queue_stream(spark: SparkSession, cfg: RiskConfig) -> DataFrame:
    """Subscribe to the topic; needs the Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
        .option("subscribe", cfg.topic)
        .option("startingOffsets", cfg.starting_offsets)
        .option("maxOffsetsPerTrigger", cfg.max_offsets_per_trigger)
    )
    if cfg.queue_min_partitions:
        reader = reader.option("minPartitions", cfg.queue_min_partitions)
    return reader.load()


def queue_files(spark: SparkSession, path: str, cfg: RiskConfig) -> DataFrame:
    """Stream parquet files that carry the queue's seven columns.

    With ``cfg.archive``, a folder outside ``path`` on the same file system, files move there after
    their batch is committed and the next one begun. So each trigger lists new files and those of the
    last batches only (a run that ends leaves its last files); no other reader should then use ``path``.
    """
    reader = spark.readStream.schema(QUEUE).option("maxFileAge", cfg.max_file_age)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    if cfg.archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", cfg.archive)
    return reader.parquet(path)


def decode(envelope: DataFrame, record: StructType = RECORD) -> DataFrame:
    """JSON bytes to columns, with the queue's position and time; bad JSON leaves nulls.

    ``raw_value`` keeps the text, so that a rejected message can be looked at. The parsed struct
    is expanded by a generator: filters on its fields are not pushed below one, whereas below a
    projection each of them would parse the message again.
    """
    text = F.col("value").cast("string")
    return envelope.select(
        F.inline(F.array(F.from_json(text, record))),
        F.col("timestamp").alias("kafka_timestamp"),
        "partition",
        "offset",
        text.alias("raw_value"),
    )
