"""Batch and streaming readers of layer tables, parquet trees and the feature mart.

An upserted layer (Silver, Gold) is a change log and, once compacted, a snapshot of the latest versions.

* The log has a folder per batch, in it a folder per event day. A batch appears whole, by a rename.
* The key index has the key, customer and event second of every row of the log, by batch and by bucket
  of the key's hash, with Bloom filters on the key; a compaction merges batches into runs. It tells what
  versions of a key there are, and where they lie in time, by reading the key's bucket alone.
* The snapshot has versions of days. A manifest names the valid version of each day, so a day that
  does not change is not written again, and readers see one manifest or the next.

Streams read the log, which is only ever appended to; batch readers see the current view, one row per key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from txnrisk.config import MAX_FILE_AGE
from txnrisk.operators.keyed import latest_per_key

LOG_ID = "log_batch_id"
COVERED = "covered_batch_id"
DAY = "event_day"
DAY_SECONDS = 86_400
KEY = "transaction_id"
BUCKET = "key_bucket"
# Part of the layout: tables written with another number can't be read.
KEY_BUCKETS = 16
MANIFEST = "manifest_id"
VERSION = "day_version"
# Keys that are named in a filter, so that Bloom filters skip files; as many as Spark pushes down one by one.
MOST_LISTED = 10
# Keys that are broadcast to look them up.
MOST_BROADCAST = 500_000
INDEX = "transaction_id string, customer_id string, event_sec bigint"
# Room for the batches of one checkpoint: 2^40, at one a second 35,000 years.
GENERATION = 2**40
NOTE = "generation-"


def log_path(table: str) -> str:
    return f"{table}/log"


def snapshot_path(table: str) -> str:
    return f"{table}/snapshot"


def snapshot_index_path(table: str) -> str:
    return f"{table}/snapshot_index"


def keys_path(table: str) -> str:
    return f"{table}/keys"


def key_runs_path(table: str) -> str:
    return f"{table}/key_runs"


def key_bucket(key: str = KEY) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("bigint")


def day_of(time: str = "transaction_time") -> Column:
    return F.floor(F.col(time).cast("long") / DAY_SECONDS)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def make_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)


def create_file(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if it was there already."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(where)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder; one of the new name is deleted first."""
    where, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(to, True)
    if not fs.rename(where, to):
        raise OSError(f"can't rename {old} to {new}")


def delete_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the files and folders in a folder; none if there is no such folder."""
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [status.getPath().getName() for status in found]


def numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The n of all files and folders ``<prefix>n`` in a folder."""
    names = [n[len(prefix) :] for n in list_names(spark, path) if n.startswith(prefix)]
    return [int(n) for n in names if n.isdigit()]


def batch_number(generation: int, batch_id: int) -> int:
    """Batch ids start at 0 with every new checkpoint; later generations have higher numbers."""
    return generation * GENERATION + batch_id


def generation_of(
    spark: SparkSession, checkpoint: str, written: tuple[str, ...], partition: str, index: str | None = None
) -> int:
    """The generation of a stream's checkpoint among those that have written to its folders.

    A new checkpoint over written batches starts a generation, which is noted in the checkpoint;
    so its batches neither replace earlier ones nor hide behind a snapshot. ``index`` is the
    snapshot index, for batches whose partitions are gone.
    """
    noted = numbers(spark, checkpoint, NOTE)
    if noted:
        return max(noted)
    generation = 0
    if not path_exists(spark, f"{checkpoint}/offsets"):
        ids = [n for path in written for n in numbers(spark, path, f"{partition}=")]
        if index is not None and path_exists(spark, index):
            ids.append(spark.read.schema(f"{COVERED} bigint").parquet(index).agg(F.max(COVERED)).first()[0])
        generation = 1 + max(ids) // GENERATION if ids else 0
    create_file(spark, f"{checkpoint}/{NOTE}{generation}")
    return generation


def scan_tree(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All parquet files below a folder, columns matched by name, missing ones null.

    With a schema no file footers are read up front; without one they are merged.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if schema is not None:
        return reader.schema(schema).parquet(path)
    return reader.option("mergeSchema", True).parquet(path)


def _with(schema: StructType, *partitions: str) -> StructType:
    return StructType(schema.fields + [StructField(name, LongType()) for name in partitions])


def _log(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    return spark.read.schema(_with(schema, LOG_ID, DAY)).parquet(log_path(table))


def read_log(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """All versions of all rows, with the id of the batch that wrote them."""
    return _log(spark, table, schema).drop(DAY)


def layer_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Stream a layer's files as they are appended.

    A replayed batch replaces its own files, so a file that is gone by the time it is read is
    not an error: its replacement arrives under a new name, and the key upsert absorbs it.
    """
    reader = spark.readStream.schema(schema).option("ignoreMissingFiles", True)
    reader = reader.option("maxFileAge", MAX_FILE_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def log_stream(spark: SparkSession, table: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    return layer_stream(spark, log_path(table), _with(schema, LOG_ID, DAY), max_files).drop(DAY)


@dataclass(frozen=True)
class Manifest:
    """The valid version of each day of a snapshot, and the log batch up to which it holds."""

    number: int
    covered: int
    days: dict[int, int]


def manifest_schema() -> str:
    return f"{COVERED} bigint, {DAY} bigint, {VERSION} bigint"


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest in an index folder: a row per day, of which there are as many as in the calendar."""
    for number in sorted(numbers(spark, path, f"{MANIFEST}="), reverse=True):
        rows = spark.read.schema(manifest_schema()).parquet(f"{path}/{MANIFEST}={number}").collect()
        if rows:  # else it is still being written
            return Manifest(number, rows[0][COVERED], {r[DAY]: r[VERSION] for r in rows if r[DAY] is not None})
    return None


def write_manifest(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """One file, which makes the days' versions valid; a row without a day is there for a table without any."""
    rows = [(manifest.covered, day, version) for day, version in [(None, None), *sorted(manifest.days.items())]]
    written = spark.createDataFrame(rows, manifest_schema()).coalesce(1)
    written.write.mode("overwrite").parquet(f"{path}/{MANIFEST}={manifest.number}")


def ranges(days: set[int]) -> list[tuple[int, int]]:
    """Days as stretches without a gap, both ends included."""
    out: list[tuple[int, int]] = []
    for day in sorted(days):
        if out and day == out[-1][1] + 1:
            out[-1] = (out[-1][0], day)
        else:
            out.append((day, day))
    return out


def _on_days(days: list[tuple[int, int]]) -> Column:
    return reduce(or_, (F.col(DAY).between(a, b) for a, b in days), F.lit(False))


def read_days(
    spark: SparkSession, path: str, schema: StructType, manifest: Manifest, days: list[tuple[int, int]] | None = None
) -> DataFrame:
    """The valid versions of all days, or of those within stretches; other folders are not read."""
    rows = spark.read.schema(_with(schema, DAY, VERSION)).parquet(path)
    by_version: dict[int, list[int]] = {}
    for day, version in manifest.days.items():
        if days is None or any(a <= day <= b for a, b in days):
            by_version.setdefault(version, []).append(day)
    valid = [(F.col(VERSION) == v) & F.col(DAY).isin(held) for v, held in sorted(by_version.items())]
    return rows.where(reduce(or_, valid, F.lit(False))).drop(VERSION, DAY)


def snapshot_manifest(spark: SparkSession, table: str) -> Manifest | None:
    return read_manifest(spark, snapshot_index_path(table))


def key_index(spark: SparkSession, table: str, after: int | None = None) -> DataFrame:
    """(key, customer, event second, log id, bucket) of all versions, or of those of later batches."""
    manifest = snapshot_manifest(spark, table)
    covered = -1 if manifest is None else manifest.covered
    after = -1 if after is None else after
    schema = StructType.fromDDL(INDEX)
    found = spark.createDataFrame([], _with(schema, LOG_ID, BUCKET))
    if path_exists(spark, keys_path(table)):
        rows = spark.read.schema(_with(schema, LOG_ID, BUCKET)).parquet(keys_path(table))
        found = rows.where(F.col(LOG_ID) > max(covered, after))
    if after < covered:
        runs = spark.read.schema(_with(schema, LOG_ID, COVERED, BUCKET)).parquet(key_runs_path(table))
        runs = runs.where((F.col(COVERED) <= covered) & (F.col(LOG_ID) > after))
        found = found.unionByName(runs.drop(COVERED))
    return found


def lookup(spark: SparkSession, table: str, keys: DataFrame, after: int | None = None) -> DataFrame:
    """The key index for a table of keys: reads their buckets alone, and moves their rows alone.

    A few keys are named to the scan, whose Bloom filters then skip most files. Many are joined by a shuffle,
    which the planner, going by the size of files, might take for a small side.
    """
    wanted = keys.select(KEY).where(F.col(KEY).isNotNull())
    n, buckets = wanted.agg(F.count(F.lit(1)), F.collect_set(key_bucket())).first()
    index = key_index(spark, table, after).where(F.col(BUCKET).isin(buckets))
    if n <= MOST_LISTED:
        return index.where(F.col(KEY).isin([r[0] for r in wanted.collect()]))
    return index.join(F.broadcast(wanted) if n <= MOST_BROADCAST else wanted.hint("merge"), KEY, "left_semi")


def _newest(spark: SparkSession, table: str, versions: DataFrame, after: int | None) -> DataFrame:
    """The newest log id of the versions' keys. Beyond ``MOST_BROADCAST`` of them the index is grouped without
    a look at the keys first: a join with them would move all of it as well, and read the versions once more."""
    many = versions.count() > MOST_BROADCAST
    known = key_index(spark, table, after) if many else lookup(spark, table, versions, after)
    newest = known.groupBy(KEY).agg(F.max(LOG_ID).alias("_newest"))
    return newest.hint("merge") if many else newest


def positions(spark: SparkSession, table: str, keys: DataFrame) -> DataFrame:
    """(customer_id, event_sec) of the latest version of each of the keys that the table has."""
    place = F.max_by(F.struct("customer_id", "event_sec"), LOG_ID).alias("place")
    return lookup(spark, table, keys).groupBy(KEY).agg(place).select("place.*")


def current_view(
    spark: SparkSession,
    table: str,
    schema: StructType,
    narrow: Callable[[DataFrame], DataFrame] | None = None,
    seconds: tuple[int, int] | None = None,
    days: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """Latest version of every key, optionally a part of the table only.

    ``days`` are stretches of event days, ``seconds`` limits the event time (both ends included) and
    ``narrow`` is any row filter. All of them apply to the scans, where other days are not read. A row that
    passes is still dropped if its key has a newer version, whether or not that one passes: the
    keys of the rows that pass are looked up in the key index.
    """
    if seconds is not None:
        days = [(seconds[0] // DAY_SECONDS, seconds[1] // DAY_SECONDS)]

    def limited(rows: DataFrame) -> DataFrame:
        if seconds is not None:
            low, high = (F.timestamp_seconds(F.lit(s)) for s in (seconds[0], seconds[1] + 1))
            rows = rows.where((F.col("transaction_time") >= low) & (F.col("transaction_time") < high))
        return rows if narrow is None else narrow(rows)

    if not path_exists(spark, log_path(table)):
        return limited(spark.createDataFrame([], schema))
    manifest = snapshot_manifest(spark, table)
    log = _log(spark, table, schema)
    if manifest is not None:
        log = log.where(F.col(LOG_ID) > manifest.covered)
    if narrow is None and days is None:
        newer = latest_per_key(log.drop(DAY), KEY, LOG_ID).drop(LOG_ID).select(*schema.fieldNames())
        if manifest is None:
            return newer
        older = read_days(spark, snapshot_path(table), schema, manifest)
        return older.join(log.select(KEY), KEY, "left_anti").unionByName(newer)

    versions = limited((log if days is None else log.where(_on_days(days))).drop(DAY))
    if manifest is not None:
        older = limited(read_days(spark, snapshot_path(table), schema, manifest, days))
        versions = versions.unionByName(older.withColumn(LOG_ID, F.lit(manifest.covered).cast("bigint")))
    newest = _newest(spark, table, versions, None if manifest is None else manifest.covered)
    current = versions.join(newest, KEY, "left").where(F.col("_newest").isNull() | (F.col(LOG_ID) >= F.col("_newest")))
    return current.select(*_column_order(current.drop(LOG_ID, "_newest"), schema))


def _column_order(rows: DataFrame, schema: StructType) -> list[str]:
    """The table's columns first, then whatever ``narrow`` added."""
    named = schema.fieldNames()
    return named + [c for c in rows.columns if c not in named]


def mart_or_gold(spark: SparkSession, mart_table: str, gold: DataFrame, to_mart) -> DataFrame:
    """The feature mart if it is in the catalog, else the same features derived from Gold.

    Only a missing table leads to the second choice; any other error is an error.
    """
    if spark.catalog.tableExists(mart_table):
        return spark.table(mart_table)
    return to_mart(gold)
