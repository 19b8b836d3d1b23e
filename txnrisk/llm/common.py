"""Shared pieces: folds, words and hashes as numpy arrays, ranks, checked joins."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk import session

SPACES = b"\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
#: Most rows and bytes of a table that is broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 8 << 20
#: Bytes of text that one numpy step handles at a time.
CHUNK_BYTES = 2 << 20
#: Bytes of text whose words are hashed in one numpy step.
SEGMENT_BYTES = 1 << 19
#: Numbers that one numpy step mixes, so that they stay in a core's cache.
STEP = 1 << 14
#: Words are hashed by their first letters, their second letters and so on, up to this length; what is longer, by word.
SHORT = 32

_LOWER = bytes(range(256)).lower()
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C17  # 3 modulo 4, so that differences of powers are divisible by 2 only once or so


def by_value(module: str) -> None:
    """Send a module's functions and classes to the executors by value: they need numpy, not this package.

    That holds for what functions refer to; a model that is broadcast goes through :func:`shipped`.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shipped(spark: SparkSession, model):
    """What gives tasks a broadcast model: call it there once.

    A broadcast names classes by module, which executors need not have. So the model is sent as bytes that
    hold its class by value, if the class's module asks for that (:func:`by_value`). ``sent`` is the broadcast.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(model))

    def opened():
        import pickle

        return pickle.loads(sent.value)

    opened.sent = sent
    return opened


def crc_fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as the empty text."""
    column = F.col(key) if isinstance(key, str) else key
    text = F.coalesce(column.cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % F.lit(folds)).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession, n_bytes: int = 0, target: int = 32 << 20) -> int:
    """Shuffle partitions: the session's number, or more where that would exceed the target size."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(n_bytes) // target))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back; the shuffle files of the query go at its end.

    Without that they would stay until the driver happens to collect its garbage. A write is not read
    again from its shuffles, so nothing is lost; executors lost during the query are made up for as ever.
    """
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        return session.stage(df, label)
    finally:
        spark.conf.set(setting, before)


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a staged table may be broadcast: counts its rows and the bytes of its text form."""
    size = F.sum(F.length(F.to_json(F.struct(*df.columns))).cast("long"))
    rows, n_bytes = df.select(F.count(F.lit(1)), size).first()
    return rows <= max_rows and (n_bytes or 0) <= max_bytes


def join_facts(rows: DataFrame, facts: DataFrame, key: str, spread_by: Column, salts: int = 32) -> DataFrame:
    """Left join with facts that are unique per key, for keys that may hold a third of the rows.

    Null keys match each other. Few facts are broadcast after counting them; beyond that the facts
    are copied once per salt and the rows of one key are spread over the salts. Both sides are shuffled
    then, whatever sizes the planner guesses: it goes by the size of files and does not see the copies.
    """
    facts = facts.withColumnRenamed(key, "_fact_key")
    same = rows[key].eqNullSafe(F.col("_fact_key"))
    if small(facts):
        return rows.join(F.broadcast(facts), same, "left").drop("_fact_key")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = facts.withColumn("_fact_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    both = salted[key].eqNullSafe(F.col("_fact_key")) & (F.col("_salt") == F.col("_fact_salt"))
    return salted.join(copies, both, "left").drop("_fact_key", "_salt", "_fact_salt")


def ranked(df: DataFrame, order: Column, name: str) -> DataFrame:
    """Number rows from 0 in a global order without gathering them in one task.

    Rows are dealt by range; each partition is numbered by itself and shifted by the sizes of the
    partitions before it, of which there are as many as shuffle partitions.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    dealt = df.repartitionByRange(partitions(spark), order).withColumn("_part", F.spark_partition_id())
    dealt = stage(dealt, "ranked")
    sizes = {r["_part"]: r["count"] for r in dealt.groupBy("_part").count().collect()}
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]
    shift = F.lit(0).cast("long")
    if before:
        pairs = [F.lit(x) for part, at in before.items() for x in (part, at)]
        shift = F.element_at(F.create_map(*pairs), F.col("_part")).cast("long")
    local = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return dealt.withColumn(name, local + shift).drop("_part")


# --- numpy helpers; they run inside tasks -----------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits (the finalizer of splitmix64)."""
    return mix_in_place(np.array(x, dtype=np.uint64, order="C"))


def mix_in_place(x: np.ndarray) -> np.ndarray:
    flat = x.reshape(-1)
    spare = np.empty(min(len(flat), STEP), dtype=np.uint64)
    for at in range(0, len(flat), STEP):
        part = flat[at : at + STEP]
        shifted = spare[: len(part)]
        part ^= np.right_shift(part, np.uint64(30), out=shifted)
        part *= np.uint64(0xBF58476D1CE4E5B9)
        part ^= np.right_shift(part, np.uint64(27), out=shifted)
        part *= np.uint64(0x94D049BB133111EB)
        part ^= np.right_shift(part, np.uint64(31), out=shifted)
    return x


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, the place of one occurrence of each, and every item's distinct key.

    Keys are unsigned 64-bit numbers. Like numpy's unique, in about half its memory: places and numbers are
    32-bit, and copies go as soon as they are used.
    """
    # Sorted as numbers, the key's last bits replaced by its place: quicker than an argsort, and few keys differ in those bits alone.
    low = np.uint64((1 << max(len(keys) - 1, 0).bit_length()) - 1)
    packed = keys & ~low
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= low
    order, ordered = packed.astype(np.int32), keys.take(packed.view(np.int64))
    del packed
    if (ordered[1:] < ordered[:-1]).any():
        order = order[np.argsort(ordered, kind="stable")]
        ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    values, some = ordered[new], order[new]
    del ordered
    number = np.empty(len(keys), dtype=np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return values, some, number


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_TERMS = _BYTE * powers(SHORT)[:, None]


def _hash_segment(a: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lower-cased bytes, and where each word begins.

    A word's hash is mixed from the sum of its letters' numbers times the powers of their places.
    """
    space = (a - np.uint8(9) < 5) | (a == 32)
    begins = ~space
    begins[1:] &= space[:-1]
    cut = starts[(starts > 0) & (starts < len(a))]
    begins[cut] |= ~space[cut]
    first = np.flatnonzero(begins)
    if not len(first):
        return np.empty(0, np.uint64), first
    ends = ~space
    ends[:-1] &= space[1:] | begins[1:]
    lengths = np.flatnonzero(ends) - first + 1
    # Long words first, so that those that have a letter at a place are always the first ones.
    order = np.argsort(SHORT + 1 - np.minimum(lengths, SHORT + 1).astype(np.uint8), kind="stable")
    longest_first, at = lengths[order], first[order]
    longer = len(at) - np.cumsum(np.bincount(np.minimum(lengths, SHORT + 1), minlength=SHORT + 2))
    sums = np.zeros(len(at), dtype=np.uint64)
    for place in range(SHORT):
        n = longer[place]
        if not n:
            break
        sums[:n] += _TERMS[place].take(a.take(at[:n] + place))
    if longer[SHORT]:
        n = longer[SHORT]
        rest = longest_first[:n] - SHORT
        begin = np.cumsum(rest) - rest
        place = np.arange(int(rest.sum())) - np.repeat(begin, rest) + SHORT
        letters = a[np.repeat(at[:n], rest) + place]
        sums[:n] += np.add.reduceat(_BYTE[letters] * powers(int(longest_first[:n].max()))[place], begin)
    hashes = np.empty(len(at), dtype=np.uint64)
    hashes[order] = sums
    return mix_in_place(hashes), first


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (ASCII letters lower-cased) and the number of words per text.

    Works through segments of bounded size; a longer text is cut at white space.
    """
    hashes, counts = [], np.zeros(len(texts), dtype=np.int64)
    most = min(SEGMENT_BYTES, CHUNK_BYTES)
    group: list[bytes] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if not group:
            return
        a = np.frombuffer(b"".join(group).translate(_LOWER), dtype=np.uint8)
        starts = np.cumsum([0, *map(len, group)])
        h, first = _hash_segment(a, starts[:-1])
        hashes.append(h)
        np.add.at(counts, owner, np.diff(np.searchsorted(first, starts)))
        group.clear()
        owner.clear()
        held = 0

    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > most:
                end = next((j + 1 for j in range(at + most, len(text)) if text[j] in SPACES), len(text))
            if held + end - at > most:
                flush()
            group.append(text[at:end])
            owner.append(i)
            held += end - at
            at = end
    flush()
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within each text, repeats kept, and their number per text.

    A text with fewer words, but at least one, has its whole sequence as its only shingle.
    """
    multiplier = powers(size + 1)[1:]
    n = len(words)
    full = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    for j in range(size):
        full += words[j : j + len(full)] * multiplier[j]
    ends = np.cumsum(counts)
    begin = ends - counts
    keep = np.maximum(counts - size + 1, 0)
    out_counts = np.where(counts > 0, np.maximum(keep, 1), 0)
    out = np.empty(int(out_counts.sum()), dtype=np.uint64)
    place = np.cumsum(out_counts) - out_counts
    usual = keep > 0
    source = np.repeat(begin[usual] - (np.cumsum(keep[usual]) - keep[usual]), keep[usual])
    source = source + np.arange(len(source))
    target = np.repeat(place[usual] - (np.cumsum(keep[usual]) - keep[usual]), keep[usual])
    target = target + np.arange(len(target))
    out[target] = full[source]
    for i in np.flatnonzero((counts > 0) & (keep == 0)):
        k = int(counts[i])
        part = words[begin[i] : ends[i]] * multiplier[:k]
        out[place[i]] = part.sum(dtype=np.uint64) + np.uint64(k)
    return mix(out), out_counts


def texts_of(column) -> list[bytes]:
    """An Arrow text column as UTF-8 bytes, null as empty."""
    return [(x or "").encode("utf-8") for x in column.to_pylist()]


def schema_of(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


by_value("txnrisk.session")
by_value(__name__)
