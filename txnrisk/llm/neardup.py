"""Near-duplicate documents: MinHash with banding, exact confirmation, connected components.

1. Each document's distinct word shingles, a 128-bit name of that set, and a signature of many
   universal hash minima. Documents of one name are copies; their smallest id stands for them.
2. Bands of the signatures of these representatives. Within a bucket every member is paired with
   the smallest one only. Pairs whose signatures agree enough are confirmed on the full sets.
3. Components of the confirmed links. Buckets that still hold several components are searched
   again, between members of different components only; confirmed links between them are added.
   So no link between different texts is lost, and a bucket of one component, the usual case for a
   large group of copies, costs one pair per member.
4. Components of all links, by large-star and small-star.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm import common
from txnrisk.llm.common import by_value, stage
from txnrisk.llm.components import components

#: 32 bands of 4 rows: a pair at 0.8 shares no band with probability (1 - 0.8^4)^32 = 5e-8.
BANDS, ROWS = 32, 4
#: Signatures agree enough from here below the threshold on: 6 standard errors at 0.8.
SLACK = 0.21
#: Members of a bucket that are compared at a time.
BLOCK = 512
#: Shingles that are hashed at a time.
CHUNK = 1 << 14
_RANDOM = np.random.default_rng(8192)
_A = _RANDOM.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, counts = common.word_hashes(texts)
    hashes, n = common.shingle_hashes(words, counts, size)
    return [np.unique(x) for x in np.split(hashes, np.cumsum(n)[:-1])] if len(texts) else []


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of universal (multiply and shift) hashes of a set that is not empty."""
    out = np.full(len(_A), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(shingles), CHUNK):
        part = shingles[at : at + CHUNK]
        for i in range(len(_A)):
            out[i] = min(out[i], ((part * _A[i] + _B[i]) >> np.uint64(32)).min())
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The same for many sets, none of them empty; small ones are hashed together."""
    out = np.empty((len(sets), len(_A)), dtype=np.uint32)
    at = 0
    while at < len(sets):
        end, held = at, 0
        while end < len(sets) and held + len(sets[end]) <= CHUNK:
            held += len(sets[end])
            end += 1
        if end == at:
            out[at] = signature(sets[at])
            at += 1
            continue
        together = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *map(len, sets[at:end])])[:-1]
        for i in range(len(_A)):
            out[at:end, i] = np.minimum.reduceat((together * _A[i] + _B[i]) >> np.uint64(32), starts)
        at = end
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, the band's number mixed in."""
    rows = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for j in range(ROWS):
        key = common.mix(key ^ rows[:, :, j])
    return key.view(np.int64)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketches(docs: DataFrame, size: int, key: str) -> DataFrame:
    """(key, n_shingles, a, b, sig): per row, the set's size, its 128-bit name and its signature.

    Rows without words have size 0 and null names and signatures.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_shingles", "a", "b", "sig"]

    def sketch(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = shingle_sets(common.texts_of(part.column(1)), size)
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = signatures([sets[i] for i in full])
                blobs: list = [None] * len(sets)
                a: list = [None] * len(sets)
                b: list = [None] * len(sets)
                for j, i in enumerate(full):
                    blobs[i] = sig[j].tobytes()
                    a[i] = int(common.mix(sets[i]).sum(dtype=np.uint64).view(np.int64))
                    b[i] = int(common.mix(sets[i] ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))
                arrays = [part.column(0), pa.array(list(map(len, sets)), pa.int64())]
                arrays += [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(key, "text").mapInArrow(sketch, f"{key} {kind}, n_shingles long, a long, b long, sig binary")


def bands(representatives: DataFrame) -> DataFrame:
    """(bucket, id): 32 rows per representative."""

    def spread(batches):
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, len(_A))
                keys = band_keys(sig)
                ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["bucket", "id"])

    return representatives.select("id", "sig").mapInArrow(spread, "bucket long, id long")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree enough and whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"), F.col("shingles").alias("set_b"))
    least = percent / 100 - SLACK

    def check(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            a, b = [], []
            for x, y, sig_x, sig_y, set_x, set_y in zip(*columns):
                agree = np.count_nonzero(np.frombuffer(sig_x, np.uint32) == np.frombuffer(sig_y, np.uint32))
                if agree >= least * len(_A) and linked(np.frombuffer(set_x, np.uint64), np.frombuffer(set_y, np.uint64), percent):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b", "set_a", "set_b")
    return both.mapInArrow(check, "a long, b long")


def link_block(ids: np.ndarray, component: np.ndarray, block: np.ndarray, sig: np.ndarray, sets: list, bucket_band: int, blocks, percent):
    """Confirmed links between different components of a bucket's one or two blocks.

    A pair is looked at in the first band that it shares only. Pairs that links found so far have
    joined already are passed over, so a few links per component come out.
    """
    parent = {int(c): int(c) for c in component}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    first, second = blocks
    rows, columns = np.flatnonzero(block == first), np.flatnonzero(block == second)
    out = []
    least = (percent / 100 - SLACK) * sig.shape[1]
    banded = sig.reshape(len(sig), BANDS, ROWS)
    for i in rows:
        other = columns[component[columns] != component[i]]
        if first == second:
            other = other[other > i]
        if not len(other):
            continue
        same = sig[other] == sig[i]
        other_band = (banded[other] == banded[i]).all(axis=2).argmax(axis=1)
        agree = same.sum(axis=1)
        near = np.flatnonzero((agree >= least) & (other_band == bucket_band))
        for j in near[np.argsort(-agree[near], kind="stable")]:
            x, y = root(int(component[i])), root(int(component[other[j]]))
            if x != y and linked(sets[i], sets[other[j]], percent):
                parent[max(x, y)] = min(x, y)
                out.append((int(ids[i]), int(ids[other[j]])))
    return out


def between_components(buckets: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of different components within a bucket.

    A bucket's members are dealt into blocks of about BLOCK, and each pair of blocks is a group of
    its own, so no group grows with the bucket.
    """
    named = buckets.join(found, buckets["id"] == found["node"], "left")
    named = named.select("bucket", "id", F.coalesce("component", "id").alias("component"))
    split = named.groupBy("bucket").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("n")
    )
    split = split.filter("least <> most").select(F.col("bucket").alias("_bucket"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    open_ = named.join(split, named["bucket"] == split["_bucket"]).drop("_bucket")
    open_ = open_.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    open_ = open_.select("bucket", "id", "component", "block", other)
    open_ = open_.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
    rows = stage(open_.select("bucket", "first", "second", "id", "component", "block"), "open-buckets")
    full = rows.join(sets, "id")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        sig = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint32).reshape(len(pdf), -1)
        sets_here = [np.frombuffer(x, dtype=np.uint64) for x in pdf["shingles"]]
        band = int(np.argwhere(band_keys(sig) == pdf["bucket"].iloc[0])[0][1])
        pair = (pdf["first"].iloc[0], pdf["second"].iloc[0])
        links = link_block(
            pdf["id"].to_numpy(), pdf["component"].to_numpy(), pdf["block"].to_numpy(), sig, sets_here, band, pair, percent
        )
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return full.groupBy("bucket", "first", "second").applyInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 4, threshold_percent: int = 80, key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, kept): one row per row of the documents.

    Words are runs of other than ASCII white space, ASCII letters lower-cased; fewer words than a shingle
    make one shingle. Documents with 100 * intersection >= threshold * union are linked. The component is
    the smallest id that can be reached; the row that has it is kept. Null, empty and blank texts are
    linked with nothing and stay. Rows that repeat an id are one document for the linking; rows
    with a null id are linked with nothing, their component is null, and they stay.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(key).cast("long").alias("id"), "text")
    rows = stage(sketches(base, size, "id"), "sketches")
    usable = rows.filter(F.col("id").isNotNull() & F.col("a").isNotNull())
    classes = usable.groupBy("a", "b", "n_shingles").agg(F.min("id").alias("class"))
    own = usable.select("id", "a", "b", "n_shingles").join(classes, ["a", "b", "n_shingles"])
    copies = stage(own.select("id", "class", "n_shingles"), "copies")
    heads = copies.filter("id = class").select(F.col("id").alias("_id"), F.col("n_shingles").alias("_n")).distinct()
    same = (usable["id"] == heads["_id"]) & (usable["n_shingles"] == heads["_n"])
    signed = usable.join(heads, same).dropDuplicates(["id", "a", "b"])
    banded = stage(bands(signed), "bands")

    hubs = banded.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("_most")).filter("hub <> _most")
    hubs = hubs.select(F.col("bucket").alias("_bucket"), "hub")
    buckets = stage(banded.join(hubs, banded["bucket"] == hubs["_bucket"]).drop("_bucket"), "buckets")
    pairs = stage(buckets.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "pairs")

    wanted = buckets.select(F.col("id").alias("_id")).distinct()

    def full_sets(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = shingle_sets(common.texts_of(part.column(1)), size)
                blobs = [s.tobytes() for s in sets]
                full = [s for s in sets if len(s)]
                found = iter(signatures(full))
                sig = [next(found).tobytes() if len(s) else None for s in sets]
                arrays = [part.column(0), pa.array(sig, pa.binary()), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "sig", "shingles"])

    texts = base.join(wanted, base["id"] == wanted["_id"], "left_semi")
    sets = stage(texts.mapInArrow(full_sets, "id long, sig binary, shingles binary").filter("sig is not null"), "sets")
    links = stage(confirm(pairs, sets, threshold_percent), "links")
    found = components(links, "a", "b")
    more = stage(between_components(buckets, found, sets, threshold_percent), "links")

    every = links.unionByName(more).unionByName(copies.filter("id <> class").select(F.col("class").alias("a"), F.col("id").alias("b")))
    final = components(every, "a", "b").withColumnRenamed("node", "_node")
    result = rows.select("id", "n_shingles").join(final, F.col("id") == F.col("_node"), "left")
    component = F.coalesce("component", "id")
    kept = F.col("id").isNull() | (component == F.col("id"))
    return result.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, threshold_percent: int = 80, key: str = "doc_id") -> DataFrame:
    """The documents without those whose id is not its group's smallest; all columns stay.

    Rows that share the smallest id are one document and all stay, also if they are equal in every column;
    so do rows without an id.
    """
    found = near_duplicates(docs, size, threshold_percent, key)
    gone = found.filter(~F.col("kept")).select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")


by_value(__name__)
