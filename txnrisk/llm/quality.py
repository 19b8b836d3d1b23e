"""Quality by votes of the nearest labelled documents in a latent-semantic space.

Documents are term vectors (log counts of byte trigrams, hashed to a fixed width, and of words that
repeat the word before them, times inverse document frequency); the leading singular vectors of a sample of labelled documents span the
latent space. The sample's vectors are broadcast, every document's cosine with all of them is
computed exactly, block by block, and the nearest vote with their similarity.
"""

from __future__ import annotations

import operator
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm import common
from txnrisk.llm.common import by_value

#: Most labelled documents that vote; above that, those of the smallest hashes of their ids.
MOST_LABELLED = 8192
WIDTH = 4096
DIMENSIONS = 64
NEIGHBOURS = 25
REPEATS = 64
#: Documents per product of matrices.
BLOCK = 256


def terms(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Counts of byte trigrams by hash, line starts included; then of repeated and of all words.

    The last REPEATS terms all count the words that equal the one before: a single term among
    thousands would weigh too little for the latent space to show it.
    """
    total = np.zeros(width, dtype=np.int64)
    letters = width - REPEATS
    padded = b"\n" + text + b"\n"
    for at in range(0, len(text), common.CHUNK_BYTES):  # neighbours overlap by the two bytes of a trigram
        a = np.frombuffer(padded[at : at + common.CHUNK_BYTES + 2], dtype=np.uint8).astype(np.uint32)
        key = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
        key = (key * np.uint32(2654435761)) % np.uint32(letters)
        total[:letters] += np.bincount(key, minlength=letters)
    words = text.lower().split()
    total[letters:] = sum(map(operator.eq, words, words[1:]))
    return total


def counts_of(texts: list[bytes], width: int = WIDTH) -> np.ndarray:
    out = np.empty((len(texts), width), dtype=np.float32)
    for i, text in enumerate(texts):
        out[i] = terms(text, width)
    return out


class Space:
    """The latent space, the labelled vectors in it and their votes."""

    def __init__(self, idf: np.ndarray, counts: np.ndarray, labels: list[int], dimensions: int, neighbours: int):
        self.idf, self.neighbours = idf.astype(np.float32), neighbours
        self.labels = np.array(labels, dtype=np.float32)
        self.prior = float(self.labels.mean()) if len(labels) else 0.5
        x = self.weigh_counts(counts)
        k = min(dimensions, *x.shape)
        # Randomized range finder with power iterations (Halko, Martinsson and Tropp 2011).
        basis = x @ np.random.default_rng(5).standard_normal((x.shape[1], k + 16), dtype=np.float32)
        for _ in range(4):
            basis = np.linalg.qr(x @ (x.T @ np.linalg.qr(basis)[0]))[0]
        _, _, right = np.linalg.svd(basis.T @ x, full_matrices=False)
        self.axes = np.ascontiguousarray(right[:k].T)
        self.labelled = self.unit(x @ self.axes)

    def weigh(self, texts: list[bytes]) -> np.ndarray:
        return self.weigh_counts(counts_of(texts, len(self.idf)))

    def weigh_counts(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors of counts of terms; the array is written over."""
        np.log1p(x, out=x)
        x *= self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        return x

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by similarity; the labels' mean if nothing is near."""
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        for at in range(0, len(texts), BLOCK):
            part = self.unit(self.weigh(texts[at : at + BLOCK]) @ self.axes)
            cosine = part @ self.labelled.T
            k = min(self.neighbours, cosine.shape[1])
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0)
            total = weight.sum(axis=1)
            votes = (weight * self.labels[near]).sum(axis=1)
            out[at : at + BLOCK] = np.where(total > 0, votes / np.maximum(total, 1e-12), self.prior)
        return np.clip(out, 0.0, 1.0)


def document_frequency(docs: DataFrame, width: int = WIDTH) -> tuple[int, np.ndarray]:
    """Documents with text, and how many of them hold each hashed term; summed over all documents."""

    def count(batches):
        n, held = 0, np.zeros(width, dtype=np.int64)
        for batch in batches:
            for text in common.texts_of(batch.column(0)):
                n += bool(text)
                held += terms(text, width) > 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width)), pa.array(np.append([n], held))], ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    out = np.zeros(width + 1, dtype=np.int64)
    for term, n in rows:
        out[term + 1] = n or 0
    return int(out[0]), out[1:]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    label: str = "quality",
    most_labelled: int = MOST_LABELLED,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
) -> Space:
    """Fit the space. ``labels`` has (key, label), label 0 or 1; null keys and labels are left out.

    Repeated labels of a key count each. At most ``most_labelled`` labelled rows are used, those of the
    smallest hashes; document frequencies are of all documents. Of the rows used only the packed counts
    of their terms come to the driver, however long the texts.
    """
    from pyspark.sql import types as T

    n, held = document_frequency(docs)
    idf = np.log((1 + n) / (1 + held)) + 1
    usable = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).dropna()
    chosen = usable.orderBy(F.xxhash64("_key"), "_key", "_label").limit(most_labelled)
    texts = docs.select(F.col(key).alias("_key"), "text").filter(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(chosen), "_key")  # at most most_labelled rows
    rows = rows.select("_key", "_label", F.xxhash64("text").alias("_hash"), "text")

    def pack(batches):
        for batch in batches:
            packed = [zlib.compress(terms(x).astype(np.float32).tobytes(), 1) for x in common.texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], [*batch.schema.names[:-1], "_terms"])

    rows = rows.mapInArrow(pack, T.StructType([*rows.drop("text").schema.fields, T.StructField("_terms", T.BinaryType())]))
    # Repeated ids could bring more documents than labels: they are held to the same bound.
    rows = rows.orderBy(F.xxhash64("_key"), "_key", "_hash", "_label").limit(most_labelled).select("_terms", "_label").collect()
    counts = np.empty((len(rows), WIDTH), dtype=np.float32)
    for i, row in enumerate(rows):
        counts[i] = np.frombuffer(zlib.decompress(row[0]), dtype=np.float32)
    return Space(idf, counts, [r[1] for r in rows], dimensions, neighbours)


def score(docs: DataFrame, space: Space, added: str = "score") -> DataFrame:
    """The documents with a score from 0 to 1, higher where label 1 is likelier.

    Null and empty texts, and all texts if nothing was learned, get the mean label (0.5 without
    labels). All rows stay; an existing column of the added name is replaced. One pass without a shuffle.
    """
    from pyspark.sql import types as T

    opened = common.shipped(docs.sparkSession, space)
    rest = docs.drop(added)
    schema = T.StructType([*rest.schema.fields, T.StructField(added, T.DoubleType())])

    def vote(batches):
        model = opened()
        for batch in batches:
            scores = model.score(common.texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores.astype(float))], [*batch.schema.names, added])

    return rest.mapInArrow(vote, schema)


by_value(__name__)
