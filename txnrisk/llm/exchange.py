"""Documents in blocks that put questions to buckets and get their answers back.

A block is a bounded share of the documents, by hash. A step works on whole blocks and sends each
bucket one row of packed arrays; a bucket sees what all blocks sent it and sends each block one row
back, in the block's own order. Whatever a block sends is reduced to distinct items first, so a key that
is in every document is one item per block. Answers are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import by_value, partitions, stage

#: Bytes of text in a block.
BLOCK_BYTES = 16 << 20
COLUMNS = ["block", "kind", "bucket", "id", "x", "y", "z"]
SCHEMA = "block int, kind string, bucket int, id long, x binary, y binary, z binary"
#: Rows that are not for a block but about the whole: sums for the driver, one row per bucket.
NOBODY = -1
#: Null ids take part as the largest.
NO_ID = np.iinfo(np.int64).max


def block_count(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    return partitions(docs.sparkSession, text_bytes(docs), block_bytes)


def text_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)


def in_blocks(docs: DataFrame, key: str, n: int, mark: Column | None = None) -> DataFrame:
    """The documents as rows of kind "doc": id, the text as UTF-8 in x, and 1 in y if marked.

    A null text is empty. Rows are dealt by id and text, so an id with many rows is spread.
    """
    block = F.pmod(F.xxhash64(F.lit(7), key, "text"), F.lit(n)).cast("int")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    nothing = F.lit(None).cast("binary")
    marked = nothing if mark is None else F.when(mark, F.lit("1").cast("binary"))
    return docs.select(
        block.alias("block"), F.lit("doc").alias("kind"), F.lit(0).alias("bucket"), F.col(key).cast("long").alias("id"),
        text.alias("x"), marked.alias("y"), nothing.alias("z"),
    )


def bucket_of(key: np.ndarray, n: int) -> np.ndarray:
    """The bucket of evenly spread 64-bit keys; sorted keys are in order of their buckets."""
    return (((key >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int32)


def plain(numbers: np.ndarray) -> bytes:
    return np.ascontiguousarray(numbers).tobytes()


def planes(numbers: np.ndarray) -> bytes:
    """Whole numbers as the lowest bytes of all, then the next, as far as any is not 0; their number per item comes first.

    Of sorted or small numbers, little is left once compressed.
    """
    numbers = np.ascontiguousarray(numbers).ravel()
    numbers = numbers.view(f"u{numbers.itemsize}")
    used = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    by_place = np.empty((used, len(numbers)), dtype=np.uint8)
    for place in range(used):
        by_place[place] = numbers >> numbers.dtype.type(8 * place)
    return bytes([used]) + by_place.tobytes()


def unplanes(packed: bytes, dtype: type) -> np.ndarray:
    by_place = np.frombuffer(packed, dtype=np.uint8)[1:].reshape(packed[0], -1)
    unsigned = np.dtype(f"u{np.dtype(dtype).itemsize}")
    out = by_place[0].astype(unsigned)
    for place in range(1, packed[0]):
        out |= by_place[place].astype(unsigned) << unsigned.type(8 * place)
    return out.view(dtype)


def send(block: int, kind: str, bucket: np.ndarray, *arrays: np.ndarray, pack: Callable[[np.ndarray], bytes] = plain) -> list[tuple]:
    """One row per bucket; the items are in order of their buckets."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1 if len(bucket) else []
    out = []
    for at in np.split(np.arange(len(bucket)), cuts) if len(bucket) else []:
        blobs = [pack(a[at[0] : at[-1] + 1]) for a in arrays]
        out.append((block, kind, int(bucket[at[0]]), None, *blobs, *[None] * (3 - len(blobs))))
    return out


def received(pdf: pd.DataFrame, kind: str, dtypes: tuple, column: str = "bucket") -> list[np.ndarray]:
    """What came back, joined in order of the buckets."""
    mine = pdf[pdf["kind"] == kind].sort_values(column)
    return [
        np.frombuffer(b"".join(x or b"" for x in mine[c]), dtype=t) if len(mine) else np.empty(0, t)
        for c, t in zip(("x", "y", "z"), dtypes)
    ]


def documents(pdf: pd.DataFrame) -> tuple[np.ndarray, list[bytes], list]:
    """Ids for comparing, texts, and ids as given."""
    docs = pdf[pdf["kind"] == "doc"]
    given = [None if pd.isna(i) else int(i) for i in docs["id"]]
    return np.array([NO_ID if i is None else i for i in given], dtype=np.int64), list(docs["x"]), given


def sums(answers: DataFrame) -> dict[str, int]:
    """Totals by kind of the whole numbers that buckets have put in ``id`` for nobody in particular."""
    told = answers.filter(F.col("block") == NOBODY).groupBy("kind").agg(F.sum("id").alias("n"))
    return {r["kind"]: int(r["n"] or 0) for r in told.collect()}


def for_blocks(answers: DataFrame) -> DataFrame:
    return answers.filter(F.col("block") != NOBODY)


def frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=COLUMNS)
    out["id"] = out["id"].astype("Int64")
    return out


def per_block(rows: DataFrame, work: Callable[[int, pd.DataFrame], list[tuple]]) -> DataFrame:
    """Apply work(block, its rows) to each block."""

    def apply(pdf: pd.DataFrame) -> pd.DataFrame:
        return frame(work(int(pdf["block"].iloc[0]), pdf))

    return rows.groupBy("block").applyInPandas(apply, SCHEMA)


def per_bucket(rows: DataFrame, work: Callable[[str, pd.DataFrame], list[tuple]], label: str) -> DataFrame:
    """Apply work(kind, rows of a kind and bucket, in order of the blocks); the answers are written."""

    def apply(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block", ignore_index=True)
        return frame(work(pdf["kind"].iloc[0], pdf))

    return stage(rows.groupBy("kind", "bucket").applyInPandas(apply, SCHEMA), label)


by_value(__name__)
