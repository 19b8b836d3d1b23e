"""Benchmark decontamination: short test items found inside documents of any length.

Items are split by size (powers of two of their shingle count). Each size class has its own number
of minima: with n the class's largest size and c the asked containment, an item's signature is its
floor((1 - c) * n) + 1 smallest shingle hashes. An item of which a document holds the share c
misses fewer shingles than that, so at least one of the minima is among the document's shingles:
the search loses nothing, however long the document. Whatever is found is verified by the exact
share of the item's shingles, compared as words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txnrisk.llm import common
from txnrisk.llm.common import by_value, discard, stage

#: Items, and bytes of their text, that are held against the documents in one pass.
BLOCK_ITEMS = 20_000
#: Documents whose words are hashed and looked up in one numpy step.
STEP_ROWS = 256
BLOCK_BYTES = 16 << 20


def shingles(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    """All runs of ``size`` words; fewer words, but at least one, make one shingle of themselves."""
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def least_minima(n: int, containment: float) -> int:
    """Minima that an item of n shingles needs so that none is missed."""
    largest = 1 << max(n - 1, 0).bit_length()  # of its size class
    return min(n, math.floor((1 - containment) * largest + 1e-9) + 1)


class ItemIndex:
    """The minima of a block of items, and their shingles for the exact check."""

    def __init__(self, items: list[tuple[int, bytes]], size: int, containment: float):
        self.size, self.containment = size, containment
        self.ids, self.shingles, minima, owner = [], [], [], []
        for item, text in items:
            words = text.lower().split()
            own = shingles(words, size)
            if not own:
                continue
            hashes, counts = common.word_hashes([text])
            h = np.unique(common.shingle_hashes(hashes, counts, len(next(iter(own))))[0])
            k = least_minima(len(own), containment)
            minima.append(h[:k])
            owner.append(np.full(min(k, len(h)), len(self.ids)))
            self.ids.append(item)
            self.shingles.append(own)
        at = np.concatenate(minima) if minima else np.empty(0, np.uint64)
        order = np.argsort(at, kind="stable")
        self.minima, self.owner = at[order], (np.concatenate(owner) if owner else np.empty(0, int))[order]
        self.short = {len(next(iter(s))) for s in self.shingles} - {size}

    def search(self, texts: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(text number, item, shared shingles, item's shingles) at or above the containment."""
        found: set[tuple[int, int]] = set()
        words, counts = common.word_hashes(texts)
        for size in sorted({self.size, *self.short}):
            # Items shorter than a shingle are looked for as a whole, at their own length.
            h, n = common.shingle_hashes(words, counts, size)
            at = np.searchsorted(self.minima, h)
            hit = at < len(self.minima)
            hit[hit] = self.minima[at[hit]] == h[hit]
            place = np.flatnonzero(hit)
            text = np.searchsorted(np.cumsum(n), place, side="right")
            for t, p in zip(text.tolist(), place.tolist()):
                i = int(at[p])
                while i < len(self.minima) and self.minima[i] == h[p]:
                    found.add((t, int(self.owner[i])))
                    i += 1
        out = []
        split: dict[int, list[bytes]] = {}
        for t, i in sorted(found):
            if t not in split:
                split = {t: texts[t].lower().split()}
            own = self.shingles[i]
            size = len(next(iter(own)))
            shared = len(own & shingles(split[t], size)) if len(split[t]) >= size else 0
            if shared >= self.containment * len(own) - 1e-9:
                out.append((t, self.ids[i], shared, len(own)))
        return out


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[int, bytes]]]:
    """The items, in blocks of bounded number and size; only one block is on the driver at a time."""
    block: list[tuple[int, bytes]] = []
    held = 0
    for row in items.select(key, text).toLocalIterator():
        content = (row[1] or "").encode("utf-8")
        if block and (len(block) >= BLOCK_ITEMS or held + len(content) > BLOCK_BYTES):
            yield block
            block, held = [], 0
        block.append((row[0], content))
        held += len(content)
    yield block


def find_items(
    docs: DataFrame, items: DataFrame, size: int = 5, containment: float = 0.8, key: str = "doc_id", item: str = "item_id"
) -> DataFrame:
    """(key, item, n_shared, n_item, containment): documents that hold an item, one row per pair.

    Words are runs of other than ASCII white space, ASCII letters lower-cased. Null, empty and
    blank texts hold nothing and are held by nothing. An item with fewer words than a shingle must
    occur as a whole. Rows that repeat an id are searched each. The documents are read once per
    block of items; nothing is shuffled.
    """
    spark = docs.sparkSession
    schema = common.schema_of(
        f"{key} {docs.schema[key].dataType.simpleString()}, {item} {items.schema[item].dataType.simpleString()}, "
        "n_shared long, n_item long, containment double"
    )
    names = [f.name for f in schema]
    out = None
    for block in item_blocks(items, item, "text"):
        opened = common.shipped(spark, ItemIndex(block, size, containment))

        def search(batches, opened=opened, names=names):
            index = opened()
            for batch in (whole.slice(at, STEP_ROWS) for whole in batches for at in range(0, whole.num_rows, STEP_ROWS)):
                ids = batch.column(0).to_pylist()
                hits = index.search(common.texts_of(batch.column(1)))
                columns = [
                    [ids[t] for t, *_ in hits],
                    [i for _, i, *_ in hits],
                    [k for *_, k, _ in hits],
                    [n for *_, n in hits],
                    [k / n for *_, k, n in hits],
                ]
                kinds = [batch.column(0).type, None, pa.int64(), pa.int64(), pa.float64()]
                arrays = [pa.array(c, k) if k is not None else pa.array(c) for c, k in zip(columns, kinds)]
                if hits:
                    yield pa.RecordBatch.from_arrays(arrays, names)

        part = docs.select(key, "text").mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 5, containment: float = 0.8) -> DataFrame:
    """The documents that hold no item, with all their columns; every row is judged by its own text.

    Ids play no part, so rows without one, or with that of a contaminated row, stay if they are
    clean. Nothing is shuffled. Each block of items takes its rows out of what the blocks before
    have left, which is written in between, so that a task holds a single block's index.
    """
    written = None
    for n, block in enumerate(item_blocks(items, "item_id", "text")):
        if n:
            before, written = written, stage(docs, "decontaminated")
            docs = written
            opened.sent.unpersist()
            if before is not None:
                discard(before)
        opened = common.shipped(docs.sparkSession, ItemIndex(block, size, containment))

        def clean(batches, opened=opened):
            index = opened()
            for batch in (whole.slice(at, STEP_ROWS) for whole in batches for at in range(0, whole.num_rows, STEP_ROWS)):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[t for t, *_ in index.search(common.texts_of(batch.column("text")))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


by_value(__name__)
