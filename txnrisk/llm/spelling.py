"""Spelling variants grouped by a bit-sliced position index over the vocabulary.

The index has a bitset over its words for every (position, letter). A word is looked up by running
through its letters once, for all words of a block and all words of the index at the same time, 64 of
the latter per machine word: the set of words equal so far, and three sets of words with one error so
far, in which positions are shifted by 0 (a replaced letter), +1 (the other has a letter more) or
-1 (the other lacks one). Index words lie in order of their counts, so the first bit is the best one.

Words one error apart agree in the first half of the shorter one or in what follows it. So each word
visits the blocks of its first and of its second half, for pairs with its own length and the next.
A half that very many words share is cut into tiles of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import by_value, discard, join_facts, schema_of, stage

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of an index and words looked up in it, at most, where one half is common; else about half as many.
#: Of long words it is fewer, so that a tile's letters stay bounded.
TILE = 4096
TILE_LETTERS = 1 << 22
#: One in so many runs is misspelt by :func:`misspelt`.
MISSPELL = 199


def misspelt(docs: DataFrame, key: str = "doc_id", letters: str = LETTERS) -> DataFrame:
    """(word): all runs of letters of all texts, A-Z lower-cased, some with a letter less.

    Where 199 divides the crc32 of "id:run" the run loses the code point at that number modulo its length.
    Null texts have no runs; a null id counts as empty. An emptied run stays as the empty word.
    """
    run = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(letters), 0)).alias("run")
    each = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), run)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return each.select(F.when(h % MISSPELL == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = 6, least_n: int = 5) -> DataFrame:
    """(word, n): distinct words of that length and count; counted on the map side first."""
    long = words.filter(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_n)


def _routes(words: DataFrame, tile: int) -> DataFrame:
    """(block, short, first_half, word, n, indexed, asked): where each word is indexed and looked up.

    ``short`` is the length of the shorter word of the block's pairs; longer ones have one letter more.
    """
    length = F.length("word")
    room = F.least(F.lit(tile), F.greatest(F.lit(2), F.floor(F.lit(TILE_LETTERS) / F.col("short"))))
    shorts = F.filter(F.array(length - 1, length), lambda x: x >= 1)
    each = words.select("word", "n", F.explode(shorts).alias("short"))
    each = each.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("first_half"))
    half = F.floor(F.col("short") / 2).cast("int")
    own = F.when(F.col("first_half"), F.col("word").substr(F.lit(1), half)).otherwise(
        F.expr("right(word, short - cast(floor(short / 2) as int))")
    )
    group = F.concat_ws(":", F.col("short").cast("string"), F.col("first_half").cast("string"), own)
    each = each.withColumn("half", group)
    sizes = words.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n"))
    visits = sizes.select(F.explode(F.array(F.col("length") - 1, F.col("length"))).alias("short"), "n")
    blocks = visits.groupBy("short").agg(F.sum("n").alias("n"))
    blocks = blocks.filter("short >= 1").select("short", F.ceil(F.col("n") * 2 / room).cast("long").alias("blocks"))
    each = join_facts(each, stage(blocks, "spelling-lengths"), "short", F.col("word"))
    common = each.groupBy("half", "short").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > room)
    common = common.select("half", F.ceil(F.col("size") / room).cast("int").alias("tiles"))
    each = join_facts(each, stage(common, "spelling-halves"), "half", F.col("word"))
    usual = F.array(
        F.struct(
            F.concat_ws(":", F.col("short").cast("string"), F.col("first_half").cast("string"), F.pmod(F.xxhash64("half"), F.col("blocks")).cast("string")).alias("block"),
            F.lit(True).alias("indexed"),
            F.lit(True).alias("asked"),
        )
    )
    mine = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    every = F.sequence(F.lit(0), F.col("tiles") - 1)

    def tiled(row, column, indexed, asked):
        name = F.concat_ws("/", F.col("half"), row.cast("string"), column.cast("string"))
        return F.struct(name.alias("block"), indexed.alias("indexed"), asked.alias("asked"))

    # Index words of tile row r meet the words asked about in column c; on the diagonal a word is both.
    in_index = F.transform(every, lambda c: tiled(mine, c, F.lit(True), c == mine))
    as_asked = F.transform(F.filter(every, lambda r: r != mine), lambda r: tiled(r, mine, F.lit(False), F.lit(True)))
    places = F.when(F.col("tiles").isNull(), usual).otherwise(F.concat(in_index, as_asked))
    placed = each.select("short", "first_half", "word", "n", F.explode(places).alias("place"))
    return placed.select("place.block", "short", "first_half", "word", "n", "place.indexed", "place.asked")


class PositionIndex:
    """Bitsets over words by (position, letter), one position at a time; words best first."""

    def __init__(self, words: list[str], longest: int):
        self.words, self.longest = words, longest
        self.chars = letters_of(words, longest)
        self.alphabet = np.unique(self.chars)
        self.codes = np.searchsorted(self.alphabet, self.chars)
        self.cells = -(-max(len(words), 1) // 64)
        self.lengths = np.array([len(w) for w in words])
        self.none = np.zeros((len(self.alphabet) + 1, self.cells), np.uint64)

    def bits(self, mask: np.ndarray) -> np.ndarray:
        packed = np.zeros(self.cells * 8, np.uint8)
        packed[: -(-len(mask) // 8)] = np.packbits(mask, bitorder="little")
        return packed.view(np.uint64)

    def at(self, position: int) -> np.ndarray:
        """A bitset per letter of the alphabet, and an empty one for other letters."""
        if not 0 <= position < self.longest:
            return self.none
        out = np.zeros_like(self.none)
        column = self.codes[:, position]
        for code in np.unique(column).tolist():
            if self.alphabet[code]:
                out[code] = self.bits(column == code)
        return out

    def near(self, asked: list[str], short: int, length: int, first_half: bool) -> np.ndarray:
        """Per word asked about, all of ``length`` (``short`` or one more), the bitset of index words that
        are one error away and make a pair of the block; of two words with the longer length none is.
        """
        chars = letters_of(asked, length)
        code = np.searchsorted(self.alphabet, chars)
        known = self.alphabet[np.minimum(code, len(self.alphabet) - 1)] == chars
        code = np.where(known, code, len(self.alphabet))
        full = ~np.zeros((len(asked), self.cells), np.uint64)
        equal, replaced, more, less = full, full & np.uint64(0), full & np.uint64(0), full & np.uint64(0)
        same_half = full
        before, now, after = self.none, self.at(0), self.at(1)
        for i in range(length):
            if i == short // 2:
                same_half = equal
            letter = code[:, i]
            here = now[letter]
            if length == short:
                replaced = (replaced & here) | (equal & ~here)
                more = (more | equal) & after[letter]
            else:
                less = (less & before[letter]) | equal
            equal = equal & here
            before, now, after = now, after, self.at(i + 2)
        if length == short:
            out = (replaced & self.bits(self.lengths == short)) | ((more | equal) & self.bits(self.lengths == short + 1))
        else:
            out = less & self.bits(self.lengths == short)
        return out & (same_half if first_half else ~same_half)


def letters_of(words: list[str], longest: int) -> np.ndarray:
    """Code points, a row per word, 0 where a word has ended."""
    return np.array(words, dtype=f"<U{max(longest, 1)}").reshape(-1, 1).view(np.uint32).reshape(len(words), -1)


def best_of(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of bits per row, and the first one (0 if there is none)."""
    cell = (near != 0).argmax(axis=1)
    value = near[np.arange(len(near)), cell]
    lowest = value & (~value + np.uint64(1))
    return np.bitwise_count(near).sum(axis=1, dtype=np.int64), cell * 64 + np.bitwise_count(lowest - np.uint64(1)) * (value != 0)


def neighbours(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n, n_near, near, near_n) for a table of distinct words with counts.

    ``n_near`` counts the words one inserted, deleted or replaced code point away; ``near`` is that of the
    largest count, ties by code points, null if there is none.
    """
    schema = schema_of("word string, n long, n_near long, near string, near_n long")
    names = schema.fieldNames()

    def search(table: pa.Table) -> pa.Table:
        short, first_half = table.column("short")[0].as_py(), table.column("first_half")[0].as_py()
        rows = table.select(["word", "n", "indexed", "asked"]).to_pylist()
        held = sorted((r for r in rows if r["indexed"]), key=lambda r: (-r["n"], r["word"]))
        index = PositionIndex([r["word"] for r in held], short + 1) if held else None
        out: list[tuple] = []
        for length in (short, short + 1):
            asked = [r for r in rows if r["asked"] and len(r["word"]) == length]
            if not asked:
                continue
            if index is None:
                out += [(r["word"], r["n"], 0, None, None) for r in asked]
                continue
            counts, best = best_of(index.near([r["word"] for r in asked], short, length, first_half))
            for r, k, b in zip(asked, counts.tolist(), best.tolist()):
                found = held[b] if k else {"word": None, "n": None}
                out.append((r["word"], r["n"], k, found["word"], found["n"]))
        columns = zip(*out) if out else [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    found = _routes(words, tile).groupBy("block").applyInArrow(search, schema)
    pair = F.struct((-F.col("near_n")).alias("minus_n"), "near")
    best = F.min(F.when(F.col("near").isNotNull(), pair)).alias("best")
    each = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    return each.select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus_n")).alias("near_n"))


def variants(words: DataFrame, ratio: int = 5, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table of distinct words with counts.

    A word's form is its near word of the largest count, if that is ``ratio`` times its own or more, else
    null. The root is where the forms lead, the word itself without one. Counts grow along forms, so the
    chains end; they are followed by doubling steps. The driver holds no table of words: roots are as many as
    a good part of the words, though their files are small, so they are joined by a shuffle.
    """
    if ratio < 2:
        raise ValueError("counts must grow along forms")
    found = stage(neighbours(words, tile), "spelling-neighbours")
    has = F.col("near_n") >= ratio * F.col("n")
    formed = found.select("word", "n", "n_near", F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n"))
    leads = stage(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = leads.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        further = stage(join_facts(leads, onward, "root", F.col("word")), "spelling-roots")
        moved = further.filter(F.col("_further").isNotNull()).limit(1).count()
        discard(leads)
        leads = further.select("word", F.coalesce("_further", "root").alias("root"))
        if not moved:
            break
    roots = leads.withColumnRenamed("word", "_word")
    joined = formed.join(roots.hint("merge"), F.col("word") == F.col("_word"), "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


by_value(__name__)
