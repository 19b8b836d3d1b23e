"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams. A text's own list is compared with
each profile by the out-of-place distance: the sum of the differences of ranks, an n-gram that the
profile lacks counting as the full length of a profile.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm import common
from txnrisk.llm.common import by_value

#: Languages that may be learned; a label column with more values is an error, not a language column.
MOST_LANGUAGES = 10_000
UNKNOWN = "und"
#: Stands for what is between words; no letter, and not 0, so that n-grams of all lengths differ.
GAP = 1
#: Characters of text that one numpy step of learning handles at a time.
CHUNK_CHARS = 1 << 20
_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """By code point, made once per worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def characters(text: str) -> np.ndarray:
    """Code points of the lower-cased text with every run of other than letters as a single GAP.

    There is a GAP at either end. Empty if there is no letter.
    """
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = is_letter()[code]
    if not letter.any():
        return np.empty(0, dtype=np.uint64)
    padded = np.concatenate([[GAP], np.where(letter, code, GAP), [GAP]]).astype(np.uint64)
    keep = np.ones(len(padded), dtype=bool)
    keep[1:] = (padded[1:] != GAP) | (padded[:-1] != GAP)
    return padded[keep]


def ngrams(chars: np.ndarray, n_max: int) -> np.ndarray:
    """All n-grams of 1 to ``n_max`` (at most 3) characters, packed in 21 bits each.

    A GAP may only be the first or the last character, so that n-grams stay within a word.
    """
    parts = [chars[chars != GAP]]
    key = chars
    for n in range(2, n_max + 1):
        key = (key[:-1] << np.uint64(21)) | chars[n - 1 :]
        inner = np.ones(len(key), dtype=bool)
        for j in range(1, n - 1):
            inner &= chars[j : len(chars) - n + 1 + j] != GAP
        parts.append(key[inner])
    return np.concatenate(parts)


def top(keys: np.ndarray, length: int) -> np.ndarray:
    """The most frequent keys, most frequent first, ties by smaller key."""
    values, counts = np.unique(keys, return_counts=True)
    if len(values) > length:
        least = np.partition(counts, -length)[-length]
        keep = counts >= least
        values, counts = values[keep], counts[keep]
    return values[np.argsort(-counts, kind="stable")][:length]


class Profiles:
    """Ranks of the n-grams of all profiles, as one matrix of n-grams by languages."""

    def __init__(self, rows: list[tuple[str, int, int]], length: int, n_max: int):
        self.length, self.n_max = length, n_max
        self.languages = sorted({r[0] for r in rows})
        self.keys = np.unique(np.array([r[1] for r in rows], dtype=np.uint64))
        self.ranks = np.full((len(self.keys), len(self.languages)), -1, dtype=np.int32)
        of = {x: i for i, x in enumerate(self.languages)}
        for lang, key, rank in rows:
            self.ranks[np.searchsorted(self.keys, np.uint64(key)), of[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language, ties by smaller name, and 1 - its distance / the largest possible."""
        chars = characters(text) if text else np.empty(0, np.uint64)
        if not len(chars) or not self.languages:
            return UNKNOWN, 0.0
        own = top(ngrams(chars, self.n_max), self.length)
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        known = self.keys[at] == own
        ranks = self.ranks[at[known]]
        off = np.abs(ranks - np.flatnonzero(known)[:, None])
        off = np.where(ranks < 0, self.length, off).sum(axis=0) + self.length * int((~known).sum())
        best = int(np.argmin(off))
        return self.languages[best], float(1.0 - off[best] / (self.length * len(own)))


def learn(docs: DataFrame, n_max: int = 3, length: int = 300) -> DataFrame:
    """(lang, ngram, rank): the profiles, counted over the whole texts of all rows with a language.

    Null texts and texts without a letter add nothing; repeated rows count each. Counts are summed
    per batch, then per task, then over the shuffle; a language with most of the rows therefore
    adds no more shuffle rows than it has n-grams. Ties go to the smaller n-gram.
    """

    def count(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by: dict[str, list[np.ndarray]] = {}
            held: dict[str, int] = {}

            def emit(lang):
                values, counts = np.unique(np.concatenate(by.pop(lang)), return_counts=True)
                held.pop(lang)
                columns = [pa.array([lang] * len(values)), pa.array(values.astype(np.int64)), pa.array(counts)]
                return pa.RecordBatch.from_arrays(columns, ["lang", "ngram", "n"])

            for lang, text in zip(langs, texts):
                chars = characters(text) if text else ()
                if len(chars):
                    by.setdefault(lang, []).append(ngrams(chars, n_max))
                    held[lang] = held.get(lang, 0) + len(chars)
                    if held[lang] > CHUNK_CHARS:
                        yield emit(lang)
            for lang in list(by):
                yield emit(lang)

    counted = docs.filter(F.col("lang").isNotNull()).select("lang", "text")
    counted = counted.mapInArrow(count, "lang string, ngram long, n long")
    total = counted.groupBy("lang", "ngram").agg(F.sum("n").alias("n"))
    # The limit on the number itself lets Spark keep each task's first ones before the shuffle.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "ngram"))
    first = total.withColumn("_place", rank).filter(F.col("_place") <= length)
    return first.select("lang", "ngram", (F.col("_place") - 1).alias("rank"))


def load(profiles: DataFrame, n_max: int = 3, length: int = 300) -> Profiles:
    """Bring the profiles to the driver: ``length`` rows per language, of a checked number."""
    most = MOST_LANGUAGES * length
    rows = [tuple(r) for r in profiles.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return Profiles(rows, length, n_max)


def identify(docs: DataFrame, profiles: Profiles, added: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The documents with the predicted language and a score from 0 to 1.

    Null texts, texts without a letter, and all texts if nothing was learned, are ``und``, score 0.
    All rows stay, repeated ones too; existing columns of the added names are replaced. One pass,
    nothing is shuffled.
    """
    from pyspark.sql import types as T

    opened = common.shipped(docs.sparkSession, profiles)
    rest = docs.drop(*added)
    schema = T.StructType([*rest.schema.fields, *common.schema_of(f"{added[0]} string, {added[1]} double").fields])

    def predict(batches):
        model = opened()
        for batch in batches:
            found = [model.predict(x) for x in batch.column("text").to_pylist()]
            columns = [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *added])

    return rest.mapInArrow(predict, schema)


by_value(__name__)
