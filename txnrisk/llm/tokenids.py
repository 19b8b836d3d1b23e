"""Token ids of all documents in binary shards, in the order of the documents' ids.

Documents are dealt by ranges of (id, hash of the text, place in the input), so neither an id nor a text
that a third of the rows share fills a partition. A task encodes its range in order and cuts the
ids into shards of bounded size; each shard is one file with the wavelet matrix of its ids
(:mod:`txnrisk.llm.wavelet`) and a directory of its documents. Spark writes and reads the files, in
whatever store the folder lies. What precedes a shard is summed over the shards' sizes, in two steps.
"""

from __future__ import annotations

import json
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.llm.common import by_value, join_facts, schema_of, stage, texts_of
from txnrisk.llm.wavelet import Wavelet, build
from txnrisk.session import new_folder

#: Bytes of text in a range: a task that has met many words already encodes few new ones.
RANGE_BYTES = 48 << 20
#: Ids in a shard, beyond which it is closed; a document is never cut.
SHARD_TOKENS = 1 << 20
#: Bytes of text that are split and encoded at a time.
STEP_BYTES = 3 << 20
#: Words whose ids a task keeps; above that it starts anew, which changes no id.
MOST_WORDS = 500_000
#: Marks that end a word: ASCII punctuation but for the apostrophe, which may begin one.
MARKS = string.punctuation.replace("'", "")
#: Letters up to U+00FF that have one lower case each and don't combine; a word of them, and what marks may follow.
LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
ENDED = "[0-9A-Za-zÀ-ÖØ-öø-ÿ]$"
#: Words that the library gets at a time.
WORDS = 4096
#: Shards of a range are numbered from the range's number times this.
PER_RANGE = 1 << 32
#: Ranges whose sizes are summed in one group.
GROUP = 1024
SHARD = "shard long, n_docs long, n_tokens long, doc_ids binary, sizes binary, ids binary"


def ragged(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of an array that begin there and have those sizes, one after the other."""
    ends = np.cumsum(size, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 2**31 else np.int64
    place = np.arange(total, dtype=kind)
    place += np.repeat((begin - (ends - size)).astype(kind), size)
    return flat[place]


def splits_words(definition: dict) -> bool:
    """Whether a file's rules drop white space, ignore case, and keep letters and digits apart from marks."""
    steps = [x.get("type") for x in (definition.get("normalizer") or {}).get("normalizers", [])]
    cut = (definition.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    pattern = cut[0].get("pattern", {}).get("Regex", "")
    removes = cut[0].get("behavior") == "Removed" and cut[0].get("invert")
    return "Lowercase" in steps and removes and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def passes_words(definition: dict) -> bool:
    """Whether the rules pass a word of letters up to U+00FF on to the model whole, in lower case, byte by byte."""
    steps = {x.get("type") for x in (definition.get("normalizer") or {}).get("normalizers", [])}
    cut = (definition.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if not splits_words(definition) or not steps <= {"NFC", "Replace", "Lowercase"}:
        return False
    return [x.get("type") for x in cut] == ["Split", "ByteLevel"] and not cut[1].get("add_prefix_space") and not cut[1].get("use_regex")


class Encoder:
    """Ids by the library, word by word: its rules never join what ASCII white space divides.

    Nor do they join a letter or digit and punctuation, or tell A-Z from a-z; so words are taken without case
    and end marks, and each is encoded once. Where the file's rules leave words of plain letters whole, these go
    to its model directly. :func:`splits_words` says which files have such rules. The known words and their
    ids are kept in arrays and looked up together.
    """

    def __init__(self, definition: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        if not splits_words(json.loads(definition)):
            raise ValueError("words can't be encoded apart by this file's rules")
        self.model = None
        if passes_words(json.loads(definition)):
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # Bytes that are no visible sign stand for themselves by the alphabet's further signs, in order.
        alphabet = set(pre_tokenizers.ByteLevel.alphabet())
        hidden = [b for b in range(256) if chr(b) not in alphabet]
        self.signs = np.arange(256, dtype="<u4")
        self.signs[hidden] = sorted(ord(c) for c in alphabet if ord(c) > 255)
        self.signs[ord(" ")] = ord(" ")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([""], pa.large_utf8())
        self.flat, self.size = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.flat, self.size = np.concatenate([self.flat, ids]), np.concatenate([self.size, sizes])

    def _find(self, words: pa.Array) -> pa.Array:
        """The words' numbers, null if unknown."""
        return pc.index_in(words, value_set=self.words)

    def _one_by_one(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids by the whole of the library's rules, and their number per word."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def _together(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of plain letters, as one text; it is cut where the vocabulary marks a word's end."""
        whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
        [text] = pc.binary_join(whole, pa.scalar(" ", pa.large_utf8())).to_pylist()
        if self.model is None:
            [found] = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        else:
            signs = self.signs[np.frombuffer(text.lower().encode("utf-8"), np.uint8)]
            [found] = self.model.encode_batch_fast([signs.tobytes().decode("utf-32-le")], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words) or last[-1] != len(ids) - 1:
            return self._one_by_one(words)
        return ids, np.diff(last, prepend=-1).astype(np.int64)

    def _add(self, words: pa.Array, encode) -> None:
        found = [encode(words.slice(at, WORDS)) for at in range(0, len(words), WORDS)]
        if found:
            self._learn(words, *map(np.concatenate, zip(*found)))

    def _numbers(self, chunks: pa.Array) -> np.ndarray:
        """The numbers of the chunks' ids; unknown words are encoded first, then put together."""
        numbers = self._find(chunks)
        unknown = pc.is_null(numbers)
        new = chunks.filter(unknown)
        cores = pc.utf8_rtrim(new, MARKS)
        apart = pc.and_(pc.not_equal(cores, new), pc.match_substring_regex(cores, ENDED))
        apart = pc.and_not(apart, pc.match_substring(new, "<|"))
        whole, ended, cores = new.filter(pc.invert(apart)), new.filter(apart), cores.filter(apart)
        marks = pc.struct_field(pc.extract_regex(ended, f"(?P<marks>[{re.escape(MARKS)}]+)$"), "marks").cast(pa.large_utf8())
        parts = pa.concat_arrays([whole, cores, marks])
        words = parts.unique()
        words = words.filter(pc.is_null(self._find(words)))
        plain = pc.match_substring_regex(words, LETTERS)
        self._add(words.filter(plain), self._together)
        self._add(words.filter(pc.invert(plain)), self._one_by_one)
        found = self._find(parts).to_numpy().astype(np.int64)
        pairs = found[len(whole) :].reshape(2, -1).T
        sizes, begin = self.size[pairs], (np.cumsum(self.size) - self.size)[pairs]
        joined = len(self.words) + np.arange(len(ended))
        self._learn(ended, ragged(self.flat, begin.ravel(), sizes.ravel()), sizes.sum(axis=1))
        apart, unknown = (x.to_numpy(zero_copy_only=False) for x in (apart, unknown))
        out, late = numbers.fill_null(0).to_numpy().astype(np.int64), np.empty(len(new), np.int64)
        late[~apart], late[apart] = found[: len(whole)], joined
        out[unknown] = late
        return out

    def _step(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and their number per text."""
        if len(self.words) > MOST_WORDS:
            self._forget()
        whole = pa.array([x if b"<|" in x else x.lower() for x in texts], pa.large_binary())  # "<|": may be a special token
        lists = pc.ascii_split_whitespace(whole.view(pa.large_utf8()))
        offsets = lists.offsets.to_numpy()
        chunks = lists.flatten().dictionary_encode()
        which = self._numbers(chunks.dictionary)[chunks.indices.to_numpy(zero_copy_only=False)]
        counts = self.size[which]
        before = np.concatenate([[0], np.cumsum(counts)])
        return ragged(self.flat, (np.cumsum(self.size) - self.size)[which], counts), np.diff(before[offsets])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text; one larger than a step is worked off in pieces cut at white space."""
        out: list[np.ndarray] = []
        step: list[bytes] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if step:
                ids, counts = self._step(step)
                out.extend(np.split(ids, np.cumsum(counts)[:-1]))
            step.clear()
            held = 0

        for text in texts:
            if held + len(text) > STEP_BYTES:
                flush()
            if len(text) <= STEP_BYTES:
                step.append(text)
                held += len(text)
                continue
            pieces, at = [], 0
            while at < len(text):
                end = min(at + STEP_BYTES, len(text))
                if end < len(text):
                    cuts = [text.find(c, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")]
                    end = min((c for c in cuts if c >= 0), default=len(text))
                pieces.append(self._step([text[at:end]])[0])
                at = end
            out.append(np.concatenate(pieces))
        flush()
        return out


def in_order(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ids and texts, dealt by ranges and sorted: ids ascending, null first.

    Rows of one id are in order of a hash of their texts, equal rows in order of the input.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"),
    )
    order = ["key", "tie", "place"]
    ranges = max(1, -(-total // RANGE_BYTES), min(spark.sparkContext.defaultParallelism, total >> 20))
    return rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("key", "text")


def write_shards(docs: DataFrame, definition: str, end: int | None, key: str = "doc_id", shard_tokens: int = SHARD_TOKENS) -> str:
    """Encode every whole text, append the id ``end`` (none if null) and write the shards; returns their folder.

    ``definition`` is the content of a file of the tokenizers library; it reaches the tasks by
    broadcast. A null text is empty. All rows stay, those without an id come first.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(definition)
    last = np.array([] if end is None else [end], dtype=np.uint32)

    def encode(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        encoder, number = Encoder(sent.value), TaskContext.get().partitionId() * PER_RANGE
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        sizes: list[int] = []
        held = 0

        def shard() -> pa.RecordBatch:
            nonlocal number, held
            row = (number, len(keys), held, packed_keys(keys), np.array(sizes, "<u8").tobytes(), build(np.concatenate(ids)))
            kinds = [pa.int64()] * 3 + [pa.binary()] * 3
            out = pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)
            keys.clear(), ids.clear(), sizes.clear()
            number, held = number + 1, 0
            return out

        for batch in batches:
            for at, texts in by_size(texts_of(batch.column(1))):
                for k, found in zip(batch.column(0).slice(at, len(texts)).to_pylist(), encoder.encode(texts)):
                    keys.append(k)
                    ids += [found, last]
                    sizes.append(len(found) + len(last))
                    held += sizes[-1]
                    if held >= shard_tokens:
                        yield shard()
        if keys:
            yield shard()

    schema = schema_of(SHARD)
    names = schema.fieldNames()
    folder = new_folder(spark, "token-shards")
    in_order(docs, key).mapInArrow(encode, schema).write.option("maxRecordsPerFile", 1).parquet(folder)
    return folder


def by_size(texts: list[bytes], most: int = STEP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Stretches of a list of texts with about that many bytes, and where each begins."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield begin, texts[begin:i]
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


def packed_keys(keys: list[int | None]) -> bytes:
    """The ids of a shard's documents and which are null, deflated."""
    null = np.array([k is None for k in keys], dtype=np.uint8)
    values = np.array([k or 0 for k in keys], dtype="<i8")
    return zlib.compress(null.tobytes() + values.tobytes(), 1)


def unpacked_keys(data: bytes, n: int) -> list[int | None]:
    raw = zlib.decompress(data)
    null = np.frombuffer(raw, np.uint8, n).astype(bool)
    return [None if gone else k for gone, k in zip(null.tolist(), np.frombuffer(raw, "<i8", n, n).tolist())]


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schema_of(SHARD)).parquet(folder)


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, shard_start): ids of all shards before; reads the sizes only.

    Summed within groups of ranges, then over the groups, of which there are a thousandth as many.
    """
    sized = _shards(spark, folder).select("shard", "n_tokens").withColumn("group", F.floor(F.col("shard") / (PER_RANGE * GROUP)))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.sum("n_tokens").over(Window.partitionBy("group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    groups = sized.groupBy("group").agg(F.sum("n_tokens").alias("n"))
    groups = groups.select("group", F.coalesce(F.sum("n").over(before.orderBy("group")), F.lit(0)).alias("before"))
    return sized.withColumn("inside", F.coalesce(inside, F.lit(0))).join(groups, "group").select(
        "shard", (F.col("inside") + F.col("before")).cast("long").alias("shard_start")
    )


def _per_shard(spark: SparkSession, folder: str, work, schema: str) -> DataFrame:
    """work(shard number, ids of documents, their sizes, wavelet) gives columns; one shard at a time.

    The rows get ``start``, the ids of all documents before, from ``local`` within the shard.
    """
    kinds = schema_of(f"shard long, local long, {schema}")
    names = kinds.fieldNames()

    def read(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        types = [f.type for f in to_arrow_schema(kinds)]
        for batch in batches:
            for i in range(batch.num_rows):
                number, n, _, keys, sizes, ids = (batch.column(c)[i].as_py() for c in range(6))
                columns = work(unpacked_keys(keys, n), np.frombuffer(sizes, "<u8").astype(np.int64), Wavelet(ids))
                arrays = [pa.array(c, k) for c, k in zip(columns, types[1:])]
                if len(arrays[0]):
                    yield pa.RecordBatch.from_arrays([pa.array([number] * len(arrays[0]), pa.int64()), *arrays], names)

    rows = _shards(spark, folder).mapInArrow(read, kinds)
    starts = stage(shard_starts(spark, folder), "shard-starts")
    placed = join_facts(rows, starts, "shard", F.col("local"))
    return placed.withColumn("start", F.col("shard_start") + F.col("local")).drop("shard", "local", "shard_start")


def read_documents(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids): every document's ids as little-endian 32-bit numbers, from the files."""

    def documents(keys, sizes, wavelet):
        ids, ends = wavelet.all().astype("<u4"), np.cumsum(sizes)
        return ends - sizes, keys, sizes, [ids[e - s : e].tobytes() for e, s in zip(ends.tolist(), sizes.tolist())]

    found = _per_shard(spark, folder, documents, f"{key} long, n_tokens long, ids binary")
    return found.select(key, "start", "n_tokens", "ids")


def count_tokens(spark: SparkSession, folder: str, tokens: list[int]) -> DataFrame:
    """(token, n): how often each id occurs in all documents, by rank; an id that never does has 0."""

    def counts(keys, sizes, wavelet):
        return [0] * len(tokens), tokens, [wavelet.count(t) for t in tokens]

    wanted = spark.createDataFrame([(t,) for t in tokens], "token long")
    found = _per_shard(spark, folder, counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return wanted.join(found, "token", "left").fillna(0, "n")


def find_token(spark: SparkSession, folder: str, token: int, key: str = "doc_id") -> DataFrame:
    """(key, start, offset): the documents with an id and its places in them, by select."""

    def places(keys, sizes, wavelet):
        found, ends = wavelet.places(token), np.cumsum(sizes)
        which = np.searchsorted(ends, found, side="right")
        begin = (ends - sizes)[which]
        return begin, [keys[i] for i in which.tolist()], found - begin

    found = _per_shard(spark, folder, places, f"{key} long, offset long")
    return found.select(key, "start", "offset")


by_value(__name__)
