"""Exact removal of repeated byte strings by prefix-free parsing and a suffix array.

Parsing. A rolling hash of TRIGGER bytes runs over every text; the trigger of a string of ``length``
bytes is its smallest hash. Neighbouring strings with the same trigger form a phrase. Triggers are
a matter of content, so equal strings have equal triggers wherever they occur, and every string of
``length`` bytes lies in exactly one phrase (phrases overlap by length - 1 bytes).

Dictionary and parse. Phrases whose trigger occurs in one document only can't repeat anything and
are set aside. Of the others each distinct phrase, by a 128-bit name, is kept once; the parse is where
it occurs, in each block of documents with the smallest document there. A phrase that is all there
is of its trigger, such as any inside a copy, is thereby decided: its first document is the smallest.

Suffix array. Per trigger with several phrases, the suffixes of the distinct phrases are sorted by their first ``length``
bytes; neighbours in that order with the same bytes are one string, and its first document is the
smallest of its phrases'. (Beyond ``length`` bytes the order of the parse decides nothing here.) A
block learns which strings of its phrases occur in a document smaller than its own.

A trigger in very many documents, such as that of a common line, has a phrase for every context it
stands in. Its phrases are cut into single strings, which are dealt by their own hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm import common, exchange
from txnrisk.llm.common import by_value
from txnrisk.llm.exchange import bucket_of, documents, in_blocks, per_block, per_bucket, received, send

TRIGGER = 24
#: Most strings in a phrase; a longer one, of periodic text, is cut, which loses nothing.
WIDEST = 64
#: A trigger in at least this many documents is common; a block reports at most REPORTED of its own.
COMMON, REPORTED = 512, 64
#: Bytes hashed at a time, and suffixes sorted at a time.
CHUNK = 1 << 18
SORTED = 1 << 18
_FORWARD = common.powers(CHUNK + 256)
_INVERSE = np.cumprod(np.r_[np.uint64(1), np.full(CHUNK + 255, pow(common._BASE, -1, 2**64), np.uint64)], dtype=np.uint64)


class Phrases:
    """The phrases of a block's texts, as arrays: trigger, hash, number of strings, text, place."""

    def __init__(self, texts: list[bytes], length: int):
        self.texts, self.length = texts, length
        parts: list[tuple] = []
        group: list[tuple[int, int, bytes]] = []
        held = 0
        for i, text in enumerate(texts):
            step = CHUNK - length + 1
            for at in range(0, max(len(text) - length + 1, 0), step):
                piece = text[at : at + CHUNK]  # overlaps the next by length - 1 bytes
                if held + len(piece) > CHUNK:
                    parts.append(self._parse(group))
                    group, held = [], 0
                group.append((i, at, piece))
                held += len(piece)
        if group:
            parts.append(self._parse(group))
        kinds = (np.uint64, np.uint64, np.uint8, np.int64, np.int64)
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, t) for t in kinds]
        self.trigger, self.hash, self.strings, self.text, self.place = columns

    def _parse(self, group: list[tuple[int, int, bytes]]) -> tuple:
        length = self.length
        a = np.frombuffer(b"".join(p for *_, p in group), dtype=np.uint8)
        sizes = np.array([len(p) for *_, p in group])
        starts = np.cumsum(sizes) - sizes
        letter = common._BYTE[a]
        rolled, width, known = letter, 1, {1: letter}
        while width * 2 <= TRIGGER:
            rolled = rolled[:-width] * _FORWARD[width] + rolled[width:]
            width *= 2
            known[width] = rolled
        while width < TRIGGER:
            more = max(w for w in known if w <= TRIGGER - width)
            n = len(a) - width - more + 1
            rolled = rolled[:n] * _FORWARD[more] + known[more][width : width + n]
            width += more
        least, span = common.mix(rolled), 1
        reach = length - TRIGGER + 1
        while span * 2 <= reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < reach:
            least = np.minimum(least[: len(least) - (reach - span)], least[reach - span :])
        valid = np.zeros(len(a) + 1, dtype=np.int8)
        valid[starts] += 1
        valid[starts + sizes - length + 1] -= 1
        valid = np.cumsum(valid[:-1]).astype(bool)[: len(least)]
        begins = valid.copy()
        begins[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
        first = np.flatnonzero(begins)
        before = np.cumsum(valid) - valid
        strings = np.diff(np.append(before[first], np.count_nonzero(valid)))
        cuts = -(-strings // WIDEST)
        nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        place = np.repeat(first, cuts) + nth * WIDEST
        strings = np.minimum(np.repeat(strings, cuts) - nth * WIDEST, WIDEST)
        total = np.zeros(len(a) + 1, dtype=np.uint64)
        np.cumsum(letter * _FORWARD[: len(a)], out=total[1:])
        content = (total[place + strings + length - 1] - total[place]) * _INVERSE[place]
        content = common.mix(content + strings.astype(np.uint64))
        which = np.searchsorted(starts, place, side="right") - 1
        text = np.array([i for i, *_ in group])[which]
        offset = np.array([at for _, at, _ in group])[which] + place - starts[which]
        # Minima crowd at small values; mixed, they are spread evenly over the buckets.
        return common.mix(least[place]), content, strings.astype(np.uint8), text, offset

    def take(self, chosen: np.ndarray) -> None:
        for name in ("trigger", "hash", "strings", "text", "place"):
            setattr(self, name, getattr(self, name)[chosen])

    def cut(self, chosen: np.ndarray) -> None:
        """Replace the chosen phrases by their strings, each named by a 128-bit hash of its own."""
        if not chosen.any():
            return
        at = np.flatnonzero(chosen)
        order = at[np.lexsort((self.hash[at], self.trigger[at]))]
        same = np.ones(len(order), dtype=bool)
        t, h = self.trigger[order], self.hash[order]
        same[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
        first, of = order[same], np.cumsum(same) - 1
        pairs: list[bytes] = []
        for t, p, n in zip(self.text[first].tolist(), self.place[first].tolist(), self.strings[first].tolist()):
            whole = self.texts[t]
            pairs += (hashlib.blake2b(whole[q : q + self.length], digest_size=16).digest() for q in range(p, p + n))
        hashes = np.frombuffer(b"".join(pairs), dtype="<u8").reshape(-1, 2)
        begin = np.cumsum(self.strings[first].astype(np.int64)) - self.strings[first]
        n = self.strings[order].astype(np.int64)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hashes = hashes[np.repeat(begin[of], n) + inner]
        text, place = np.repeat(self.text[order], n), np.repeat(self.place[order], n) + inner
        rest = ~chosen
        self.trigger = np.concatenate([self.trigger[rest], hashes[:, 0]])
        self.hash = np.concatenate([self.hash[rest], hashes[:, 1]])
        self.strings = np.concatenate([self.strings[rest], np.ones(len(hashes), np.uint8)])
        self.text = np.concatenate([self.text[rest], text])
        self.place = np.concatenate([self.place[rest], place])

    def distinct(self, ids: np.ndarray):
        """Distinct phrases in order of trigger and hash: one occurrence of each, the smallest
        document with it here, and for every phrase the number of its distinct phrase."""
        owner = ids[self.text] if len(self.text) else np.empty(0, np.int64)
        order = np.lexsort((owner, self.hash, self.trigger))
        new = np.ones(len(order), dtype=bool)
        t, h = self.trigger[order], self.hash[order]
        new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        some = order[new]
        return some, owner[some], number


def low(key: np.ndarray) -> np.ndarray:
    return (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def report_triggers(block: int, phrases: Phrases, ids: np.ndarray, n_buckets: int) -> list[tuple]:
    """The block's triggers, each as often as documents here have it, REPORTED times at most."""
    owner = ids[phrases.text]
    order = np.lexsort((owner, phrases.trigger))
    t, o = phrases.trigger[order], owner[order]
    pair = np.ones(len(t), dtype=bool)
    pair[1:] = (t[1:] != t[:-1]) | (o[1:] != o[:-1])
    values, counts = np.unique(t[pair], return_counts=True)
    keys = np.repeat(values, np.minimum(counts, REPORTED))
    return send(block, "trigger", bucket_of(keys, n_buckets), low(keys))


def shared_triggers(pdf: pd.DataFrame) -> list[tuple]:
    """For each block those of its triggers that some other document has, and the common ones."""
    own = [np.frombuffer(x, dtype=np.uint32) for x in pdf["x"]]
    values, counts = np.unique(np.concatenate(own), return_counts=True)
    shared, often = values[counts > 1], values[counts >= COMMON]
    bucket, out = int(pdf["bucket"].iloc[0]), []
    for block, mine in zip(pdf["block"], own):
        mine = np.unique(mine)
        here = mine[np.isin(mine, shared, assume_unique=True)]
        if len(here):
            common_here = here[np.isin(here, often, assume_unique=True)]
            where = np.uint64(bucket << 32)
            out.append((int(block), "shared", bucket, None, (here + where).tobytes(), (common_here + where).tobytes(), None))
    return out


def keep_shared(pdf: pd.DataFrame, length: int, n_buckets: int):
    """A block's ids, texts and the phrases whose triggers are shared, common ones cut."""
    ids, texts, given = documents(pdf)
    phrases = Phrases(texts, length)
    shared, often = (np.sort(x) for x in received(pdf, "shared", (np.uint64, np.uint64)))
    key = (bucket_of(phrases.trigger, n_buckets).astype(np.uint64) << np.uint64(32)) | low(phrases.trigger)
    phrases.take(np.isin(key, shared))
    key = (bucket_of(phrases.trigger, n_buckets).astype(np.uint64) << np.uint64(32)) | low(phrases.trigger)
    phrases.cut(np.isin(key, often))
    return ids, texts, given, phrases


def send_names(block: int, phrases: Phrases, ids: np.ndarray, n_buckets: int) -> list[tuple]:
    """The block's distinct phrases by trigger and hash, with the smallest document that has each."""
    some, owner, _ = phrases.distinct(ids)
    trigger = phrases.trigger[some]
    return send(block, "name", bucket_of(trigger, n_buckets), trigger, phrases.hash[some], owner)


def answer_names(pdf: pd.DataFrame) -> list[tuple]:
    """For each block and phrase: whether a smaller document has it, and whether its trigger has others."""
    trigger, hashes, owner = (
        np.concatenate([np.frombuffer(x, dtype=t) for x in pdf[c]]) for c, t in (("x", "<u8"), ("y", "<u8"), ("z", "<i8"))
    )
    order = np.lexsort((owner, hashes, trigger))
    t, h = trigger[order], hashes[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = t[1:] != t[:-1]
    new = first.copy()
    new[1:] |= h[1:] != h[:-1]
    smallest = owner[order][new][np.cumsum(new) - 1]
    group = np.cumsum(first) - 1
    several = np.bincount(group, new)[group] > 1
    answers = np.empty((2, len(order)), dtype=bool)
    answers[0, order], answers[1, order] = smallest < owner[order], several
    bucket, out, at = int(pdf["bucket"].iloc[0]), [], 0
    for block, own in zip(pdf["block"], pdf["x"]):
        bits = answers[:, at : at + len(own) // 8]
        at += len(own) // 8
        out.append((int(block), "named", bucket, bits.shape[1], *(np.packbits(x).tobytes() for x in bits), None))
    return out


def named(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """What came back for the block's distinct phrases, in their order."""
    smaller, several = [np.empty(0, bool)], [np.empty(0, bool)]
    for row in pdf[pdf["kind"] == "named"].sort_values("bucket").itertuples():
        for into, bits in ((smaller, row.x), (several, row.y)):
            into.append(np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=int(row.id)).astype(bool))
    return np.concatenate(smaller), np.concatenate(several)


def send_phrases(block: int, phrases: Phrases, ids: np.ndarray, several: np.ndarray, n_buckets: int) -> list[tuple]:
    """The distinct phrases whose triggers have others: trigger, hash, strings, smallest document; the bytes."""
    some, owner, _ = phrases.distinct(ids)
    some, owner = some[several], owner[several]
    bucket = bucket_of(phrases.trigger[some], n_buckets)
    out = []
    cuts = np.flatnonzero(np.diff(bucket)) + 1 if len(bucket) else []
    for at in np.split(np.arange(len(bucket)), cuts) if len(bucket) else []:
        chosen = some[at]
        fields = np.zeros(len(at), dtype=FIELDS)
        fields["trigger"], fields["hash"] = phrases.trigger[chosen], phrases.hash[chosen]
        fields["strings"], fields["owner"] = phrases.strings[chosen], owner[at]
        sizes = phrases.strings[chosen].astype(np.int64) + phrases.length - 1
        spots = zip(phrases.text[chosen].tolist(), phrases.place[chosen].tolist(), sizes.tolist())
        content = b"".join(phrases.texts[t][p : p + s] for t, p, s in spots)
        out.append((block, "phrase", int(bucket[at[0]]), None, fields.tobytes(), content, None))
    return out


FIELDS = np.dtype([("trigger", "<u8"), ("hash", "<u8"), ("owner", "<i8"), ("strings", "u1")])


def first_documents(content: np.ndarray, start: np.ndarray, strings: np.ndarray, owner: np.ndarray, trigger: np.ndarray, length: int) -> np.ndarray:
    """For each string of each distinct phrase, the smallest document that has it.

    The suffix array of the phrases of one trigger: suffixes in order of their first ``length`` bytes.
    """
    n = strings.astype(np.int64)
    begin = np.cumsum(n) - n
    out = np.repeat(owner, n)
    several = np.zeros(len(trigger), dtype=bool)
    several[1:] |= trigger[1:] == trigger[:-1]
    several[:-1] |= trigger[1:] == trigger[:-1]
    group = np.flatnonzero(several)
    at = 0
    while at < len(group):
        # As many whole triggers as have about SORTED suffixes.
        end = int(np.searchsorted(np.cumsum(n[group[at:]]), SORTED, side="right")) + at
        end = max(end, at + 1)
        while end < len(group) and trigger[group[end]] == trigger[group[end - 1]]:
            end += 1
        part = group[at:end]
        m = n[part]
        inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        place = np.repeat(start[part], m) + inner
        suffix = np.zeros((len(place), -(-length // 8) * 8), dtype=np.uint8)
        suffix[:, :length] = content[place[:, None] + np.arange(length)]
        words = suffix.view(">u8").astype(np.uint64)  # eight bytes at a time, in the order of the bytes
        order = np.lexsort(words.T[::-1])
        new = np.ones(len(order), dtype=bool)
        new[1:] = (words[order[1:]] != words[order[:-1]]).any(axis=1)
        holder = np.repeat(owner[part], m)[order]
        least = np.minimum.reduceat(holder, np.flatnonzero(new))[np.cumsum(new) - 1]
        where = (np.repeat(begin[part], m) + inner)[order]
        out[where] = least
        at = end
    return out


def answer_phrases(pdf: pd.DataFrame, length: int) -> list[tuple]:
    """For each block, one 64-bit mask per phrase: which strings occur in a smaller document."""
    fields = [np.frombuffer(x, dtype=FIELDS) for x in pdf["x"]]
    every = np.concatenate(fields)
    content = np.frombuffer(b"".join(pdf["y"]), dtype=np.uint8)
    sizes = every["strings"].astype(np.int64) + length - 1
    start = np.cumsum(sizes) - sizes
    order = np.lexsort((every["owner"], every["hash"], every["trigger"]))
    t, h = every["trigger"][order], every["hash"][order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    some = order[new]
    strings = every["strings"][some]
    first = first_documents(content, start[some], strings, every["owner"][some], every["trigger"][some], length)
    begin = np.cumsum(strings.astype(np.int64)) - strings
    n = every["strings"].astype(np.int64)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    smaller = first[np.repeat(begin[number], n) + inner] < np.repeat(every["owner"], n)
    bits = np.where(smaller, np.uint64(1) << inner.astype(np.uint64), np.uint64(0))
    masks = np.bitwise_or.reduceat(bits, np.cumsum(n) - n)
    bucket, out, at = int(pdf["bucket"].iloc[0]), [], 0
    for block, own in zip(pdf["block"], fields):
        out.append((int(block), "mask", bucket, None, masks[at : at + len(own)].tobytes(), None, None))
        at += len(own)
    return out


def removed_runs(phrases: Phrases, smaller: np.ndarray, several: np.ndarray, masks: np.ndarray, ids: np.ndarray):
    """Per text with removals: the maximal removed runs as (starts, ends)."""
    some, owner, number = phrases.distinct(ids)
    if not len(number):
        return {}
    n = phrases.strings.astype(np.int64)
    every = np.where(n == 64, ~np.uint64(0), (np.uint64(1) << (n % 64).astype(np.uint64)) - np.uint64(1))
    found = np.where(smaller, ~np.uint64(0), np.uint64(0))
    found[several] = masks
    later = ids[phrases.text] > owner[number]
    mask = np.where(later, every, found[number] & every)
    some = np.flatnonzero(mask)
    m = n[some]
    inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    hit = (np.repeat(mask[some], m) >> inner.astype(np.uint64)) & np.uint64(1) == 1
    text = np.repeat(phrases.text[some], m)[hit]
    place = (np.repeat(phrases.place[some], m) + inner)[hit]
    order = np.lexsort((place, text))
    text, place = text[order], place[order]
    out = {}
    cuts = np.flatnonzero(np.diff(text)) + 1
    for t, p in zip(text[np.r_[0, cuts]] if len(text) else [], np.split(place, cuts)):
        apart = np.flatnonzero(np.diff(p) > phrases.length)  # runs that touch are one
        out[int(t)] = (p[np.r_[0, apart + 1]], p[np.r_[apart, len(p) - 1]] + phrases.length)
    return out


def remove_repeats(docs: DataFrame, length: int = 50, key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept, starts, ends): one row per row of the documents.

    Texts are UTF-8 bytes, null as empty. A byte is removed if it is covered by a string of ``length``
    bytes that also occurs in a document of smaller id; strings are judged on the input and never cross
    documents. ``kept`` are the remaining bytes, ``starts`` and ``ends`` the maximal removed runs.
    Texts shorter than ``length`` stay. Rows that repeat an id remove nothing from each other; a null id
    counts as larger than all others.
    """
    if not TRIGGER <= length:
        raise ValueError(f"length must be at least {TRIGGER}")
    n = exchange.block_count(docs)
    blocks = in_blocks(docs, key, n)

    def triggers(block, pdf):
        ids, texts, _ = documents(pdf)
        return report_triggers(block, Phrases(texts, length), ids, n)

    shared = per_bucket(per_block(blocks, triggers), lambda _, pdf: shared_triggers(pdf), "triggers")

    rows = blocks.unionByName(shared)

    def names(block, pdf):
        ids, _, _, found = keep_shared(pdf, length, n)
        return send_names(block, found, ids, n)

    rows = rows.unionByName(per_bucket(per_block(rows, names), lambda _, pdf: answer_names(pdf), "names"))

    def phrases(block, pdf):
        ids, _, _, found = keep_shared(pdf, length, n)
        return send_phrases(block, found, ids, named(pdf)[1], n)

    rows = rows.unionByName(per_bucket(per_block(rows, phrases), lambda _, pdf: answer_phrases(pdf, length), "phrases"))

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, texts, given, found = keep_shared(pdf, length, n)
        (mask,) = received(pdf, "mask", (np.uint64,))
        runs = removed_runs(found, *named(pdf), mask, ids)
        rows = []
        for i, (doc, text) in enumerate(zip(given, texts)):
            starts, ends = runs.get(i, (np.empty(0, np.int64), np.empty(0, np.int64)))
            kept = b"".join(text[a:b] for a, b in zip(np.r_[0, ends].tolist(), np.r_[starts, len(text)].tolist()))
            rows.append((doc, len(text), len(text) - len(kept), len(starts), kept, starts.tolist(), ends.tolist()))
        out = pd.DataFrame(rows, columns=[key, "n_bytes", "n_removed", "n_spans", "kept", "starts", "ends"])
        out[key] = out[key].astype("Int64")
        return out

    schema = f"{key} long, n_bytes long, n_removed long, n_spans long, kept binary, starts array<long>, ends array<long>"
    return rows.groupBy("block").applyInPandas(finish, schema)


by_value(__name__)
