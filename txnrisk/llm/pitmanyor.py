"""Hierarchical Pitman-Yor language model of words.

Every context (the word before) is a restaurant whose customers are the words that follow it; the
tables at which a dish is served are that dish's customers in the parent restaurant, which all
contexts share and which draws from the uniform distribution over the known words and one unknown.

    P(w|u) = (c_uw - d t_uw + (theta + d T_u) P(w)) / (theta + c_u)
    P(w)   = (c_w - d' t_w + (theta' + d' T) / (V + 1)) / (theta' + c)

Seating. In a Gibbs sweep the customers of every dish of every restaurant are taken out and seated
again one by one, each at a new table with probability proportional to (theta + d T_u) P(w), or at
one of the dish's tables in proportion to its customers less d; the parent restaurant, whose
customers are the tables so opened, is then reseated in the same way. All restaurants are swept at
the same time against the totals of the sweep before; a sweep starts from the counts of words and the
tables that such counts lead to on average. Several chains run side by side, and a document is
scored with the average of their predictive probabilities.

All counts cover all training documents. They are gathered by the exchange of blocks and buckets: what
a block sends is its distinct pairs of words and its distinct words. Draws are taken from hashes of
the pair and the chain, so every block that meets a pair seats it alike.

Sweeps read the books instead of the documents: of each block its words and the pairs it seats, which are
those of several customers that no block before it has. A pair with a single customer has one table
in every sweep; such pairs are added up once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm import common, exchange
from txnrisk.llm.common import by_value, discard, partitions, stage
from txnrisk.llm.exchange import NOBODY, bucket_of, documents, in_blocks, per_block, per_bucket, planes, send, unplanes

#: Marks of the beginning and the end of a text among the hashes of words.
BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
CHAINS, SWEEPS = 4, 1
#: Sweeps of the query: the first start from average seatings, the last ones from what the sweeps before led to.
QUERY_SWEEPS = 4
THETA = 1.0
#: Customers are seated one by one up to twice this number, then in steps of this share of those seated.
SINGLY = 8
#: Bytes of text in a block. Its pairs of words take about twice as much again on their way to the buckets.
BLOCK_BYTES = 8 << 20
#: Pairs that are seated in one numpy step, so that their numbers stay in a core's cache.
PAIRS = 1 << 14


def salted(key: np.ndarray, salt: int) -> np.ndarray:
    return common.mix_in_place(key ^ np.uint64(0x9E3779B97F4A7C15 * (salt + 1) % 2**64))


def uniform(key: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on the keys and the salt alone."""
    out = salted(key, salt)
    out >>= np.uint64(11)
    return out * 2.0**-53


def most_first(customers: np.ndarray) -> np.ndarray:
    """The order in which those with the most customers come first."""
    most = np.iinfo(np.uint16).max
    order = np.argsort(most - np.minimum(customers, most).astype(np.uint16), kind="stable")
    large = order[: np.count_nonzero(customers > most)]
    large[:] = large[np.argsort(-customers[large], kind="stable")]
    return order


def seat(key: np.ndarray, customers: np.ndarray, weight: np.ndarray, discount: float, chain: int, sweep: int) -> np.ndarray:
    """Tables at which each dish's customers sit when they are seated one after the other, for dishes in any order."""
    tables = np.minimum(customers, 1).astype(np.float64)
    live = np.flatnonzero(customers > 1)
    live = live[most_first(customers[live])]
    for at in range(0, len(live), PAIRS):
        here = live[at : at + PAIRS]
        tables[here] = seat_in_order(key[here], customers[here], weight[here], discount, chain, sweep)
    return tables


def seat_in_order(key: np.ndarray, customers: np.ndarray, weight: np.ndarray, discount: float, chain: int, sweep: int) -> np.ndarray:
    """Tables of dishes of two customers at least, those with the most first, so that those still to be seated are always the first ones.

    ``weight`` is (theta + d T) P(dish): the odds of a new table against customers already seated less
    discount times their tables. The first customer opens a table. Far on, where one customer
    changes little, a step seats as many as 1/SINGLY of those seated and opens the expected number of
    tables, rounded at random.
    """
    opened = np.ones(len(key))
    own, fewest_first, seated, left = salted(salted(key, chain), sweep), customers[::-1], 1, len(key)
    while left:
        step = max(1, seated // SINGLY)
        odds, now = weight[:left], opened[:left]
        opens = odds + seated
        opens -= discount * now
        if step == 1:
            np.divide(odds, opens, out=opens)
            now += uniform(own[:left], seated) < opens
        else:
            np.divide(np.minimum(step, customers[:left] - seated) * odds, opens, out=opens)
            whole = np.floor(opens)
            now += whole + (uniform(own[:left], seated) < opens - whole)
        seated += step
        left = len(key) - int(np.searchsorted(fewest_first, seated, side="right"))
    return np.minimum(opened, customers)


def expected_tables(customers: np.ndarray, discount: float) -> np.ndarray:
    """Tables of a restaurant with so many customers, on average over all dishes."""
    if discount <= 0:
        return THETA * np.log1p(customers / THETA)
    scale = math.gamma(THETA + 1) / (discount * math.gamma(THETA + discount))
    return np.minimum(customers, scale * np.maximum(customers, 0) ** discount)


class Block:
    """A block's words and pairs of words as numbers.

    ``word`` and ``pair`` are the distinct ones, in order; ``of_word`` and ``of_pair`` give them for
    every token. A text's tokens are its words and one end; ``sizes`` has their number. ``context``
    and ``follows`` are the words of a pair; the context of a first word is the number after the last word.
    """

    def __init__(self, texts: list[bytes]):
        hashes, counts = common.word_hashes(texts)
        tokens = np.empty(len(hashes) + len(texts), dtype=np.uint64)
        ends = np.cumsum(counts + 1) - 1
        inner = np.ones(len(tokens), dtype=bool)
        inner[ends] = False
        tokens[inner], tokens[ends] = hashes, END
        self.sizes = counts + 1
        del inner, hashes
        self.word, _, self.of_word = common.distinct(tokens)
        first = ends - counts
        before = np.roll(tokens, 1)
        before[first] = BEGIN
        tokens += common.mix(before)
        del before
        common.mix_in_place(tokens)
        self.pair, some, self.of_pair = common.distinct(tokens)
        del tokens
        context = np.roll(self.of_word, 1)
        context[first] = len(self.word)
        self.context, self.follows = context[some], self.of_word[some]

    def counts(self, of: np.ndarray, n: int, texts: np.ndarray) -> np.ndarray:
        """How often each word or pair is in the texts marked."""
        return np.bincount(of[np.repeat(texts, self.sizes)], minlength=n).astype(np.uint32)

    def totals(self, values: np.ndarray) -> np.ndarray:
        """Sums of the tokens' values by text; every text has an end at least."""
        return np.add.reduceat(values, np.cumsum(self.sizes) - self.sizes)


def add_up(pdf: pd.DataFrame, width: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each block, the distinct keys, every item's distinct key, and the sums of counts, a row per kind of count."""
    keys = [unplanes(x, np.uint64) for x in pdf["x"]]
    counts = np.concatenate([unplanes(x, np.uint32).reshape(width, -1) for x in pdf["y"]], axis=1)
    values, _, number = common.distinct(np.concatenate(keys))
    sums = np.stack([np.bincount(number, x, len(values)) for x in counts])
    return keys, values, number, sums


def count_items(kind: str, pdf: pd.DataFrame) -> list[tuple]:
    """Answer the blocks with the counts over all documents; for a pair, also which block keeps its books.

    Sums for the driver: of words the tokens and the distinct ones, of pairs those that occur once and twice.
    """
    bucket = int(pdf["bucket"].iloc[0])
    keys, values, number, sums = add_up(pdf, 1)
    total = sums[0].astype(np.int64)
    del sums
    facts = {"customers": total.sum(), "distinct": (total > 0).sum(), "once": (total == 1).sum(), "twice": (total == 2).sum()}
    out = [(NOBODY, f"{kind} {name}", bucket, int(x), None, None, None) for name, x in facts.items()]
    # The first block that has an item keeps its books: written backwards, the first one stays.
    holder = np.empty(len(values), dtype=np.int32)
    holder[number[::-1]] = np.arange(len(number) - 1, -1, -1, dtype=np.int32)
    first = np.zeros(len(number), dtype=bool)
    first[holder] = True
    at = 0
    for block, own in zip(pdf["block"], keys):
        here = slice(at, at + len(own))
        counts, books = total[number[here]], first[here]
        large = np.flatnonzero(counts > 254)
        small = np.where(counts > 254, 255, counts).astype(np.uint8)
        extra = np.zeros(len(large), dtype=LARGE)
        extra["at"], extra["n"] = large, counts[large]
        out.append((int(block), kind, bucket, None, small.tobytes(), np.packbits(books).tobytes(), extra.tobytes()))
        at += len(own)
    return out


LARGE = np.dtype([("at", "<u4"), ("n", "<i8")])


def counted(pdf: pd.DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The counts of a block's items and which of them it keeps books of."""
    counts, books = [np.empty(0, np.int64)], [np.empty(0, bool)]
    for row in pdf[pdf["kind"] == kind].sort_values("bucket").itertuples():
        n = np.frombuffer(row.x, dtype=np.uint8).astype(np.int64)
        extra = np.frombuffer(row.z or b"", dtype=LARGE)
        n[extra["at"]] = extra["n"]
        counts.append(n)
        books.append(np.unpackbits(np.frombuffer(row.y, dtype=np.uint8), count=len(n)).astype(bool))
    return np.concatenate(counts), np.concatenate(books)


def by_chain(numbers: np.ndarray) -> np.ndarray:
    """A row per chain. Chains differ little, so the others are told by how far they are from the first."""
    out = numbers.astype(np.int64)
    out[1:] -= out[0]
    out[1:] = (out[1:] << 1) ^ (out[1:] >> 63)
    return out.astype(np.uint32)


def of_chains(packed: bytes) -> np.ndarray:
    out = unplanes(packed, np.uint32).reshape(CHAINS, -1)
    apart = out[1:]
    out[1:] = ((apart >> np.uint32(1)) ^ -(apart & np.uint32(1))) + out[0]
    return out.T


class State:
    """What a block knows of its words after some sweeps, one column per chain.

    The last row of ``tables`` and ``customers`` is the context of first words.
    """

    def __init__(self, model: dict, n_word: np.ndarray, pdf: pd.DataFrame, sweeps: int):
        self.customers = np.append(n_word, model["texts"]).astype(np.float64)
        if sweeps == 0:
            tables = expected_tables(self.customers, model["discount"])
            parent = (n_word + THETA / (model["words"] + 1)) / (model["tokens"] + THETA)
            self.tables, self.parent = (np.repeat(x[:, None], CHAINS, axis=1) for x in (tables, parent))
            return
        known, d = model["seated"][sweeps - 1], model["parent_discount"]
        rows = pdf[pdf["kind"] == f"seated{sweeps - 1}"].sort_values("bucket")
        none = np.empty((0, CHAINS), dtype=np.uint32)
        tables, customers, seated = (np.concatenate([none, *(of_chains(x) for x in rows[c])]) for c in ("x", "y", "z"))
        self.tables = np.ascontiguousarray(np.vstack([tables.astype(np.float64), known["begin"][None, :]]))
        net = np.maximum(customers - d * seated, 0).astype(np.float32)
        base = (THETA + d * known["tables"]) / (model["words"] + 1)
        self.parent = np.ascontiguousarray((net + base) / (THETA + known["customers"]))


class Books:
    """What the sweeps need of a block. Its pairs are in order of their customers, those with the most first.

    ``word`` and ``n_word`` are its distinct words and their counts. ``pair``, ``context``, ``follows`` and ``n_pair`` are of the
    pairs that it seats. ``once`` has for each word, and last for the context of first words, the pairs with
    a single customer that it keeps the books of: those in that context, and those of that dish.
    """

    def __init__(self, pdf: pd.DataFrame):
        words, pairs = (pdf[pdf["kind"] == kind].iloc[0] for kind in ("words", "pairs"))
        self.word, self.n_word = unplanes(words["x"], np.uint64), unplanes(words["y"], np.int64)
        self.once = unplanes(words["z"], np.uint32).reshape(-1, 2)
        self.pair, self.n_pair = unplanes(pairs["x"], np.uint64), unplanes(pairs["y"], np.int64)
        self.context, self.follows = unplanes(pairs["z"], np.int32).reshape(2, -1).astype(np.intp)


def keep_books(block: int, pdf: pd.DataFrame) -> list[tuple]:
    b = Block(documents(pdf)[1])
    del b.of_word, b.of_pair  # only the distinct ones are seated
    n_word, _ = counted(pdf, "word")
    n_pair, books = counted(pdf, "pair")
    single, several = (np.flatnonzero(books & x) for x in (n_pair == 1, n_pair > 1))
    several = several[most_first(n_pair[several])]
    once = np.stack([np.bincount(x[single], minlength=len(b.word) + 1) for x in (b.context, b.follows)], axis=1)
    seats = np.stack([b.context[several], b.follows[several]])
    return [
        (block, "words", 0, None, planes(b.word), planes(n_word), planes(once.astype(np.uint32))),
        (block, "pairs", 0, None, planes(b.pair[several]), planes(n_pair[several]), planes(seats.astype(np.int32))),
    ]


def chain_tables(
    pair: np.ndarray, counts: np.ndarray, context: np.ndarray, follows: np.ndarray, state: State, model: dict, sweep: int
) -> np.ndarray:
    """Tables of pairs of several customers, those with the most first; a row per chain."""
    out, d = np.empty((CHAINS, len(pair))), model["discount"]
    for at in range(0, len(pair), PAIRS):
        some = slice(at, at + PAIRS)
        weight = (THETA + d * state.tables.take(context[some], axis=0)) * state.parent.take(follows[some], axis=0)
        for chain, odds in enumerate(np.ascontiguousarray(weight.T)):
            out[chain, some] = seat_in_order(pair[some], counts[some], odds, d, chain, sweep)
    return out


def by_column(numbers: np.ndarray) -> bytes:
    return planes(numbers.T)


def sit_down(block: int, pdf: pd.DataFrame, model: dict, sweep: int, n_buckets: int) -> list[tuple]:
    """Seat the pairs that the block keeps the books of; send the tables of each context and dish."""
    b = Books(pdf)
    state = State(model, b.n_word, pdf, sweep)
    sent = np.repeat(b.once.T, CHAINS, axis=0)
    for chain, tables in enumerate(chain_tables(b.pair, b.n_pair, b.context, b.follows, state, model, sweep)):
        sent[chain] += np.bincount(b.context, tables, sent.shape[1]).astype(np.uint32)
        sent[CHAINS + chain] += np.bincount(b.follows, tables, sent.shape[1]).astype(np.uint32)
    kind, begin = f"seated{sweep}", np.array([BEGIN])
    out = send(block, kind, bucket_of(b.word, n_buckets), b.word, sent[:, :-1].T, pack=by_column)
    return out + send(block, kind, bucket_of(begin, n_buckets), begin, sent[:, -1:].T, pack=by_column)


def reseat_parent(kind: str, pdf: pd.DataFrame, model: dict, sweep: int) -> list[tuple]:
    """Sum the tables by context and by dish over all blocks, and seat the parent's customers."""
    bucket = int(pdf["bucket"].iloc[0])
    keys, distinct, number, sums = add_up(pdf, 2 * CHAINS)
    tables, customers = sums[:CHAINS], sums[CHAINS:].astype(np.int64)
    d = model["parent_discount"]
    # The parent's tables before the sweep: those that so many customers lead to, or the last sweep's.
    if sweep:
        opened = model["seated"][sweep - 1]["tables"]
    else:
        opened = np.full(CHAINS, model["words"], dtype=np.float64)
    parent = np.empty(customers.shape, dtype=np.int64)
    out = []
    for chain in range(CHAINS):
        weight = np.full(len(distinct), (THETA + d * opened[chain]) / (model["words"] + 1))
        seated = seat(distinct, customers[chain], weight, d, chain, 1000 + sweep)
        parent[chain] = seated
        facts = {"customers": customers[chain].sum(), "tables": seated.sum(), "begin": tables[chain, distinct == BEGIN].sum()}
        out += [(NOBODY, f"{name} {chain}", bucket, int(x), None, None, None) for name, x in facts.items()]
    told, at = [by_chain(x) for x in (tables, customers, parent)], 0
    for block, own in zip(pdf["block"], keys):
        here = number[at : at + len(own)][own != BEGIN]
        at += len(own)
        out.append((int(block), kind, bucket, None, *(planes(x.take(here, axis=1)) for x in told)))
    return out


def predict_pairs(b: Block, pdf: pd.DataFrame, n_word: np.ndarray, model: dict, sweeps: int) -> np.ndarray:
    """The chains' average probability of each pair's word in its context."""
    n_pair, _ = counted(pdf, "pair")
    before, after = State(model, n_word, pdf, sweeps - 1), State(model, n_word, pdf, sweeps)
    d, p = model["discount"], np.zeros(len(b.pair))
    several = np.flatnonzero(n_pair > 1)
    several = several[most_first(n_pair[several])]
    tables = np.repeat(np.minimum(n_pair, 1).astype(np.float64)[None, :], CHAINS, axis=0)
    tables[:, several] = chain_tables(b.pair[several], n_pair[several], b.context[several], b.follows[several], before, model, sweeps - 1)
    for at in range(0, len(p), PAIRS):
        some = slice(at, at + PAIRS)
        context, follows = b.context[some], b.follows[some]
        new = (THETA + d * after.tables.take(context, axis=0)) * after.parent.take(follows, axis=0)
        for chain in range(CHAINS):
            p[some] += np.maximum(n_pair[some] - d * tables[chain, some], 0)
            p[some] += new[:, chain]
        p[some] /= CHAINS * (THETA + after.customers[context])
    return p


def score_block(pdf: pd.DataFrame, model: dict, sweeps: int, key: str) -> pd.DataFrame:
    _, texts, given = documents(pdf)
    b = Block(texts)
    n_word, _ = counted(pdf, "word")
    p = predict_pairs(b, pdf, n_word, model, sweeps)
    base = (n_word + 1) / (model["tokens"] + model["words"] + 1)
    out = pd.DataFrame({key: pd.array(given, dtype="Int64")})
    out["n_tokens"] = b.sizes
    out["n_known"] = b.totals((n_word > 0).astype(np.int64)[b.of_word])
    out["train_tokens"] = model["tokens"]
    out["base_score"] = b.totals(np.log10(base)[b.of_word])
    out["score"] = b.totals(np.log10(p)[b.of_pair])
    return out


def discount_of(once: int, twice: int) -> float:
    """The usual estimate from the numbers of items that occur once and twice."""
    return min(max(once / (once + 2 * twice), 0.05), 0.95) if once else 0.5


def score_documents(docs: DataFrame, train: Column, key: str = "doc_id", sweeps: int = SWEEPS) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score): one row per row of the documents.

    The model learns from the rows for which ``train`` is true. ASCII letters are lower-cased; tokens are the
    runs of other than ASCII white space, then one end. base_score is the add-one unigram's log10
    probability, score the model's. Null and blank texts consist of the end alone. Without training
    rows V is 0 and every token has probability 1. Repeated rows count, and are scored, each.
    """
    size = exchange.text_bytes(docs)
    n, buckets = partitions(docs.sparkSession, size, BLOCK_BYTES), max(1, -(-size // BLOCK_BYTES))
    blocks = in_blocks(docs, key, n, F.coalesce(train, F.lit(False)))

    def ask(block, pdf):
        b = Block(documents(pdf)[1])
        mark = np.array([y is not None for y in pdf[pdf["kind"] == "doc"]["y"]], dtype=bool)
        words, pairs = b.counts(b.of_word, len(b.word), mark), b.counts(b.of_pair, len(b.pair), mark)
        out = send(block, "word", bucket_of(b.word, buckets), b.word, words, pack=planes)
        return out + send(block, "pair", bucket_of(b.pair, buckets), b.pair, pairs, pack=planes)

    answers = per_bucket(per_block(blocks, ask), count_items, "lm-counts")
    total = exchange.sums(answers)
    model = {
        "tokens": total.get("word customers", 0),
        "words": total.get("word distinct", 0),
        "texts": docs.filter(train).count(),
        "discount": discount_of(total.get("pair once", 0), total.get("pair twice", 0)),
        "parent_discount": discount_of(total.get("word once", 0), total.get("word twice", 0)),
        "seated": [],
    }
    rows = blocks.unionByName(exchange.for_blocks(answers))
    books = stage(per_block(rows, keep_books), "lm-books")
    seatings: list[DataFrame] = []
    for sweep in range(sweeps):
        now = {**model, "seated": list(model["seated"])}
        known = books.unionByName(exchange.for_blocks(seatings[-1])) if seatings else books
        seated = per_block(known, lambda block, pdf, s=sweep, m=now: sit_down(block, pdf, m, s, buckets))
        seatings.append(per_bucket(seated, lambda kind, pdf, s=sweep, m=now: reseat_parent(kind, pdf, m, s), "lm-seated"))
        total = exchange.sums(seatings[-1])
        names = ("customers", "tables", "begin")
        model["seated"].append({x: np.array([float(total.get(f"{x} {c}", 0)) for c in range(CHAINS)]) for x in names})
        # A sweep asks for the last one's seatings, the probabilities for the last two: what a sweep started from and what it led to.
        if sweep + 1 < sweeps and len(seatings) > 1:
            discard(seatings.pop(0))
    discard(books)
    for seating in seatings:
        rows = rows.unionByName(exchange.for_blocks(seating))
    schema = f"{key} long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").applyInPandas(lambda pdf: score_block(pdf, model, sweeps, key), schema)


by_value(__name__)
