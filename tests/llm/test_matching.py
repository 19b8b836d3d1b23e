import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from compare import connect, differences
from llm.rows import documents, empty, plain, sentence
from pyspark.sql import functions as F

from txnrisk.llm import catalog, common, components, decontaminate, neardup, suffixes, topk

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_against_sql(spark, name):
    assert differences(catalog.QUERIES[name](spark, SF), connect(SF), catalog.ORACLE[name]) is None


def test_shingles_against_words(spark):
    rng = random.Random(8)
    texts = [b"", b"  ", b"One", b"a B c", *(sentence(rng, rng.randrange(1, 40), 9).encode() for _ in range(50))]
    words, counts = common.word_hashes(texts)
    assert counts.tolist() == [len(t.split()) for t in texts]
    hashes, n = common.shingle_hashes(words, counts, 4)
    name = {}
    for text, own in zip(texts, np.split(hashes, np.cumsum(n)[:-1])):
        w = text.lower().split()
        want = [tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        assert len(own) == len(want)
        for h, s in zip(own.tolist(), want):
            assert name.setdefault(h, s) == s
    assert len(set(name.values())) == len(name)


def test_long_texts_are_cut_at_spaces(spark, monkeypatch):
    text = sentence(random.Random(1), 500).encode()
    whole = common.word_hashes([text, b"x"])
    monkeypatch.setattr(common, "CHUNK_BYTES", 64)
    cut = common.word_hashes([text, b"x"])
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()


def brute_components(rows, size, percent):
    sets = defaultdict(list)
    for r in rows:
        w = (r["text"] or "").encode().lower().split()
        if r["doc_id"] is not None and w:
            sets[r["doc_id"]].append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))})
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and any(100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(6)
    chain = [sentence(rng, 60).split()]
    for _ in range(14):  # each like the one before, the ends unlike each other
        chain.append([*chain[-1][3:], *sentence(rng, 3).split()])
    extra = [(1000 + i, " ".join(w)) for i, w in enumerate(chain)]
    docs = documents(spark).select("doc_id", "text", "kept").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string").withColumn("kept", F.lit("x"))
    )
    want = brute_components(plain(docs), 4, 80)
    got = plain(neardup.near_duplicates(docs))
    assert len(got) == docs.count()
    for r in got:
        i = r["doc_id"]
        assert r["component_id"] == (want.get(i, i) if i is not None else None)
        assert r["kept"] == (i is None or r["component_id"] == i)
    assert want[1000] == want[1014] == 1000
    left = neardup.drop_near_duplicates(docs, 4)
    assert left.columns == docs.columns and left.count() == sum(r["kept"] for r in got)
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_members_unlike_the_smallest_are_still_linked(spark):
    """A bucket's smallest member is like none of two others, which are like each other."""
    rng = random.Random(9)
    sets = [np.unique(np.array([rng.getrandbits(64) for _ in range(100)], dtype=np.uint64)) for _ in range(2)]
    near = np.unique(np.concatenate([sets[1][:95], sets[0][:3]]))
    every = [sets[0], sets[1], near]
    sig = neardup.signatures(every)
    band = int(np.flatnonzero((sig[1].reshape(-1, 4) == sig[2].reshape(-1, 4)).all(axis=1))[0])
    ids = np.array([1, 2, 3])
    assert neardup.link_block(ids, ids, np.zeros(3), sig, every, band, (0, 0), 80) == [(2, 3)]


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (3, None), (200, 40)]
    got = {r["node"]: r["component"] for r in plain(components.components(spark.createDataFrame(links, "a long, b long"), "a", "b"))}
    assert got == {**{i: 0 for i in range(1, 41)}, 200: 0, 95: 90, 100: 90} | {k: v for k, v in got.items() if k == v}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_repeats(rows, length):
    seen = {}
    ids = lambda r: float("inf") if r["doc_id"] is None else r["doc_id"]
    texts = [(ids(r), (r["text"] or "").encode()) for r in rows]
    for i, b in texts:
        for p in range(len(b) - length + 1):
            g = b[p : p + length]
            seen[g] = min(seen.get(g, i), i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("often, length", [(512, 50), (3, 50), (512, 31)])
def test_repeats_against_brute_force(spark, monkeypatch, often, length):
    monkeypatch.setattr(suffixes, "COMMON", often)
    docs = documents(spark).filter("doc_id is null or doc_id <> 63")
    docs = docs.unionByName(spark.createDataFrame([(500, "ab" * 400), (501, "ab" * 90), (502, "x" + "ab" * 30)], "doc_id long, text string"), True)
    got = plain(suffixes.remove_repeats(docs, length))
    mine = sorted(
        (float("inf") if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
        for r in got
    )
    assert mine == brute_repeats(plain(docs), length)
    for r in got:
        assert sum(b - a for a, b in zip(r["starts"], r["ends"])) == r["n_removed"]
    assert suffixes.remove_repeats(empty(spark)).count() == 0


def test_contamination(spark):
    rng = random.Random(5)
    items = [(i, sentence(rng, n)) for i, n in enumerate([4, 5, 12, 40, 200])] + [(9, None), (10, ""), (None, sentence(rng, 9))]
    cut = items[3][1].split()
    rows = [
        (1, sentence(rng, 8000) + " " + items[2][1].upper() + "\n" + sentence(rng, 8000)),
        (2, " ".join(cut[:33])),  # 29 of 36 shingles
        (3, " ".join(cut[:32])),  # 28 of 36
        (4, "x " + items[0][1] + " y"), (5, None), (6, ""), (None, items[4][1]), (1, items[1][1]), (8, items[0][1][:-1]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    test = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_item"]) for r in plain(decontaminate.find_items(docs, test))}
    assert got == {(1, 2): (8, 8), (2, 3): (29, 36), (4, 0): (1, 1), (None, 4): (196, 196), (1, 1): (1, 1)}
    clean = decontaminate.decontaminate(docs, test)
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == ["3", "5", "6", "8"] and clean.columns == docs.columns
    assert decontaminate.find_items(docs.limit(0), test).count() == 0
    assert decontaminate.find_items(docs, test.limit(0)).count() == 0


@pytest.mark.parametrize("block", [20_000, 1])
def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
    rng = random.Random(5)
    items = [(i, sentence(rng, 9)) for i in range(3)]
    rows = [
        (None, "a " + items[0][1], 1), (None, sentence(rng, 30), 2), (None, None, 3), (None, items[2][1], 4),
        (7, items[1][1] + " b", 5), (7, sentence(rng, 30), 6), (7, sentence(rng, 30), 7), (8, "", 8),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    clean = decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, clean.collect()), key=lambda r: r[2]) == [r for r in rows if r[2] in (2, 3, 6, 7, 8)]
    assert clean.columns == docs.columns


def test_items_in_several_blocks(spark, monkeypatch):
    rng = random.Random(5)
    items = [(i, sentence(rng, 9)) for i in range(7)]
    docs = spark.createDataFrame([(i, "a " + t) for i, t in items], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    found = decontaminate.find_items(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(i, i) for i in range(7)]


def brute_top(rows, queries, k):
    good = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if v is not None and i is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q in queries:
            limited = lambda s: max(-(2**63), min(2**63 - 1, s))
            scores = sorted((-limited(sum(x * y for x, y in zip(a, b))), i) for i, b in good if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def test_reading_stops_when_outsiders_cannot_qualify(monkeypatch):
    """Fewer than all reads suffice for clear winners; ties are read to the end; no result depends on when bounds go by pairs."""
    assert list(topk.depths(10)) == [5, 8, 9, 10] and list(topk.depths(1)) == [1] and not list(topk.depths(0))
    rng = np.random.default_rng(3)
    vectors = rng.integers(-50, 50, (400, 4)).astype(float)
    vectors[:5] += 200
    seen = []
    read = topk.Lists.read
    monkeypatch.setattr(topk.Lists, "read", lambda self, depth, of: seen.append(depth) or read(self, depth, of))
    for few in (0.0, 0.03, 1.0):
        monkeypatch.setattr(topk, "FEW", few)
        for rows in (vectors, np.vstack([vectors[:1]] * 400)):
            seen.clear()
            best = topk.Best(np.array([-1]), np.ones((1, 4)), 5)
            best.add(np.arange(400), rows)
            score = rows.sum(axis=1)
            want = np.lexsort((np.arange(400), -score))[:5]
            assert best.kept[1].tolist() == want.tolist() and best.kept[2].tolist() == score[want].tolist()
            assert (max(seen) < 400) == (few > 0 and rows is vectors)


@pytest.mark.parametrize("block, scale", [(4096, 1.0), (7, 1.0), (4096, 3e6), (7, 1e9), (4096, 1e10), (7, 1e200)])
def test_top_k_against_brute_force(spark, monkeypatch, block, scale):
    monkeypatch.setattr(topk, "LIST_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * scale for _ in range(6)]) for i in range(60)]
    rows += [(60 + i, rows[5][1]) for i in range(30)] + [(200, None), (201, [None, 1.0]), (202, [float("nan")] * 6), (203, [float("inf")] * 6)]
    rows += [(204, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=20)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, set(range(0, 1000, 20)), 20)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
