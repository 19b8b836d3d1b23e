"""Token files, conversation repair and spelling variants against brute force."""

import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from compare import connect, differences
from llm.rows import documents, empty, plain
from pyspark.sql import functions as F

from txnrisk.llm import catalog, common, conversations, spelling, tokenids
from txnrisk.llm.wavelet import BLOCK, Wavelet, build

SF = "/root/testdata/sf0.001"
DEFINITION = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()


# -- token ids ---------------------------------------------------------------------------------


@pytest.mark.parametrize("n, most", [(0, 5), (1, 1), (1, 50_000), (7, 2), (1000, 49_408), (2 * BLOCK + 3, 300), (BLOCK, 2**32)])
def test_wavelet(n, most):
    rng = np.random.default_rng(n)
    ids = (rng.integers(0, most, n) // rng.integers(1, 9, n)).astype(np.uint32)
    w = Wavelet(build(ids))
    assert len(w) == n and np.array_equal(w.all(), ids)
    some = rng.integers(0, n, 50) if n else np.empty(0, int)
    assert np.array_equal(w.access(some), ids[some])
    for token in [*ids[some[:8]].tolist(), 0, most, 2**32 + 1]:
        low, high = sorted(rng.integers(0, n + 1, 2).tolist())
        inside = np.flatnonzero(ids[low:high] == token) + low
        assert w.count(token, low, high) == len(inside) and np.array_equal(w.places(token, low, high), inside)
        assert w.count(token) == (ids == token).sum() and np.array_equal(w.places(token), np.flatnonzero(ids == token))


def test_wavelet_opens_few_blocks_and_refuses_other_files():
    w = Wavelet(build(np.arange(8 * BLOCK, dtype=np.uint32) % 1000))
    w.access([5])
    assert len(w._open) == w.planes
    with pytest.raises(ValueError):
        Wavelet(b"something else")


def test_words_give_the_librarys_ids_of_the_whole_text(monkeypatch):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(DEFINITION)
    texts = [
        "", " ", "It's  the cat's\tDON'T\n\n12345 x\x0by", "é é ́x   ab\x1cc\x85d", "日本 語 😀😀", "<|endoftext|> a<|endoftext|>b",
        "ΣΑΣ ßẞ İI", "Word, WORD; <|Word. É.é!ü?x) y)., 1. 2.3 ²! a'S. n't?", "word. " * 50 + "İ.", "word " * 3000, "x" * 5000, "﻿a ​b",
        "word$$$ é%%% a_ a__b x<| y|> 1@# ÀÖ×÷ß- it's'. a'$ 's! 'S? ª. µ; ÿ) (a) [É] a\\ \"Ô\" ``a`` ~ ^a^ A-B- ½. ①! a\xad. \xa0b, c\xa0.", " ".join(f"w{i}" for i in range(4000)),
    ]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for step in (1 << 20, 700):
        monkeypatch.setattr(tokenids, "STEP_BYTES", step)
        got = tokenids.Encoder(DEFINITION).encode([t.encode() for t in texts])
        assert [x.tolist() for x in got] == want


def test_files_with_other_rules_are_refused():
    other = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    with pytest.raises(ValueError):
        tokenids.Encoder(other)


def test_shards_hold_all_documents_in_order(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(DEFINITION)
    docs = documents(spark)
    folder = tokenids.write_shards(docs, DEFINITION, end=2, shard_tokens=500)
    files = spark.read.parquet(folder)
    assert files.count() > 8 and files.agg(F.min("n_tokens")).first()[0] > 0 and len(files.inputFiles()) == files.count()
    rows = sorted(plain(tokenids.read_documents(spark, folder)), key=lambda r: r["start"])
    ids = [np.frombuffer(r["ids"], "<u4").tolist() for r in rows]
    want = [(r["doc_id"], [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in plain(docs)]
    assert sorted(zip([r["doc_id"] for r in rows], ids), key=str) == sorted(want, key=str)
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    at = 0
    for r, x in zip(rows, ids):
        assert (r["start"], r["n_tokens"]) == (at, len(x))
        at += len(x)
    flat = [(k, x.index, i) for k, x in zip(keys, ids) for i in range(len(x))]
    assert len(flat) == at
    common = ids[0][0]
    counted = {r["token"]: r["n"] for r in plain(tokenids.count_tokens(spark, folder, [2, common, 49_000]))}
    assert counted == {t: sum(x.count(t) for x in ids) for t in (2, common, 49_000)}
    found = sorted((r["start"], r["doc_id"], r["offset"]) for r in plain(tokenids.find_token(spark, folder, common).filter("doc_id is not null")))
    assert found == [(r["start"], r["doc_id"], i) for r, x in zip(rows, ids) for i, t in enumerate(x) if t == common and r["doc_id"] is not None]


def test_no_documents_no_ids(spark):
    folder = tokenids.write_shards(empty(spark), DEFINITION, end=2)
    assert tokenids.read_documents(spark, folder).count() == 0
    assert plain(tokenids.count_tokens(spark, folder, [2])) == [{"token": 2, "n": 0}]
    assert tokenids.find_token(spark, folder, 2).count() == 0


def test_token_query(spark):
    rows = plain(catalog.op11_tokenids(spark, SF).orderBy("doc_id"))
    docs = plain(spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id"))
    from tokenizers import Tokenizer

    whole, at = Tokenizer.from_str(DEFINITION), 0
    for row, doc in zip(rows, docs, strict=True):
        ids = np.array([*whole.encode(doc["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        assert row == {"doc_id": doc["doc_id"], "start": at, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}
        at += len(ids)


# -- conversations -----------------------------------------------------------------------------


def cheapest(turns):
    """(cost, audit, lines) by comparing all ways as text, last row first."""
    follow = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def go(i, state, inserted):
        ways = []
        if i == len(turns) and state in (0, 3):
            ways.append((0, "", ()))
        if inserted < 3:
            for letter, after in follow[state].items():
                if letter != "s":
                    cost, audit, lines = go(i, after, inserted + 1)
                    ways.append((cost + 3, "I" + audit, (f"{names[letter]}:", *lines)))
        if i < len(turns):
            role, text, fault = turns[i]
            cost, audit, lines = go(i + 1, state, 0)
            ways.append((cost + 4, "D" + audit, lines))
            if fault in (None, "truncated"):
                more = 3 * (fault is not None)
                for letter, after in follow[state].items():
                    cost, audit, lines = go(i + 1, after, 0)
                    if role[:1] == letter:
                        ways.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                    if letter in names:
                        ways.append((cost + more + 3, "R" + audit, (f"{names[letter]}:{text}", *lines)))
        return min(ways, default=(10**9, "", ()))

    return go(0, 0, 0)


def expected(rows):
    """What a repair says about rows (conv, turn, role, text), by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv), key=lambda r: (r[0] is not None, r[0] or 0))
        seen, turns = set(), []
        for _, role, text in own:
            visible = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else None if visible[-1] in ".!?" else "truncated"
            seen.add((role, text))
            turns.append((role, text, fault))
        dated = [t for t, *_ in own if t is not None]
        pairs = zip(turns, turns[1:])
        cost, audit, lines = cheapest(tuple(turns))
        out[conv] = (
            max(dated) - min(dated) + 1 - len(set(dated)) if dated else 0,
            *[sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")],
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs),
            cost, audit, lines,
        )
    return out


def repaired(spark, rows, **clash):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit(v) for c, v in clash.items()})
    fixed = conversations.repair(df)
    lines, sums = {}, {}
    for r in sorted(plain(fixed.repaired), key=lambda r: r["place"]):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in plain(conversations.digests(fixed.repaired)):
        sums[r["conv_id"]] = r["sha256"]
    assert sums == {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in lines.items()}
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return {r["conv_id"]: (*[r[n] for n in names], tuple(lines.get(r["conv_id"], ()))) for r in plain(fixed.audits)}


def some_rows(rng, n, conv):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "System", "u"]
    texts = ["Yes.", "No!", "Why?", "so", " ", "", "and. \n", "x"]
    turn, out = rng.randrange(-3, 4), []
    for _ in range(n):
        out.append((conv, turn, rng.choice(roles), f"{rng.choice(texts)}" if rng.random() < 0.4 else f"{rng.random()}{rng.choice('.!x')}"))
        turn += rng.choice([1, 1, 1, 2, 5])
    return out


def test_repair_against_all_ways(spark, monkeypatch):
    rng = random.Random(7)
    rows = [r for c in range(120) for r in some_rows(rng, rng.randrange(1, 9), c)]
    rows += some_rows(rng, 60, 500)  # lies in several ranges
    rows += [(501, i, "user", f"{i}.") for i in range(40)] + [(502, i, ("assistant", "user")[i % 2], f"{i}.") for i in range(41)]
    rows += [(503, 3, None, None), (504, None, "user", "a."), (504, 5, "assistant", "b."), (None, 1, "user", "c"), (None, 2, "tool", "d.")]
    rows += [(505, 1, "user", "same."), (505, 1, "user", "same."), (505, -(2**62), "assistant", "x" * 70_000 + ".")]
    rng.shuffle(rows)
    want = expected(rows)
    assert repaired(spark, rows) == want
    monkeypatch.setattr(conversations, "RANGE_BYTES", 400)
    monkeypatch.setattr(conversations, "CHUNK_BYTES", 50)
    assert repaired(spark, rows, conv=1, at=2, symbol=3, part="x", tie="y") == want


def test_a_row_repeated_very_often_in_one_conversation(spark):
    rows = [(1, None, "user", "again.")] * 3000 + [(1, None, "assistant", "z.")]
    got = repaired(spark, rows)[1]
    assert got[2] == 2999 and got[5] == 4 * 2999 and sorted(got[6]) == sorted("D" * 2999 + "KK") or got[5] == 4 * 2999 + 6


def test_binary_powers_equal_single_steps():
    moves = conversations.Transitions()
    rng = random.Random(3)
    for n in (1, 2, 7, 64, 1000, 12_345):
        symbol, after = rng.randrange(16), conversations._END
        one = after
        for _ in range(n):
            one = moves.before(symbol, 1, one)
        assert moves.before(symbol, n, after) == one
    cost, edits, roles = moves.solve(bytes([1] * 4000 + [2, 1] * 50))
    assert len(edits) == 4100 and cost == sum({"D": 4, "K": 0, "R": 3, "I": 3}[c] for e in edits for c in e)


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    fixed = conversations.repair(none)
    assert fixed.audits.count() == 0 and fixed.repaired.count() == 0 and conversations.digests(fixed.repaired).count() == 0


def test_damage(spark):
    key = lambda c, t: zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
    rows = [(c, t, "assistant", "A. b? c!") for c in [*range(40), None] for t in [*range(6), None]]
    out = {}
    for r in plain(conversations.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))):
        out.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"]))
    kept = ("assistant", "A. b? c!")
    kinds = {0: None, 1: [("assistant", "")], 2: [("assistant", "A b c")], 3: [kept, kept], 4: [("user", kept[1])]}
    assert {(c, t): out.get((c, t)) for c, t, *_ in rows} == {(c, t): kinds.get(key(c, t), [kept]) for c, t, *_ in rows}


# -- spelling ----------------------------------------------------------------------------------


def one_error(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(counts, ratio=5):
    form, near = {}, {}
    for w, n in counts.items():
        near[w] = sorted(((-m, x) for x, m in counts.items() if one_error(w, x)))
        form[w] = near[w][0][1] if near[w] and -near[w][0][0] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), None if form[w] is None else counts[form[w]])
    return out


@pytest.mark.parametrize("tile", [2, 7, 4096])
def test_variants(spark, tile):
    rng = random.Random(11)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))) for _ in range(150)}
    words |= {"aaaaaaa" + c for c in "bcdefghijklmnopq"} | {"aaaaaaa", "aaaaaaaa", "x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499, "日本語の単語", "日本語の単"}
    counts = {w: 5 ** rng.randrange(1, 6) + rng.randrange(3) for w in words}
    counts |= {"chainaa": 5, "chainab": 25, "chainbb": 125, "chainbbb": 625, "tieaaa": 5, "tieaab": 50, "tieaac": 50}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in plain(spelling.variants(df, tile=tile))}
    assert got == by_hand(counts)
    assert got["chainaa"][1] == "chainbbb" and got["tieaaa"][0] == "tieaab"


def test_many_roots_are_not_broadcast_on_a_guessed_size(spark, monkeypatch):
    plans, staged = [], spelling.stage

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, label)

    monkeypatch.setattr(common, "small", lambda facts: False)  # as beyond BROADCAST_ROWS
    monkeypatch.setattr(spelling, "stage", seen)
    words = "abcdefghij"
    counts = {f"common{a}": 1000 for a in words} | {f"common{a}{b}": 10 for a in words for b in words} | {"commnaa": 1}
    df = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 4 and not any("Broadcast" in p for p in plans)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in plain(df)}
    assert got == by_hand(counts) and got["commnaa"][1] == "commona"


def test_copies_of_facts_are_not_broadcast_on_a_guessed_size(spark):
    facts = spark.range(common.BROADCAST_ROWS + 1).selectExpr("if(id = 0, null, id) as k", "id as fact")
    rows = spark.createDataFrame([(None, "n"), (7, "a"), (7, "b"), (-1, "c")], "k long, word string")
    joined = common.join_facts(rows, facts, "k", F.col("word"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    got = {(r["k"], r["word"], r["fact"]) for r in plain(joined)}
    assert got == {(None, "n", 0), (7, "a", 7), (7, "b", 7), (-1, "c", None)}


def test_words_of_odd_texts(spark):
    rows = plain(spelling.misspelt(documents(spark)))
    want = []
    import re

    for r in plain(documents(spark)):
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            want.append(run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run)
    assert sorted(r["word"] for r in rows) == sorted(want)
    counted = {r["word"]: r["n"] for r in plain(spelling.vocabulary(spelling.misspelt(documents(spark)), 2, 3))}
    assert counted == {w: n for w in set(want) if len(w) >= 2 and (n := want.count(w)) >= 3}


def test_no_words(spark):
    none = spelling.vocabulary(spelling.misspelt(empty(spark)))
    assert spelling.variants(none).count() == 0


@pytest.mark.parametrize("name", ["op12_conversations", "op13_spelling"])
def test_queries_equal_sql(spark, name):
    assert differences(catalog.QUERIES[name](spark, SF), connect(SF), catalog.ORACLE[name]) is None
