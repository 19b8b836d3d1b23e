import hashlib
import os
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import corpus_pipeline
from llm.rows import documents, plain

from pyspark.sql import functions as F

from txnrisk.llm import catalog
from txnrisk.session import stage

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_duplicates", "decontamination", "source_mix"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r for r in plain(docs)}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = stage(apply(spark, docs, SF), name)
        now = {r["doc_id"]: r for r in plain(docs)}
        assert docs.columns == columns and set(now) <= set(before)
        if name == "language_id":
            assert set(before) - set(now) == {i for i, r in before.items() if not any(c.isalpha() for c in r["text"] or "")}
        if name == "line_dedup":
            assert set(now) == set(before) and all(r["n_chars"] == len(r["text"]) for r in now.values())
        before = now
    mixed = plain(corpus_pipeline.STAGES[-1][1](spark, docs, SF))
    assert {r["doc_id"] for r in mixed} <= set(before)


def test_stages_on_odd_rows(spark):
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SF), name)
        assert docs.count() > 0


def test_languages_are_learned_from_every_labelled_row(spark):
    """One language's labelled rows all have remainder 1, and one's all lack an id."""
    left_out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    others = [i for i in range(60) if i not in left_out]
    texts = {"en": "the cat and the dog went there with that", "el": "η γάτα και ο σκύλος πήγαν εκεί", "ru": "кошка и собака пошли туда вместе"}
    rows = [(i, texts["en"], "en") for i in others] + [(i, texts["el"], "el") for i in left_out] + [(None, texts["ru"], "ru")] * 5
    docs = spark.createDataFrame([(i, t, lang, "a", len(t)) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = plain(corpus_pipeline.language_id(spark, docs, SF))
    assert len(found) == len(rows) and all(texts[r["lang"]] == r["text"] for r in found)


def test_every_operator_has_its_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES)
    assert numbers == list(range(1, 14))


# -- the whole pipeline in plain Python ----------------------------------------------------------


def grams(text):
    """Counts of n-grams of 1 to 3 characters; a mark stands at the ends of words, never inside."""
    out = Counter()
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    for word in words:
        out.update((c,) for c in word)
    line = [1] + [x for word in words for x in (*word, 1)] if words else []
    for n in (2, 3):
        out.update(g for i in range(len(line) - n + 1) if 1 not in (g := tuple(line[i : i + n]))[1:-1])
    return out


def profile(counts):
    code = lambda g: (len(g), [x if x == 1 else ord(x) for x in g])
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:300]]


def languages(docs):
    counts = defaultdict(Counter)
    for d in docs:
        if d["lang"] is not None and d["text"]:
            counts[d["lang"]].update(grams(d["text"]))
    known = {lang: {g: i for i, g in enumerate(profile(c))} for lang, c in counts.items()}
    for d in docs:
        own = profile(grams(d["text"] or ""))
        if own:
            far = {lang: sum(abs(ranks[g] - i) if g in ranks else 300 for i, g in enumerate(own)) for lang, ranks in known.items()}
            yield d | {"lang": min(far, key=lambda x: (far[x], x))}


def without_common_lines(docs):
    pages, hosts = Counter(), Counter(d["source"] for d in docs)
    for d in docs:
        pages.update({(d["source"], x.strip(" \t\r")) for x in (d["text"] or "").split("\n")})
    bad = {k for k, n in pages.items() if k[1] and n >= 3 and n > 0.1 * hosts[k[0]]}
    for d in docs:
        if d["text"] is not None:
            text = "\n".join(x for x in d["text"].split("\n") if (d["source"], x.strip(" \t\r")) not in bad)
            d = d | {"text": text, "n_chars": len(text)}
        yield d


def shingles(text, n=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def without_copies(docs):
    sets = {d["doc_id"]: shingles(d["text"]) for d in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return [d for d in docs if root(d["doc_id"]) == d["doc_id"]]


def without_items(docs, items):
    for d in docs:
        if not any(own and len(own & shingles(d["text"], len(next(iter(own))))) >= 0.8 * len(own) - 1e-9 for own in items):
            yield d


def mixed(docs):
    size = {d["doc_id"]: len((d["text"] or "").split()) for d in docs}
    held = Counter()
    for d in docs:
        held[d["source"]] += size[d["doc_id"]]
    order = sorted(held, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, budget = {}, set(held), 1.5 * sum(held.values())
    while open_:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * held[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2.0 * held[s] for s in full}
        open_ -= full
    for d in docs:
        rate = min(target[d["source"]] / held[d["source"]], 2.0) if held[d["source"]] else 0.0
        draw = int(hashlib.md5(f"17:{d['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        for copy in range(1, int(rate) + (draw < rate - int(rate)) + 1):
            yield d | {"copy": copy}


def test_run_equals_plain_python(spark):
    docs = plain(spark.read.parquet(f"{SF}/documents.parquet"))
    items = [shingles(r["text"]) for r in plain(spark.read.parquet(f"{SF}/benchmark.parquet"))]
    kept = without_copies(list(without_common_lines(list(languages(docs)))))
    want = list(mixed(list(without_items(kept, items))))
    assert 0 < len(kept) < len(docs)
    got = plain(corpus_pipeline.run(spark, SF))
    order = lambda r: (r["doc_id"], r["copy"])
    assert sorted(got, key=order) == sorted(want, key=order)


def test_columns_of_any_name_pass_through(spark):
    names = ["copy", "size", "rate", "copies", "target", "source_size", "_n", "_here", "_kept", "_bad", "_host", "_lang", "_score", "score", "n_lines", "a.b"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    columns = docs.columns
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SF), name)
        assert docs.columns[: len(columns)] == columns
        assert all(r[n] == f"{n}{r['doc_id']}" for r in plain(docs) for n in names)
    assert docs.columns[len(columns) :] == ["copy_"]


def test_tasks_do_not_need_the_package(tmp_path):
    """Every query in a session whose executors can't import the package."""
    repo = Path(__file__).resolve().parents[2]
    script = tmp_path / "elsewhere.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {str(repo)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = (SparkSession.builder.master('local[8]').config('spark.ui.enabled', 'false')\n"
        "         .config('spark.sql.shuffle.partitions', '4').config('spark.driver.memory', '4g')\n"
        f"         .config('spark.checkpoint.dir', {str(tmp_path / 'shared')!r}).getOrCreate())\n"
        "import __spark_entry__ as contract\n"
        "from txnrisk.llm import catalog\n"
        "for name in [*catalog.QUERIES, 'pipeline']:\n"
        f"    print(name, contract.queries()[name](spark, {SF!r}).count() > 0, flush=True)\n"
    )
    ours = ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")
    env = {k: v for k, v in os.environ.items() if k not in ours}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    said = [x.split() for x in done.stdout.splitlines()]
    assert said == [[name, "True"] for name in [*catalog.QUERIES, "pipeline"]], done.stdout + done.stderr[-2000:]
