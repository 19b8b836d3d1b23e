"""Small tables with what real ones hold: nulls, blanks, long texts, repeats and clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, kept string"


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, n: int = 60, seed: int = 1):
    rng = random.Random(seed)
    texts = [sentence(rng, rng.randrange(1, 90)) for _ in range(n)]
    rows = []
    for i, text in enumerate(texts):
        if i % 9 == 3:
            text = texts[i - 1]  # a copy
        elif i % 9 == 5:
            text = texts[i - 1] + " " + sentence(rng, 2)  # a near copy
        elif i % 9 == 7:
            text = sentence(rng, 5) + "\n" + texts[i - 3] + "\n" + sentence(rng, 5)  # a passage
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(text)))
    rows += [
        (n, None, "en", "a", None),
        (n + 1, "", "en", "b", 0),
        (n + 2, " \t\n ", None, None, 4),
        (n + 3, sentence(rng, 30_000, 5000), "en", "a", 1),
        (n + 4, "X" * 70_000, "en", "a", 70_000),
        (n + 5, "1234 !? 55", "de", "b", 10),
        (None, texts[0], "de", "b", 1),
        (None, "ein Text ohne Nummer", "de", "b", 1),
        (7, texts[7], "en", "a", 1),  # repeats a row's id and text
        (8, sentence(rng, 20), "en", "a", 1),  # repeats an id with another text
        (n + 6, "é ü ñ ß 日本 😀 " + texts[2].upper(), "fr", "é", 1),
    ]
    return spark.createDataFrame([(*r, 0.5, 99, "x") for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]
