"""Compare a Spark result with another engine's rows, as sorted columns of hashed values."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) + 0.0
    return value


def as_bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when names, row counts and values agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    ours = spark_df.collect()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    a, b = as_bag(spark_df.columns, ours), as_bag(names, theirs)
    if a != b:
        return f"only ours: {list((a - b).items())[:3]} only theirs: {list((b - a).items())[:3]}"
    kinds = [
        (n, sorted({type(r[i]).__name__ for r in ours if r[i] is not None}), sorted(
            {type(r[names.index(n)]).__name__ for r in theirs if r[names.index(n)] is not None}
        ))
        for i, n in enumerate(spark_df.columns)
    ]
    odd = [k for k in kinds if k[1] != k[2]]
    return f"types {odd}" if odd else None
