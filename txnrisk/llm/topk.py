"""Exact top-k by inner product with sequential reads of sorted lists (no random access).

Each component has a list of the vectors, sorted by its value. For a query the lists are read from
the end that its sign favours. After each round of reads every vector has a lower bound (unread
components at their list's worst value) and an upper bound (at the value the list has been read
to). Each round reads half of what is unread; vectors whose upper bound is below the k-th best lower
bound go. Reading stops when no vector outside the k best can still reach them, or at the lists' ends,
where ties are told apart; the scores of those left are what the lists bring of them. All of this runs
for blocks of queries against blocks of vectors, as products of matrices while most vectors are left and
by pairs of query and vector then.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm import common
from txnrisk.llm.common import by_value

#: Queries held against the vectors in one pass, and vectors per block of lists.
QUERY_BLOCK = 4096
LIST_BLOCK = 4096
#: Share of pairs left at which the bounds are kept by pairs, and pairs worked on at a time.
FEW = 0.03
PAIRS = 1 << 16
_LIMIT = 2**63 - 1


def as_integers(vectors: list, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) as doubles, and which vectors take part; shorter vectors end in zeros.

    Null vectors, and vectors with a null or a component that is not finite, take no part.
    """
    width = max((len(v) for v in vectors if v is not None), default=0)
    out = np.zeros((len(vectors), width))
    good = np.zeros(len(vectors), dtype=bool)
    for i, v in enumerate(vectors):
        if v is not None:
            x = np.array(v, dtype=np.float64)  # null components become NaN
            good[i] = np.isfinite(x).all()
            if good[i]:
                out[i, : len(x)] = np.floor(scale * x)
    good &= np.isfinite(out).all(axis=1)
    return out, good


def kind_for(a: np.ndarray, b: np.ndarray):
    """The number type in which all partial sums of products are exact; object: Python's integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


class Lists:
    """The sorted lists of a block of vectors, one list per component."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        order = np.argsort(vectors, axis=0, kind="stable")
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(len(vectors))[:, None], axis=0)
        self.sorted = np.take_along_axis(vectors, order, axis=0)

    def read(self, depth: int, of: np.ndarray | slice) -> tuple[np.ndarray, ...]:
        """What ``depth`` reads of each list tell of some vectors' components.

        Lists read from the largest value down give the least and the largest possible components; so do
        those read from the smallest value up.
        """
        x, place, n = self.vectors[of], self.place[of], len(self.vectors)
        top, bottom = place >= n - depth, place < depth
        return (
            np.where(top, x, self.sorted[0]), np.where(top, x, self.sorted[n - depth]),
            np.where(bottom, x, self.sorted[depth - 1]), np.where(bottom, x, self.sorted[-1]),
        )

    def bounds(self, up: np.ndarray, down: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible scores of all vectors.

        ``up`` are the queries' positive components, which read their lists from the largest value
        down; ``down`` the negative ones, which read from the smallest value up.
        """
        least, largest, small, great = self.read(depth, slice(None))
        return up @ least.T + down @ great.T, up @ largest.T + down @ small.T

    def bounds_of(self, up: np.ndarray, down: np.ndarray, row: np.ndarray, col: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for some pairs of a query's row and a vector."""
        low, high = np.empty(len(row), up.dtype), np.empty(len(row), up.dtype)
        for at in range(0, len(row), PAIRS):
            some = slice(at, at + PAIRS)
            least, largest, small, great = self.read(depth, col[some])
            a, b = up[row[some]], down[row[some]]
            low[some] = np.einsum("ij,ij->i", a, least) + np.einsum("ij,ij->i", b, great)
            high[some] = np.einsum("ij,ij->i", a, largest) + np.einsum("ij,ij->i", b, small)
        return low, high


def depths(n: int):
    """Half of the lists, then half of what is unread, up to their ends."""
    depth = 0
    while depth < n:
        depth += -(-(n - depth) // 2)
        yield depth


class Best:
    """The k best (score, id) of each query so far; ties to smaller ids."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.floor = np.full(len(ids), -np.inf)
        self.kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))  # query row, id, score

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take in a block of vectors."""
        q, v = self.queries, vectors
        width = max(q.shape[1], v.shape[1])
        q, v = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, v))
        kind = kind_for(q, v)
        if kind is not object:
            q, v = q.astype(kind), v.astype(kind)
        with np.errstate(all="ignore"):
            # Bounds of numbers too large for exact sums are off by rounding; infinite if they overflow.
            slack = 0 if kind is not object else np.abs(q) @ np.abs(v).max(axis=0) * (width + 4) * 2.0**-51
            row, col = self._survivors(ids, q, v, np.broadcast_to(slack, len(q)))
        score = np.empty(len(row), dtype=np.int64)
        for at in range(0, len(row), PAIRS):
            a, b = q[row[at : at + PAIRS]], v[col[at : at + PAIRS]]
            if kind is object:
                exact = (sum(int(x) * int(y) for x, y in zip(*pair)) for pair in zip(a, b))
                score[at : at + PAIRS] = [max(-_LIMIT - 1, min(_LIMIT, s)) for s in exact]
            else:
                score[at : at + PAIRS] = np.einsum("ij,ij->i", a, b)
        row, of, score = (np.concatenate(x) for x in zip(self.kept, (row, ids[col], score)))
        order = np.lexsort((of, -score.astype(object) if kind is object else -score, row))
        row, of, score = row[order], of[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.k
        self.kept = (row[keep], of[keep], score[keep])
        last = rank == self.k - 1
        self.floor[row[last]] = score[last]

    def _survivors(self, ids: np.ndarray, q: np.ndarray, v: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of queries and vectors that can still be among the k best; none with a query's own id."""
        lists, k = Lists(v), self.k
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        own = k + int(np.bincount(np.searchsorted(np.unique(ids), ids)).max(initial=0))
        floor, most = self.floor.copy(), float(_LIMIT)  # later blocks start from the scores already resolved
        row = col = None

        def least(low, slack):
            """Lower bounds that may be relied on; scores stay at the limits."""
            return np.clip(np.nan_to_num(low - slack, nan=-np.inf, posinf=most, neginf=-np.inf), -np.inf, most)

        def alive(high, slack, floor):
            return ~(np.maximum(high + slack, -most) < np.maximum(floor, -most))

        for depth in depths(len(v)):
            if row is None:
                low, high = lists.bounds(up, down, depth)
                if len(v) > own:
                    floor = np.maximum(floor, np.partition(least(low, slack[:, None]), -own, axis=1)[:, -own])
                left = alive(high, slack[:, None], floor[:, None])
                if depth < len(v) and np.count_nonzero(left) > FEW * left.size:
                    continue
                row, col = np.nonzero(left)
                other = self.ids[row] != ids[col]
                row, col = row[other], col[other]
            else:
                low, high = lists.bounds_of(up, down, row, col, depth)
                low = least(low, slack[row])
                order = np.lexsort((-low, row))
                kth = order[np.arange(len(row)) - np.searchsorted(row, row) == k - 1]
                floor[row[kth]] = np.maximum(floor[row[kth]], low[kth])
                left = alive(high, slack[row], floor[row])
                row, col = row[left], col[left]
            if np.bincount(row).max(initial=0) <= k:
                break
        return row, col


def query_blocks(queries: DataFrame):
    """The queries as integers, in blocks of bounded size; only one is on the driver at a time."""
    block: list = []
    for row in queries.toLocalIterator():
        block.append(row)
        if len(block) == QUERY_BLOCK:
            yield block
            block = []
    if block:
        yield block


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, key: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, key, score): the k rows of highest integer inner product for each query.

    Components are floor(scale * x). Ranks start at 1, ties go to the smaller id. A query's own row
    is no candidate, nor are rows that repeat its id; other repeated rows count each. Rows with a null id
    take no part, nor do vectors that are null or hold null or non-finite components. Shorter
    vectors end in zeros. Scores are exact; beyond 64 bits they stay at the limit. The vectors are
    read once per block of queries; only each task's k best per query are shuffled.
    """
    spark = vectors.sparkSession
    usable = vectors.filter(F.col(key).isNotNull() & F.col(column).isNotNull())
    usable = usable.select(F.col(key).cast("long").alias(key), column, F.coalesce(is_query, F.lit(False)).alias("_query"))
    names = ["query_id", key, "score"]
    schema = common.schema_of(f"query_id long, {key} long, score long")
    out = spark.createDataFrame([], schema)
    for block in query_blocks(usable.filter("_query").select(key, column)):
        numbers, good = as_integers([r[1] for r in block], scale)
        ids = np.array([r[0] for r in block], dtype=np.int64)[good]
        shipped = spark.sparkContext.broadcast((ids, numbers[good]))

        def search(batches, shipped=shipped):
            best = Best(*shipped.value, k)
            for batch in batches:
                for at in range(0, batch.num_rows, LIST_BLOCK):
                    part = batch.slice(at, LIST_BLOCK)
                    x, fine = as_integers(part.column(1).to_pylist(), scale)
                    own = np.array(part.column(0).to_pylist(), dtype=np.int64)[fine]
                    if len(own) and len(best.ids):
                        best.add(own, x[fine])
            row, of, score = best.kept
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(best.ids[row]), pa.array(of), pa.array(score)], names)

        out = out.unionByName(usable.select(key, column).mapInArrow(search, schema))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), key))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", key, "score")


by_value(__name__)
