"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) with trees grown as Spark groups.

Training needs only 256 rows per tree, picked by a hash of tree and row id. Trees are grown one per
group of at most 256 rows, and each node draws its feature and its split from a hash of its own. So
the same data gives the same model whatever its partitioning, and any engine that has MD5 can grow
it again. The model is a small table of nodes; scoring ships it to the tasks as arrays.
"""

from __future__ import annotations

import math
from hashlib import md5
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.config import RiskConfig
from txnrisk.schemas import MODEL
from txnrisk.session import stage


def average_path(n: np.ndarray | int) -> np.ndarray:
    """Expected depth of an unsuccessful search among n points: the paper's c(n)."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    value = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


#: Draws of rows are numbers below this prime, the largest of 48 bits.
DRAWS = 2**48 - 59


def _row_hashes(row_id: str, seed: int) -> list[Column]:
    """Two numbers of 48 bits from the digest of seed and row id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")).cast("binary"))
    return [F.conv(F.substr(digest, F.lit(at), F.lit(12)), 16, 10).cast("bigint") for at in (1, 13)]


def row_draw(first: Column, second: Column, tree_id: Column) -> Column:
    """A row's draw in a tree: double hashing, so that a row is digested once for all trees."""
    return (first + tree_id.cast("bigint") * second) % F.lit(DRAWS)


def tree_samples(df: DataFrame, row_id: str, n_rows: int, cfg: RiskConfig) -> DataFrame:
    """Rows with a ``tree_id``; each tree gets the ``min(max_samples, n_rows)`` rows of lowest draw.

    Every tree draws from all rows. A cut on the draw leaves each row the trees that may take it, before
    the row is repeated for them, so what is written, ranked and shuffled is bounded by the settings; the
    cut is widened until it lets enough through.
    """
    size = min(cfg.max_samples, n_rows)
    trees = F.sequence(F.lit(0), F.lit(cfg.n_trees - 1))
    first, second = _row_hashes(row_id, cfg.seed)
    # Bound to a lambda's variable, the hashes are worked out once per row.
    hashes = F.array(F.struct(first.alias("first"), second.alias("second")))
    share = (size + 6.0 * math.sqrt(size)) / max(n_rows, 1)
    while True:
        cut = F.lit(min(int(share * DRAWS), DRAWS))
        taking = F.transform(hashes, lambda h: F.filter(trees, lambda t: row_draw(h["first"], h["second"], t) <= cut))
        thinned = stage(df.withColumn("tree_id", F.explode(taking[0])), "forest-samples")
        held = thinned.groupBy("tree_id").count().where(F.col("count") >= size)
        if share >= 1.0 or held.count() == cfg.n_trees:
            break
        share *= 2.0
    order = Window.partitionBy("tree_id").orderBy(row_draw(first, second, F.col("tree_id")), row_id)
    return thinned.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size).drop("_rank")


def grower(features: tuple[str, ...], size: int, seed: int):
    """The function that grows a tree on its rows. As a local function it reaches the tasks by value."""
    height = max(1, math.ceil(math.log2(max(size, 2))))
    columns = MODEL.fieldNames()

    def draw(tree_id: int, node: int) -> tuple[int, float]:
        """A node's two draws: a number of 32 bits for its feature and one in [0, 1) for its split."""
        digest = md5(f"{seed}:{tree_id}:{node}".encode()).hexdigest()
        return int(digest[:8], 16), int(digest[8:20], 16) / 2**48

    def grow(tree: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(tree["tree_id"].iloc[0])
        nodes = []
        open_nodes = [(1, 0, tree[list(features)].to_numpy(dtype=float))]
        while open_nodes:
            node, depth, held = open_nodes.pop()
            low, high = held.min(axis=0), held.max(axis=0)
            splittable = np.flatnonzero(low < high)
            if depth >= height or len(splittable) == 0:
                nodes.append((tree_id, node, None, None, None, None, len(held), depth, size))
                continue
            pick, part = draw(tree_id, node)
            f = splittable[pick % len(splittable)]
            at = low[f] + part * (high[f] - low[f])
            if at >= high[f]:  # by rounding, where the two are next to each other
                at = low[f]
            goes_left = held[:, f] <= at
            nodes.append((tree_id, node, features[f], at, 2 * node, 2 * node + 1, len(held), depth, size))
            open_nodes += [(2 * node + 1, depth + 1, held[~goes_left]), (2 * node, depth + 1, held[goes_left])]
        out = pd.DataFrame(nodes, columns=columns)
        return out.astype({"split": "float64", "left": "Int32", "right": "Int32"})

    return grow


def train_forest(df: DataFrame, row_id: str, features: tuple[str, ...], n_rows: int, cfg: RiskConfig) -> DataFrame:
    """The model as a node table. Node 1 is the root; the children of node i are 2i and 2i + 1."""
    samples = tree_samples(df.select(row_id, *features), row_id, n_rows, cfg)
    grow = grower(features, min(cfg.max_samples, n_rows), cfg.seed)
    return samples.groupBy("tree_id").applyInPandas(grow, schema=MODEL)


class Forest:
    """A trained model as arrays over complete binary trees: one row per tree, one column per node.

    Below a leaf everything goes left, and the leftmost descendant carries the leaf's path length.
    So all rows take the same number of steps, without a test for leaves.
    """

    def __init__(self, nodes: pd.DataFrame, features: tuple[str, ...]):
        tree_of = {t: i for i, t in enumerate(sorted(nodes["tree_id"].unique()))}
        row, node = nodes["tree_id"].map(tree_of).to_numpy(), nodes["node_id"].to_numpy()
        height = int(nodes["depth"].max())
        shape = (len(tree_of), 2 ** (height + 1))
        position = {name: i for i, name in enumerate(features)}

        feature = np.zeros(shape, dtype=np.int64)
        feature[row, node] = nodes["feature"].map(position).fillna(0).astype(int)
        split = np.full(shape, np.inf)
        split[row, node] = nodes["split"].fillna(np.inf)
        path = np.zeros(shape)
        path[row, node] = nodes["depth"] + average_path(nodes["size"].to_numpy())
        for parent in range(1, 2**height):
            ends = np.isinf(split[:, parent])
            path[ends, 2 * parent] = path[ends, parent]
        scale = float(average_path(int(nodes["sample_size"].iloc[0])))
        self.arrays = {"height": height, "feature": feature, "split": split, "path": path, "scale": scale}

    def score(self, points: np.ndarray) -> np.ndarray:
        return scorer()(self.arrays, points)


def scorer():
    """The scoring function. As a local function it reaches the tasks by value, so that executors
    need numpy and pandas but not this package; the model goes along as plain arrays."""

    def score(model: dict, points: np.ndarray) -> np.ndarray:
        """-2^(-E[path] / c(sample size)), in [-1, 0); lower = more anomalous."""
        if model["scale"] <= 0:
            return np.full(len(points), -1.0)
        total = np.zeros(len(points))
        values = np.ascontiguousarray(points).ravel()
        first = np.arange(len(points)) * points.shape[1]
        for feature, split, path in zip(model["feature"], model["split"], model["path"]):
            at = np.ones(len(points), dtype=np.int64)
            for _ in range(model["height"]):
                at = 2 * at + (values.take(first + feature.take(at)) > split.take(at))
            total += path.take(at)
        return -np.exp2(-total / len(model["feature"]) / model["scale"])

    return score


def load_forest(nodes: DataFrame, features: tuple[str, ...], cfg: RiskConfig) -> Forest:
    """Bring a node table to the driver; its size is bounded by the settings and checked."""
    depth = math.ceil(math.log2(max(cfg.max_samples, 2)))
    most = cfg.n_trees * (2 ** (depth + 1) - 1)
    held = nodes.limit(most + 1).toPandas()
    if not 0 < len(held) <= most:
        raise ValueError(f"a model has 1 to {most} nodes, this table has {len(held)} or more")
    return Forest(held, features)


def anomaly_score(spark, forest: Forest, features: tuple[str, ...]) -> Column:
    """Score column for rows that carry the feature columns, computed in Arrow batches."""
    shipped = spark.sparkContext.broadcast(forest.arrays)
    score_points = scorer()

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = shipped.value
        for batch in batches:
            points = np.column_stack([c.to_numpy(dtype=float) for c in batch])
            yield pd.Series(score_points(model, points))

    return score(*[F.col(c).cast("double") for c in features])
