"""Isolation forest: trees on small hash-drawn samples, scores in Arrow batches, cut at the contamination share."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.session import cut_lineage

#: Fewest rows for which a forest is grown.
LEAST_ROWS = 50


def _mean_path(n: float) -> float:
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _grow(rows: np.ndarray, depth: int, rng: np.random.Generator, tree: list) -> int:
    """Append a subtree (feature, cut, left, right, path length beyond) and return its index."""
    at = len(tree)
    tree.append(None)
    spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) else np.array([], int)
    if depth <= 0 or len(rows) <= 1 or not len(spread):
        tree[at] = (-1, 0.0, 0, 0, _mean_path(len(rows)))
        return at
    f = int(rng.choice(spread))
    cut = float(rng.uniform(rows[:, f].min(), rows[:, f].max()))
    left = rows[:, f] < cut
    tree[at] = (f, cut, _grow(rows[left], depth - 1, rng, tree), _grow(rows[~left], depth - 1, rng, tree), 0.0)
    return at


def grow_forest(sample: np.ndarray, trees: int = 200, size: int = 256, seed: int = 42) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    size = min(size, len(sample))
    forest = []
    for _ in range(trees):
        tree: list = []
        _grow(sample[rng.choice(len(sample), size=size, replace=False)], math.ceil(math.log2(max(size, 2))), rng, tree)
        forest.append(np.array(tree))
    return forest


def _unrolled(tree: np.ndarray) -> tuple[np.ndarray, ...]:
    """A tree as arrays (feature, cut, left, right, path length, steps) in which a leaf leads to itself, so that all rows take the same number of steps."""
    leaf = tree[:, 0] < 0
    itself = np.arange(len(tree))
    left, right = np.where(leaf, itself, tree[:, 2]).astype(np.intp), np.where(leaf, itself, tree[:, 3]).astype(np.intp)
    depth = np.zeros(len(tree))
    for node in itself[~leaf]:  # parents stand before their children
        depth[left[node]] = depth[right[node]] = depth[node] + 1
    return np.where(leaf, 0, tree[:, 0]).astype(np.intp), np.where(leaf, np.inf, tree[:, 1]), left, right, depth + tree[:, 4], int(depth.max())


def score_rows(rows: np.ndarray, forest: list[np.ndarray], size: int) -> np.ndarray:
    """Anomaly score of each row, near 1 for lonely ones."""
    total, flat = np.zeros(len(rows)), np.ascontiguousarray(rows).ravel()
    first = np.arange(len(rows)) * rows.shape[1]
    for tree in forest:
        feature, cut, left, right, path, steps = _unrolled(tree)
        at = np.zeros(len(rows), np.intp)
        for _ in range(steps):
            at = np.where(flat[first + feature[at]] < cut[at], left[at], right[at])
        total += path[at]
    return 2.0 ** (-total / len(forest) / max(_mean_path(size), 1e-9))


def isolation_scores(df: DataFrame, features: Sequence[str], ident: str, trees: int = 200, size: int = 256, seed: int = 42) -> DataFrame:
    """``df`` with anomaly_score; null features count as 0; the trees are grown on ``trees * size`` rows drawn by hash (all rows if there are fewer), every row is scored."""
    rows = df.withColumns({f"_f{i}": F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for i, f in enumerate(features)})
    names = [f"_f{i}" for i in range(len(features))]
    n = df.count()
    if n < LEAST_ROWS:
        return df.withColumn("anomaly_score", F.lit(0.0))
    most = trees * size
    draw = rows.where(F.pmod(F.xxhash64(F.col(ident), F.lit(seed)), F.lit(1_000_000)) <= int(1e6 * min(1.0, 1.5 * most / n))).orderBy(F.xxhash64(F.col(ident), F.lit(seed))).limit(most)
    sample = np.array([tuple(r) for r in draw.select(*names).collect()], dtype=float)
    shared = df.sparkSession.sparkContext.broadcast(grow_forest(sample, trees, size, seed))

    @F.pandas_udf(T.DoubleType())
    def run(f: pd.DataFrame) -> pd.Series:
        return pd.Series(score_rows(f.to_numpy(dtype=float), shared.value, min(size, len(sample))))

    return rows.withColumn("anomaly_score", run(F.struct(*names))).drop(*names)


def isolation_outliers(df: DataFrame, features: Sequence[str], ident: str, contamination: float = 0.02, **settings: int) -> DataFrame:
    """``df`` with anomaly_score and is_outlier: about the contamination share of rows; none under 50 rows."""
    # read for the draw and the scores, and the scores for the cut and the result
    scored = cut_lineage(isolation_scores(cut_lineage(df), features, ident, **settings))
    if scored.limit(LEAST_ROWS).count() < LEAST_ROWS:
        return scored.withColumn("is_outlier", F.lit(False))
    cut = scored.agg(F.percentile_approx("anomaly_score", 1 - contamination, 100_000)).first()[0]
    return scored.withColumn("is_outlier", F.col("anomaly_score") > cut)
