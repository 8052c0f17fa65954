"""Price models on a log target: boosted trees, and a log-linear model with sign constraints.

The constrained model is monotone by construction. One distributed pass builds the normal equations
(their size is the square of the number of features, a bounded figure); the driver solves them
under the sign constraints exactly.
"""

from __future__ import annotations

import datetime as dt
import json
import platform
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from importlib import metadata
from itertools import chain, combinations

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.operators.features import CATEGORICAL, NUMERIC, fold_metrics, fold_of, frequent_values, metric_summary, most_frequent

#: Direction in which a feature may move the price.
DIRECTIONS = {"storage_gb": 1, "battery_health": 1, "phone_age_months": -1, "has_box": 1, "has_receipt": 1}
BUNDLE_VERSION = 2


@dataclass
class LogLinear:
    """Coefficients over one-hot categories and numbers; predicts the exponential."""

    vocabularies: dict[str, list[str]] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)
    directions: dict[str, int] = field(default_factory=lambda: dict(DIRECTIONS))
    name: str = "monotone_log_linear"
    #: Most values of one category; beyond that the fit raises, as the normal equations grow with their square.
    most_values: int = 5_000

    def codes(self, pdf: pd.DataFrame) -> dict[str, np.ndarray]:
        """Place of each row's value in each vocabulary, -1 for values outside it."""
        return {c: np.asarray(pd.Categorical(pdf[c], categories=self.vocabularies[c]).codes, dtype=np.int64) for c in CATEGORICAL if c in self.vocabularies}

    def numbers(self, pdf: pd.DataFrame) -> np.ndarray:
        return np.column_stack([pdf[c].to_numpy(float) / 100.0 for c in NUMERIC])

    def starts(self) -> dict[str, int]:
        """First weight of each vocabulary; weight 0 is the constant, the numbers come last."""
        found, at = {}, 1
        for c in CATEGORICAL:
            if c in self.vocabularies:
                found[c], at = at, at + len(self.vocabularies[c])
        return found

    def logs(self, pdf: pd.DataFrame) -> np.ndarray:
        """Predicted logarithms."""
        w = np.asarray(self.weights)
        total = w[0] + self.numbers(pdf) @ w[len(w) - len(NUMERIC) :]
        for c, code in self.codes(pdf).items():
            block = np.append(w[self.starts()[c] : self.starts()[c] + len(self.vocabularies[c])], 0.0)  # -1 is the last: no weight
            total += block[code]
        return total

    def equations(self, pdf: pd.DataFrame, y: np.ndarray) -> dict[tuple[int, int], float]:
        """Cells (i <= j) of the normal equations of some rows that are not zero; column ``width`` is the target.

        Indicators are counted by code, so the cost grows with the rows, not with the square of the vocabularies.
        """
        width = 1 + sum(map(len, self.vocabularies.values())) + len(NUMERIC)
        dense = np.column_stack([np.ones(len(pdf)), self.numbers(pdf), y])
        places = [0, *range(width - len(NUMERIC), width), width]
        cells = {(places[i], places[j]): float(v) for (i, j), v in np.ndenumerate(dense.T @ dense) if i <= j}
        codes, starts = self.codes(pdf), self.starts()
        for c, code in codes.items():
            known = code >= 0
            for place, column in zip(places, dense.T, strict=True):
                sums = np.bincount(code[known], weights=column[known], minlength=len(self.vocabularies[c]))
                cells.update({(min(starts[c] + k, place), max(starts[c] + k, place)): float(sums[k]) for k in np.flatnonzero(sums)})
            counts = np.bincount(code[known])
            cells.update({(starts[c] + k, starts[c] + k): float(counts[k]) for k in np.flatnonzero(counts)})
            for d, other in codes.items():
                if starts[d] > starts[c]:
                    both = known & (other >= 0)
                    pairs, n = np.unique(code[both] * len(self.vocabularies[d]) + other[both], return_counts=True)
                    cells.update({(starts[c] + int(q) // len(self.vocabularies[d]), starts[d] + int(q) % len(self.vocabularies[d])): float(k) for q, k in zip(pairs, n, strict=True)})
        return cells

    def fit(self, rows: DataFrame, target: str = "price", ridge: float = 1e-3, least: int = 10) -> LogLinear:
        # a model's tier and a storage's label say nothing beyond model and number, and would blur the constraints
        for c in ("model", "condition", "region"):
            found = frequent_values(rows, c, least).limit(self.most_values + 1).collect()
            if len(found) > self.most_values:
                raise ValueError(f"{c} has more than {self.most_values} values of {least} rows; raise most_values or least")
            self.vocabularies[c] = [r[0] for r in found]
        shared = rows.sparkSession.sparkContext.broadcast(self)
        width = 1 + sum(map(len, self.vocabularies.values())) + len(NUMERIC)

        def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: Counter = Counter()
            for pdf in batches:
                total.update(shared.value.equations(pdf, np.log(pdf[target].to_numpy(float))))
            yield pd.DataFrame([(int(i), int(j), v) for (i, j), v in total.items()], columns=["i", "j", "v"])

        # the cells that are not zero: at most the pairs of values that occur together
        cells = rows.select(*CATEGORICAL, *NUMERIC, target).mapInPandas(moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
        total = np.zeros((width + 1, width + 1))
        total[cells["i"], cells["j"]] = cells["v"]
        total[cells["j"], cells["i"]] = cells["v"]
        total = total[:width]
        signs = np.zeros(width)
        for k, c in enumerate(NUMERIC):
            signs[width - len(NUMERIC) + k] = self.directions.get(c, 0)
        self.weights = _constrained(total[:, :-1] + ridge * np.eye(width), total[:, -1], signs).tolist()
        return self

    def predict(self, rows: DataFrame, out: str = "y_hat") -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf(T.DoubleType())
        def run(features: pd.DataFrame) -> pd.Series:
            return pd.Series(np.exp(shared.value.logs(features)))

        return rows.withColumn(out, run(F.struct(*CATEGORICAL, *NUMERIC)))

    def importances(self) -> dict[str, float]:
        """Share of each feature in the summed absolute coefficients: of a category the spread of its values, of a number its coefficient for one step of its unit."""
        size, at = {}, 1
        for c in CATEGORICAL:
            if c in self.vocabularies:
                part = np.asarray([0.0, *self.weights[at : at + len(self.vocabularies[c])]])
                size[c], at = float(part.max() - part.min()), at + len(self.vocabularies[c])
        size |= {c: abs(w) for c, w in zip(NUMERIC, self.weights[at:], strict=True)}
        total = sum(size.values()) or 1.0
        return {c: v / total for c, v in size.items()}


def _constrained(a: np.ndarray, b: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Minimum of x'ax/2 - b'x with x >= 0 where the sign is 1 and x <= 0 where it is -1.

    The free entries are expressed by the few constrained ones, in one solution of their equations. Of
    the constrained ones some are zero in the minimum: every choice of them is tried, and of the
    solutions that keep the signs the least one is taken, so the result is exact.
    """
    bound, free = np.flatnonzero(signs), np.flatnonzero(signs == 0)
    cross = a[np.ix_(free, bound)]
    solved = np.linalg.solve(a[np.ix_(free, free)], np.column_stack([b[free], cross]))
    base, slope = solved[:, 0], solved[:, 1:]
    small, right = a[np.ix_(bound, bound)] - cross.T @ slope, b[bound] - cross.T @ base
    best, least = np.zeros(len(bound)), np.inf
    for zeros in chain.from_iterable(combinations(range(len(bound)), k) for k in range(len(bound) + 1)):
        x, rest = np.zeros(len(bound)), np.setdiff1d(np.arange(len(bound)), zeros)
        x[rest] = np.linalg.solve(small[np.ix_(rest, rest)], right[rest])
        value = x @ small @ x / 2 - right @ x
        if value < least and np.all(signs[bound] * x >= 0):
            best, least = x, value
    out = np.zeros(len(b))
    out[bound], out[free] = best, base - slope @ best
    return out


class BoostedTrees:
    """Gradient-boosted trees on indexed categories and numbers."""

    name = "boosted_trees"

    def __init__(self, iterations: int = 20, depth: int = 5, rate: float = 0.2, seed: int = 42) -> None:
        self.iterations, self.depth, self.rate, self.seed, self.model = iterations, depth, rate, seed, None

    def fit(self, rows: DataFrame, target: str = "price") -> BoostedTrees:
        indexed = [f"{c}_index" for c in CATEGORICAL]
        most = max(r[0] for r in rows.agg(F.greatest(*[F.count_distinct(c) for c in CATEGORICAL])).collect())
        stages = [
            StringIndexer(inputCols=list(CATEGORICAL), outputCols=indexed, handleInvalid="keep"), VectorAssembler(inputCols=[*indexed, *NUMERIC], outputCol="features"),
            GBTRegressor(labelCol="_log", featuresCol="features", predictionCol="_log_hat", maxIter=self.iterations, maxDepth=self.depth, stepSize=self.rate, maxBins=max(32, int(most) + 2), seed=self.seed),
        ]
        self.model = Pipeline(stages=stages).fit(rows.withColumn("_log", F.log(target)))
        return self

    def predict(self, rows: DataFrame, out: str = "y_hat") -> DataFrame:
        kept = [F.col(c) for c in rows.columns]
        return self.model.transform(rows).select(*kept, F.exp("_log_hat").alias(out))

    def importances(self) -> dict[str, float]:
        found = self.model.stages[-1].featureImportances
        return {c: float(found[i]) for i, c in enumerate([*CATEGORICAL, *NUMERIC])}


def cross_validate(make, rows: DataFrame, ident: str, folds: int = 5, target: str = "price", seed: int = 42) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    """(scores by fold, out-of-fold predictions with columns fold, y, y_hat); encoders are refitted in every fold."""
    marked = rows.withColumn("fold", fold_of(F.col(ident), folds, seed))
    parts = []
    for k in range(folds):
        fitted = make().fit(marked.where(F.col("fold") != k), target)
        parts.append(fitted.predict(marked.where(F.col("fold") == k)).select(ident, "fold", F.col(target).cast("double").alias("y"), "y_hat"))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    return fold_metrics(scored), scored


def select_and_refit(candidates: dict, rows: DataFrame, ident: str, folds: int = 5, target: str = "price", metric: str = "mape") -> dict:  # noqa: ANN001
    """Cross-validate every candidate, refit the best of the mean metric on all rows; the first configured wins ties.

    ``typical_error`` is over all out-of-fold rows, not the mean of folds.
    """
    if not candidates or folds < 2:
        raise ValueError("at least one candidate and two folds are needed")
    results = {}
    for name, make in candidates.items():
        by_fold, scored = cross_validate(make, rows, ident, folds, target)
        overall = scored.groupBy().agg(F.avg(F.abs(F.col("y") - F.col("y_hat")) / F.col("y") * 100)).first()[0]
        results[name] = {"summary": metric_summary(by_fold).first().asDict(), "typical_error": overall}
    best = min(results, key=lambda n: results[n]["summary"][f"{metric}_mean"])
    return {"best": best, "results": results, "model": candidates[best]().fit(rows, target), "typical_error": results[best]["typical_error"]}


def make_model(kind: str, **settings: object) -> LogLinear | BoostedTrees:
    """An unfitted model by its name; the trees carry no constraints, the linear one may only move in ``DIRECTIONS``."""
    kinds = {LogLinear.name: LogLinear, BoostedTrees.name: BoostedTrees}
    if kind not in kinds:
        raise ValueError(f"unknown model {kind!r}; one of {', '.join(kinds)}")
    return kinds[kind](**settings)


def training_statistics(rows: DataFrame, least: int = 10, most_regions: int = 10_000) -> dict:
    """What a valuation needs besides the model: battery medians of observed, not new devices by release year and over all, the default region, and the regions with ``least`` rows."""
    observed = rows.where((F.col("battery_known") == 1) & (F.col("condition") != "new") & F.col("battery_health").isNotNull())
    counted = observed.groupBy("release_year", "battery_health").agg(F.count("*").alias("n"))
    median = F.percentile("battery_health", 0.5, F.col("n"))
    by_year = {str(r[0]): r[1] for r in counted.where("release_year is not null").groupBy("release_year").agg(median).collect()}  # a row a year
    overall = counted.agg(median).first()[0]
    regions = [r[0] for r in frequent_values(rows, "region", least).limit(most_regions + 1).collect()]
    if len(regions) > most_regions:
        raise ValueError(f"more than {most_regions} regions of {least} rows; raise most_regions or least")
    return {"battery_by_year": by_year, "battery_median": 90.0 if overall is None else overall, "default_region": most_frequent(rows, "region"), "known_regions": regions, "n_train": rows.count()}


def versions() -> dict[str, str]:
    """Versions of what a bundle depends on."""
    return {"python": platform.python_version(), **{name: metadata.version(name) for name in ("pyspark", "numpy", "pandas")}}


def metrics_document(selection: dict, statistics: dict, metric: str = "mape", trained_at: str | None = None) -> dict:
    """The result of :func:`select_and_refit` as one document: scores of all candidates and the importances of the best, largest first."""
    importances = sorted(selection["model"].importances().items(), key=lambda kv: -kv[1])
    return {
        "best_model": selection["best"], "selected_by": metric, "n_train_samples": statistics.get("n_train"), "trained_at": trained_at or dt.datetime.now(dt.UTC).isoformat(timespec="seconds"),
        "typical_error_pct": round(selection["typical_error"], 3), "cross_validation": {name: r["summary"] for name, r in selection["results"].items()},
        "feature_importances": {name: round(value, 4) for name, value in importances}, "versions": versions(),
    }


def scores_table(selection: dict) -> str:
    """Mean and deviation of every candidate's scores as text, the best one marked."""
    lines = [f"{'model':<20} {'rmse':>20} {'mae':>20} {'mape, %':>16}"]
    for name, r in selection["results"].items():
        cells = [f"{r['summary'][m + '_mean']:,.{d}f} ± {r['summary'][m + '_std']:,.{d}f}" for m, d in (("rmse", 0), ("mae", 0), ("mape", 2))]
        lines.append(f"{name:<20} {cells[0]:>20} {cells[1]:>20} {cells[2]:>16}" + (" best" if name == selection["best"] else ""))
    return "\n".join(lines)


def save_bundle(spark: SparkSession, model: LogLinear | BoostedTrees, path: str, **statistics: object) -> None:
    """A fitted model with its training statistics and versions under ``path``, in any file system that Spark can write."""
    document = {"version": BUNDLE_VERSION, "kind": model.name, "statistics": statistics, "versions": versions()}
    if isinstance(model, LogLinear):
        document |= {"vocabularies": model.vocabularies, "weights": model.weights, "directions": model.directions}
    else:
        model.model.write().overwrite().save(f"{path.rstrip('/')}/trees")
    text = json.dumps(document, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/bundle")


def load_bundle(spark: SparkSession, path: str) -> tuple[LogLinear | BoostedTrees, dict]:
    """The model and its statistics; raises if nothing is there, or it is no bundle, or of another version."""
    try:
        lines = spark.read.text(f"{path.rstrip('/')}/bundle").limit(2).collect()
    except AnalysisException as e:
        raise FileNotFoundError(path) from e
    try:
        document = json.loads(lines[0][0]) if len(lines) == 1 else None
    except ValueError:
        document = None
    if not isinstance(document, dict) or document.get("kind") not in (LogLinear.name, BoostedTrees.name):
        raise ValueError(f"{path} is no model bundle")
    if document.get("version") != BUNDLE_VERSION:
        raise ValueError(f"bundle version {document.get('version')} is not {BUNDLE_VERSION}")
    if document["kind"] == LogLinear.name:
        return LogLinear(document["vocabularies"], document["weights"], document["directions"]), document["statistics"]
    trees = BoostedTrees()
    trees.model = PipelineModel.load(f"{path.rstrip('/')}/trees")
    return trees, document["statistics"]
