"""Feature projection, frozen category vocabularies, folds and regression metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.scalars import storage_label
from bazaarlens.functions.text import UNKNOWN_REGION
from bazaarlens.session import small_side
from bazaarlens.sources.catalog import with_model

CATEGORICAL = ("model", "model_tier", "storage", "condition", "region")
NUMERIC = ("storage_gb", "battery_health", "battery_known", "phone_age_months", "has_box", "has_receipt")
BASE = ("model", "storage_gb", "condition", "region", "battery_health", "battery_known", "phone_age_months", "has_box", "has_receipt")
OTHER = "__other__"


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def feature_frame(df: DataFrame, models: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 11 features of each row, and the columns in ``keep``."""
    require_columns(df, BASE)
    found = with_model(df, models)
    return found.select(
        *keep, "model", F.coalesce("tier", F.lit(OTHER)).alias("model_tier"), storage_label(F.col("storage_gb").cast("bigint")).alias("storage"), "condition", F.coalesce("region", F.lit(UNKNOWN_REGION)).alias("region"),
        *[F.col(c).cast("double").alias(c) for c in NUMERIC],
    )


def training_rows(df: DataFrame, target: str = "price", least: int = 30) -> DataFrame:
    """Rows complete in features and target with a positive target; raises under ``least`` rows."""
    require_columns(df, [*BASE, target])
    rows = df.dropna(subset=[*BASE, target]).where(F.col(target) > 0)
    if rows.limit(least).count() < least:
        raise ValueError(f"fewer than {least} usable rows")
    return rows


def frequent_values(df: DataFrame, column: str, least: int = 1) -> DataFrame:
    """Columns value, rows of values with at least ``least`` rows, in order of the value."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows")).where(F.col("rows") >= least).orderBy("value")


def most_frequent(df: DataFrame, column: str, unknown: str = UNKNOWN_REGION) -> str:
    """The most frequent named value, ties to the first in order; the unknown name if there is none."""
    top = df.where(F.col(column).isNotNull() & (F.col(column) != unknown)).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(1).collect()
    return top[0][0] if top else unknown


def fold_rare(df: DataFrame, column: str, vocabulary: DataFrame, other: str = OTHER) -> DataFrame:
    """``column`` with values outside the vocabulary folded into one; the input is left as it is."""
    known = small_side(vocabulary.select(F.col("value").alias("_known")))
    return df.join(known, df[column] == F.col("_known"), "left").select(*[F.coalesce("_known", F.lit(other)).alias(c) if c == column else F.col(c) for c in df.columns])


def fold_of(ident: Column, folds: int, seed: int = 42) -> Column:
    """Fold 0..folds-1 by a hash of the id, the same in any engine that has md5."""
    digest = F.substring(F.md5(F.concat_ws(":", ident.cast("string"), F.lit(str(seed)))), 1, 8)
    return (F.conv(digest, 16, 10).cast("bigint") % folds).cast("int")


def regression_metrics(truth: Column, guess: Column) -> list[Column]:
    """RMSE, MAE and MAPE in percent."""
    error = truth - guess
    return [F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), (F.avg(F.abs(error) / truth) * 100).alias("mape")]


def fold_metrics(scored: DataFrame, by: Sequence[str] = ("fold",)) -> DataFrame:
    """Metrics of each fold from columns y and y_hat."""
    return scored.groupBy(*by).agg(F.count("*").alias("n"), *regression_metrics(F.col("y"), F.col("y_hat")))


def metric_summary(by_fold: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation over folds, rounded half-even to four places."""
    aggs = [F.bround(f(m), 4).alias(f"{m}_{name}") for m in ("rmse", "mae", "mape") for name, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return by_fold.groupBy(*by).agg(*aggs)


def best_model(summary: DataFrame, metric: str = "mape_mean", ordinal: str = "ordinal") -> DataFrame:
    """The row of the least metric; the first configured wins ties."""
    return summary.orderBy(metric, ordinal).limit(1)
