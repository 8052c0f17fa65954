"""Asked prices against estimated ones, for a table of queries at once.

A query is a row with model, storage_gb, condition, asking_price, and where known battery_health,
region, has_box and has_receipt. Each row is checked by ordered rules, completed from the training
statistics, estimated by any predictor (features in, ``y_hat`` out) and compared.

Defined results: a row that breaks a rule keeps its columns, has the name of the first rule it breaks
in ``error`` and null results; a missing battery is that of new devices or the median of the model's
year, else of all; a missing or blank region is the default one; missing extras count as absent.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import scalars as S
from bazaarlens.functions import text as X
from bazaarlens.operators.features import feature_frame
from bazaarlens.operators.rules import first_reason
from bazaarlens.session import unused_name
from bazaarlens.sources.catalog import offered, with_model

# ---- Fixed values: conditions that can be valued, the battery of new devices.
CONDITIONS, NEW_BATTERY = ("new", "used", "refurbished"), 100
REQUIRED = ("model", "storage_gb", "condition", "asking_price")
OPTIONAL = {"battery_health": "int", "region": "string", "has_box": "boolean", "has_receipt": "boolean"}
RESULTS = ("error", "region_used", "battery_assumed", "fair_price", "fair_low", "fair_high", "delta_pct", "verdict")

Predictor = Callable[[DataFrame], DataFrame]


def query_error() -> Column:
    """Name of the first rule that a query breaks, over columns of the query and the catalogue."""
    c = F.col
    return first_reason([
        ("unknown_model", c("release_date").isNull()), ("storage_not_offered", ~F.coalesce(offered(c("storage_gb").cast("int")), F.lit(False))), ("unsupported_condition", ~F.coalesce(c("condition").isin(*CONDITIONS), F.lit(False))),
        ("battery_out_of_range", ~c("battery_health").between(1, 100)), ("price_not_positive", ~F.coalesce(c("asking_price") > 0, F.lit(False))),
    ])


def assumed_battery(statistics: dict) -> Column:
    """Battery of a device whose health is not known: new ones by definition, others by the median of their year, half-even."""
    entries = [F.lit(x) for year, value in statistics["battery_by_year"].items() for x in (int(year), float(value))]
    by_year = F.create_map(*entries)[F.year("release_date")] if entries else F.lit(None).cast("double")
    usual = F.bround(F.coalesce(by_year, F.lit(float(statistics["battery_median"]))), 0)
    return F.when(F.col("condition") == "new", float(NEW_BATTERY)).otherwise(usual)


def evaluate(queries: DataFrame, models: DataFrame, predict: Predictor, statistics: dict, today: dt.date | None = None, threshold: float = 10.0) -> DataFrame:
    """``queries`` with the columns ``RESULTS``; prices within ``threshold`` percent of the fair one are fair."""
    if threshold <= 0:
        raise ValueError("threshold must be positive")
    missing = [c for c in REQUIRED if c not in queries.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    ident = unused_name(queries, "_query")
    rows = queries.select("*", F.struct("*").alias(ident)).select(ident, *REQUIRED, *[(F.col(c) if c in queries.columns else F.lit(None)).cast(t).alias(c) for c, t in OPTIONAL.items()])
    rows = with_model(rows, models).withColumns({"error": query_error(), "battery_assumed": F.when(F.col("battery_health").isNull(), assumed_battery(statistics))})
    region = F.when(F.col("region").rlike(r"(?U)\S"), X.region(F.col("region"))).otherwise(statistics["default_region"])
    day = F.lit(today).cast("date") if today else F.current_date()
    ready = rows.where("error is null").select(
        ident, "error", "battery_assumed", "asking_price", "model", "storage_gb", "condition", region.alias("region"), F.coalesce(F.col("battery_health").cast("double"), "battery_assumed").alias("battery_health"), F.col("battery_health").isNotNull().cast("int").alias("battery_known"),
        S.whole_months(F.col("release_date"), day).alias("phone_age_months"), F.coalesce("has_box", F.lit(False)).cast("int").alias("has_box"), F.coalesce("has_receipt", F.lit(False)).cast("int").alias("has_receipt"),
    )
    fair = predict(feature_frame(ready, models, [ident, "error", "battery_assumed", "asking_price"])).withColumnRenamed("y_hat", "fair_price")
    band = threshold / 100.0
    delta = S.percent_delta(F.col("asking_price"), F.col("fair_price"))
    valued = fair.select(ident, "error", F.col("region").alias("region_used"), "battery_assumed", "fair_price", (F.col("fair_price") * (1 - band)).alias("fair_low"), (F.col("fair_price") * (1 + band)).alias("fair_high"), delta.alias("delta_pct"), S.classify_delta(delta, threshold).alias("verdict"))
    refused = rows.where("error is not null").select(ident, "error", *[F.lit(None).cast(valued.schema[c].dataType).alias(c) for c in RESULTS[1:]])
    return valued.unionByName(refused).select(f"{ident}.*", *RESULTS)


def as_json(valued: DataFrame, typical_error: float | None = None) -> DataFrame:
    """One JSON text for each valuation, money without decimals, shares with two."""
    c = F.col
    extra = [F.lit(round(typical_error, 2)).alias("typical_error_pct")] if typical_error is not None else []
    return valued.select(F.to_json(F.struct(
        "model", S.storage_label(c("storage_gb").cast("bigint")).alias("storage"), "condition", "battery_assumed", c("region_used").alias("region"), "asking_price", F.bround("fair_price", 0).cast("bigint").alias("fair_price"),
        F.array(F.bround("fair_low", 0).cast("bigint"), F.bround("fair_high", 0).cast("bigint")).alias("fair_range"), F.bround("delta_pct", 2).alias("delta_pct"), "verdict", "error", *extra,
    )).alias("value"))


def as_lines(valued: DataFrame) -> DataFrame:
    """One line of text for each valuation."""
    c = F.col
    low, high = S.inner_range(c("fair_low"), c("fair_high"))
    head = F.concat_ws(" | ", "model", S.storage_label(c("storage_gb").cast("bigint")), "condition", "region_used", F.concat(F.lit("asked "), S.money(c("asking_price"))))
    tail = F.format_string("fair ~%s (%s - %s), %+.1f%%, %s", S.money(S.half_even(c("fair_price"), 500)), S.money(low), S.money(high), c("delta_pct"), c("verdict"))
    return valued.select(F.concat_ws(" | ", head, F.when(c("error").isNull(), tail).otherwise(F.concat(F.lit("error: "), "error"))).alias("value"))
