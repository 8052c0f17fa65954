"""Listings completed for training and prediction: every row gets a value in every feature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import scalars as S
from bazaarlens.functions import text as X
from bazaarlens.operators.features import OTHER, feature_frame
from bazaarlens.operators.stats import fill_group_median
from bazaarlens.session import cut_lineage, small_side
from bazaarlens.sources.catalog import names, with_model


def complete_listings(rows: DataFrame, models: DataFrame) -> DataFrame:
    """Archive rows with no gap in the columns that the features need.

    The model and the storage of a row without them are read from its title; what is still open is
    ``OTHER`` or the most frequent storage of the model; a battery that was not observed is the median
    of its release year (new devices: 100), an unknown age the median of its year; regions get their
    usual names; extras count as absent.
    """
    c = F.col
    model = F.coalesce(F.nullif(S.strip(c("model")), F.lit("")), X.model_name(c("title"), names()), F.lit(OTHER))
    storage = F.coalesce(c("storage_gb"), X.storage_gb(c("title"), True).cast("bigint"))
    rows = cut_lineage(rows.withColumns({"model": model, "storage_gb": storage, "region": X.region(c("region"))}))  # read four times below
    rows = with_model(rows, models)
    rows = rows.withColumns({"release_year": F.year("release_date"), "condition": F.coalesce("condition", F.lit("used"))})
    usual = rows.where("storage_gb is not null").groupBy("model").agg(F.mode("storage_gb", True).alias("_usual"))
    rows = rows.join(small_side(usual), "model", "left")
    overall = rows.where("storage_gb is not null").agg(F.mode("storage_gb", True)).first()[0]
    observed = S.within(c("battery_health"), 40, 100)
    age = F.coalesce(c("phone_age_months"), S.whole_months(c("release_date"), S.iso_date(c("scraped_at"), F.lit(None).cast("date"))))
    rows = rows.withColumns({
        "storage_gb": F.coalesce("storage_gb", "_usual", F.lit(overall)), "battery_health": F.when(F.coalesce(c("battery_known") != 0, F.lit(True)), observed), "phone_age_months": age,
        "has_box": F.coalesce(S.one_of(c("has_box"), (0, 1)), F.lit(0)), "has_receipt": F.coalesce(S.one_of(c("has_receipt"), (0, 1)), F.lit(0)),
    }).drop("_usual", "battery_known", "tier", "release_date", "storage_options")
    is_new = c("condition") == "new"
    rows = fill_group_median(rows, "battery_health", "release_year", ~is_new, 90.0, F.when(is_new, 100)).withColumnRenamed("battery_health_known", "battery_known")
    return fill_group_median(rows, "phone_age_months", "release_year", F.lit(True), 36.0).drop("phone_age_months_known")


def price_features(rows: DataFrame, models: DataFrame, *keep: str) -> DataFrame:
    """Features, ``keep`` and price of all rows."""
    return feature_frame(complete_listings(rows, models), models, [*keep, "price"])
