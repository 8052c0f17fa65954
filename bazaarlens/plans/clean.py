"""The cleaning pipeline over raw listings: read attributes, drop by ordered rules, fill, fence, derive, project."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import scalars as S
from bazaarlens.functions import text as X
from bazaarlens.functions.signs import condition, signs
from bazaarlens.operators.forest import isolation_outliers
from bazaarlens.operators.rules import apply_rules, drop_repeats, drop_report
from bazaarlens.operators.stats import far_below_median, fill_group_median, group_statistics, outside_fence
from bazaarlens.session import cut_lineage
from bazaarlens.sources.catalog import names, with_model
from bazaarlens.sources.files import CLEAN_COLUMNS, RAW_COLUMNS

# ---- Fixed values: attribute names in listings, and the order of the rules in reports.
MODEL_KEYS, STORAGE_KEYS, CONDITION_KEYS = ("модель",), ("встроенная память", "объем встроенной памяти", "встроен"), ("состояние",)
STORAGES = (64, 128, 256, 512, 1024, 2048)
RULES = (
    "missing_price", "unknown_model", "missing_storage", "storage_not_offered", "junk_locked", "junk_for_parts", "junk_broken_screen", "junk_water_damage", "junk_fake", "junk_accessory", "junk_not_for_sale", "condition_for_parts",
    "price_below_minimum", "price_above_maximum", "duplicate_item_id", "duplicate_url", "duplicate_content", "suspiciously_cheap", "price_outlier_iqr", "price_outlier_isolation_forest",
)
CONDITION_CODE = {"used": 0, "refurbished": 1, "new": 2}


@dataclass(frozen=True)
class Settings:
    """Thresholds of the pipeline."""

    low_price: int = 5_000
    high_price: int = 400_000
    floor_share: float = 0.3
    installment_share: float = 0.5
    fence: float = 2.0
    least_group: int = 10
    contamination: float = 0.02
    method: str = "iqr"
    default_condition: str = "used"
    reference_date: dt.date | None = None

    def __post_init__(self) -> None:
        if self.method not in ("none", "iqr", "isolation_forest", "both"):
            raise ValueError(f"unknown outlier method {self.method!r}")


def read_attributes(raw: DataFrame, order: str | None = None, default_condition: str = "used") -> DataFrame:
    """Typed attributes of raw rows: each comes from the first of its sources that says something.

    ``order`` names a unique column of arrival; without it rows are numbered as they are read.
    """
    have = {c.lower() for c in raw.columns}
    col = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    base = raw.select(*[col(c).alias(c) for c in RAW_COLUMNS], (F.col(order).cast("long") if order else F.monotonically_increasing_id()).alias("row"))
    known, params = names(), S.params_map(F.col("params"))
    base = base.withColumns({"p": params, "p_text": S.params_text(params), "title": S.as_text(F.col("title")), "description": S.as_text(F.col("description"))})
    base = base.withColumn("signs", signs(F.col("title"), F.col("description")))
    p = F.col("p")
    found = F.col("signs")
    model = F.coalesce(X.model_name(F.col("model"), known, False), X.model_name(S.find_param(p, MODEL_KEYS, X.normalize), known, False), X.model_name(F.col("title"), known), X.model_name(F.col("description"), known))
    storage = F.coalesce(S.one_of(S.as_whole(F.col("storage_gb")), STORAGES).cast("int"), X.storage_gb(S.find_param(p, STORAGE_KEYS, X.normalize)), X.storage_gb(F.col("title"), True), X.storage_gb(F.col("description")))
    battery = F.coalesce(S.within(S.as_whole(F.col("battery_health")), 40, 100).cast("int"), X.battery_percent(F.col("p_text")), X.battery_percent(F.col("description")), X.battery_percent(F.col("title")))
    said = F.coalesce(S.blank_to_null(F.col("condition")), S.find_param(p, CONDITION_KEYS, X.normalize))
    return base.select(
        "row", S.as_text(F.col("item_id")).alias("item_id"), S.as_text(F.col("listing_url")).alias("listing_url"), "title", model.alias("model"), storage.cast("bigint").alias("storage_gb"),
        F.coalesce(condition(said, found), F.lit(default_condition)).alias("condition"), battery.cast("bigint").alias("battery_health"), X.price(F.col("price")).alias("price"), S.as_text(F.col("location")).alias("location"), X.region(F.col("location")).alias("region"),
        found["box"].cast("bigint").alias("has_box"), found["receipt"].cast("bigint").alias("has_receipt"), found["installment"].alias("installment"), found["junk"].alias("junk_reason"),
        "description", S.as_text(F.col("scraped_at")).alias("scraped_at"),
    )


def clean(raw: DataFrame, models: DataFrame, settings: Settings | None = None, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean rows in the fixed column order, report of drops). Every input row is kept or counted under one rule."""
    s = settings or Settings()
    rows = with_model(read_attributes(raw, order, s.default_condition), models)
    c = F.col
    rows = apply_rules(rows, [
        ("missing_price", c("price").isNull()), ("unknown_model", c("model").isNull()), ("missing_storage", c("storage_gb").isNull()), ("storage_not_offered", ~F.array_contains("storage_options", c("storage_gb").cast("int"))),
        *[(f"junk_{j}", c("junk_reason") == j) for j in ("locked", "for_parts", "broken_screen", "water_damage", "fake", "accessory", "not_for_sale")],
        ("condition_for_parts", c("condition") == "for_parts"), ("price_below_minimum", c("price") < s.low_price), ("price_above_maximum", c("price") > s.high_price),
    ])
    rows = cut_lineage(rows.withColumns({"print": X.fingerprint(c("description")), "log_price": F.when(c("price") > 0, F.log("price"))}))
    rows = drop_repeats(rows, "row", [
        ("duplicate_item_id", [c("item_id")], c("item_id") != ""), ("duplicate_url", [c("listing_url")], c("listing_url") != ""),
        ("duplicate_content", [c("model"), c("storage_gb"), c("price"), c("print")], F.length("print") >= 30),
    ])
    alive = c("drop_reason").isNull()
    rows = rows.withColumn("year", F.year("release_date"))
    # medians over survivors alone; dropped rows are carried along untouched
    rows = fill_group_median(rows, "battery_health", "year", alive & (c("condition") != "new"), 90.0, F.when(c("condition") == "new", 100))
    rows = cut_lineage(rows)
    log_price: Column = c("log_price")
    cheap = group_statistics(rows, log_price, [("model", "storage_gb"), ("model",)], s.least_group, alive)
    too_low = far_below_median(log_price, s.floor_share) | (c("installment") & far_below_median(log_price, s.installment_share))
    rows = cut_lineage(apply_rules(cheap, [("suspiciously_cheap", too_low)]).select(*rows.columns))
    if s.method in ("iqr", "both"):
        fenced = group_statistics(rows, log_price, [("model", "storage_gb", "condition"), ("model", "condition"), ("model",)], s.least_group, alive)
        rows = cut_lineage(apply_rules(fenced, [("price_outlier_iqr", outside_fence(log_price, s.fence))]).select(*rows.columns))
    if s.method in ("isolation_forest", "both"):
        around = group_statistics(rows, log_price, [("model", "storage_gb", "condition"), ("model", "condition"), ("model",)], 1, alive).where(alive)
        code = F.coalesce(F.create_map(*[F.lit(x) for kv in CONDITION_CODE.items() for x in kv])[c("condition")], F.lit(0))
        around = around.withColumns({"_off": log_price - c("stat_median"), "_code": code, "_log_storage": F.log2("storage_gb")})
        lonely = isolation_outliers(around, ["_off", "battery_health", "_code", "_log_storage", "year"], "row", s.contamination).where("is_outlier").select(c("row").alias("_lonely"))
        rows = rows.join(lonely, c("row") == c("_lonely"), "left").withColumn("drop_reason", F.when(c("_lonely").isNotNull() & alive, "price_outlier_isolation_forest").otherwise(c("drop_reason"))).drop("_lonely")
    seen = F.coalesce(F.lit(s.reference_date).cast("date"), F.current_date())
    kept = rows.where(alive).select(
        "item_id", "listing_url", "title", "model", "storage_gb", "condition", "battery_health", c("battery_health_known").alias("battery_known"), "price", "location", "region", "has_box", "has_receipt",
        c("year").cast("int").alias("release_year"), S.whole_months(c("release_date"), S.iso_date(c("scraped_at"), seen)).cast("int").alias("phone_age_months"), "description", "scraped_at",
    )
    return kept.select(*CLEAN_COLUMNS), drop_report(rows, RULES)
