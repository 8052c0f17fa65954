"""Queries that fill missing values of listings (problem 4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators.propagate import Hub, Target, fill, to_fill
from bazaarlens.session import cut_lineage, small_side
from bazaarlens.sources.tables import table


def _price_band(price: Column) -> Column:
    """Quarter octaves of a price."""
    return F.when(price > 0, F.floor(F.log2(price) * 4))


def _battery(field: str = "battery_health") -> Column:
    return F.coalesce(F.col(field).between(40, 100), F.lit(False))


def filled_clean(spark: SparkSession, folder: str) -> DataFrame:
    """clean_listings with battery, its flag and the release year filled and marked."""
    return _fill_clean(spark, folder, table(spark, folder, "clean_listings"))


def held_out(spark: SparkSession, folder: str) -> DataFrame:
    """Error of the fills on a tenth of the observed values, taken away by hash: field, n, error, error of the whole mean or mode.

    The error is the mean absolute one for the battery and the share of wrong categories for the year.
    """
    rows = table(spark, folder, "clean_listings")
    away = F.pmod(F.xxhash64("item_id"), F.lit(10)) == 0
    truth = rows.where(away).select("item_id", F.when(_battery() & (F.col("battery_known") == 1), F.col("battery_health")).alias("true_battery"), F.col("release_year").alias("true_year"))
    masked = rows.withColumns({"battery_health": F.when(~away, F.col("battery_health")), "release_year": F.when(~away, F.col("release_year"))})
    filled = _fill_clean(spark, folder, masked).select("item_id", "battery_health", "release_year").join(truth, "item_id")
    kept = rows.where(~away)
    mean = kept.where(_battery()).agg(F.avg("battery_health")).first()[0] or 0.0
    year = kept.groupBy("release_year").count().orderBy(F.desc("count"), "release_year").limit(1).collect()
    mode = year[0][0] if year else None
    battery = filled.where("true_battery is not null").select(F.lit("battery_health").alias("field"), F.abs(F.col("battery_health") - F.col("true_battery")).cast("double").alias("e"), F.abs(F.lit(mean) - F.col("true_battery")).alias("b"))
    years = filled.where("true_year between 2017 and 2025").select(F.lit("release_year").alias("field"), (~F.col("release_year").eqNullSafe(F.col("true_year"))).cast("double").alias("e"), (F.col("true_year") != F.lit(mode)).cast("double").alias("b"))
    return battery.unionByName(years).groupBy("field").agg(F.count("*").alias("n"), F.avg("e").alias("error"), F.avg("b").alias("plain_error"))


def _fill_clean(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    released = table(spark, folder, "phone_catalog").select(F.year("release_date").alias("_released")).where("_released is not null").distinct()
    own = rows.columns
    rows = rows.join(small_side(released), F.col("release_year") == F.col("_released"), "left")
    month = F.floor(F.months_between(F.to_timestamp_ntz(F.substring("scraped_at", 1, 10)), F.lit("2000-01-01").cast("date")) / 3)
    keys = {
        "model": F.lower(F.trim("model")), "storage": F.col("storage_gb"), "condition": F.col("condition"), "age": F.floor(F.col("phone_age_months") / 6), "price": _price_band(F.col("price")), "quarter": month,
    }
    hubs = [
        Hub(("model", "storage", "condition", "age"), 8.0), Hub(("model", "condition", "price"), 6.0), Hub(("model", "condition", "age"), 6.0), Hub(("model", "condition"), 4.0), Hub(("model",), 2.0),
        Hub(("condition", "age"), 1.0), Hub(("condition", "price"), 0.5), Hub(("quarter", "condition"), 0.1), Hub((), 0.01),
    ]
    targets = [
        Target("battery_health", _battery() & F.coalesce(F.col("battery_known") != 0, F.lit(True)), low=40, high=100),
        Target("battery_known", F.coalesce(F.col("battery_known").isin(0, 1), F.lit(False)), categorical=True),
        Target("release_year", F.col("_released").isNotNull(), categorical=True),
    ]
    filled = fill(rows, targets, keys, hubs)
    return filled.select(*own, *[c for c in filled.columns if c.endswith("_status")])


def filled_raw(spark: SparkSession, folder: str) -> DataFrame:
    """raw_listings with the battery filled and marked."""
    rows = table(spark, folder, "raw_listings")
    price = F.regexp_replace(F.regexp_replace("price", r"[.,]\d{1,2}\s*$", ""), r"[^0-9]", "").try_cast("double")
    named = F.lower(F.regexp_replace(F.coalesce(F.nullif(F.trim("model"), F.lit("")), F.regexp_extract("title", r"(?iu)((?:iphone|айфон)\s+\S+(?:\s+(?:pro|про)?\s*(?:max|макс)?(?:plus|плюс|mini|мини)?)?)", 1)), r"\s+", " "))
    keys = {"model": F.nullif(F.trim(named), F.lit("")), "condition": F.col("condition"), "storage": F.col("storage_gb"), "price": _price_band(price)}
    hubs = [Hub(("model", "storage", "condition"), 6.0), Hub(("model", "condition", "price"), 6.0), Hub(("model", "condition"), 4.0), Hub(("model",), 2.0), Hub(("condition", "price"), 1.0), Hub(("condition",), 0.5), Hub((), 0.01)]
    return fill(rows, [Target("battery_health", _battery(), low=40, high=100)], keys, hubs)


def fill_counts(spark: SparkSession, folder: str) -> DataFrame:
    """For each field its observed and filled values, those that stayed open, observed ones that changed, and values out of bounds."""
    parts = []
    for name, ident, filled, fields in (("raw_listings", "listing_row", filled_raw(spark, folder), ("battery_health",)), ("clean_listings", "item_id", filled_clean(spark, folder), ("battery_health", "battery_known", "release_year"))):
        filled = cut_lineage(filled.select(ident, *fields, *[f"{f}_status" for f in fields]))
        before = table(spark, folder, name, ident, *fields).select(ident, *[F.col(f).alias(f"{f}_before") for f in fields])
        both = filled.join(before, ident)
        for field in fields:
            value, status = F.col(field), F.col(f"{field}_status")
            low, high = {"battery_health": (40, 100), "battery_known": (0, 1), "release_year": (2000, 2100)}[field]
            parts.append(both.agg(
                F.lit(name).alias("table_name"), F.lit(field).alias("field_name"), F.count_if(status == "observed").alias("observed"), F.count_if(status == "filled").alias("filled"), F.count_if(status == "unfilled").alias("open"),
                F.count_if((status == "observed") & ~value.eqNullSafe(F.col(f"{field}_before"))).alias("changed"), F.count_if(~F.coalesce(value.between(low, high), F.lit(False))).alias("outside"),
            ))
    return reduce(DataFrame.unionByName, parts)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Values of both listing tables that have to be filled, read off the statuses of the fills."""
    raw = to_fill(filled_raw(spark, folder), ["battery_health"], "listing_row").withColumn("table_name", F.lit("raw_listings"))
    clean = to_fill(filled_clean(spark, folder), ["battery_health", "battery_known", "release_year"], "item_id").withColumn("table_name", F.lit("clean_listings"))
    return raw.unionByName(clean).select("table_name", "row_key", "field_name")


_NEEDED = """
SELECT 'raw_listings' AS table_name, listing_row::VARCHAR AS row_key, 'battery_health' AS field_name FROM raw_listings WHERE NOT coalesce(battery_health BETWEEN 40 AND 100, FALSE)
UNION ALL SELECT 'clean_listings', item_id, 'battery_health' FROM clean_listings WHERE NOT coalesce(battery_health BETWEEN 40 AND 100, FALSE) OR battery_known = 0
UNION ALL SELECT 'clean_listings', item_id, 'battery_known' FROM clean_listings WHERE battery_known IS NULL OR battery_known NOT IN (0, 1)
UNION ALL SELECT 'clean_listings', item_id, 'release_year' FROM clean_listings WHERE release_year IS NULL OR release_year NOT IN (SELECT DISTINCT year(release_date) FROM phone_catalog WHERE release_date IS NOT NULL)
"""
P4_SQL = {
    "p4_found": _NEEDED,
    "p4_fill_counts": f"""
WITH needed AS ({_NEEDED}), n AS (SELECT table_name, field_name, count(*) AS filled FROM needed GROUP BY ALL)
SELECT table_name, field_name, (SELECT CASE table_name WHEN 'raw_listings' THEN (SELECT count(*) FROM raw_listings) ELSE (SELECT count(*) FROM clean_listings) END) - filled AS observed, filled, 0::BIGINT AS open, 0::BIGINT AS changed, 0::BIGINT AS outside FROM n
""",
}
