"""The static catalogue of phone models and the lookups on it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_SCHEMA = "name string, tier string, release_date date, storage_options array<int>"
# ---- Fixed values: model; tier; release date; storage options in GB.
CATALOG_LINES = """
iPhone 8; base; 2017-09-22; 64 128 256
iPhone 8 Plus; plus; 2017-09-22; 64 128 256
iPhone X; pro; 2017-11-03; 64 256
iPhone XR; base; 2018-10-26; 64 128 256
iPhone XS; pro; 2018-09-21; 64 256 512
iPhone XS Max; pro_max; 2018-09-21; 64 256 512
iPhone 11; base; 2019-09-20; 64 128 256
iPhone 11 Pro; pro; 2019-09-20; 64 256 512
iPhone 11 Pro Max; pro_max; 2019-09-20; 64 256 512
iPhone SE 2020; se; 2020-04-24; 64 128 256
iPhone 12 mini; mini; 2020-11-13; 64 128 256
iPhone 12; base; 2020-10-23; 64 128 256
iPhone 12 Pro; pro; 2020-10-23; 128 256 512
iPhone 12 Pro Max; pro_max; 2020-11-13; 128 256 512
iPhone 13 mini; mini; 2021-09-24; 128 256 512
iPhone 13; base; 2021-09-24; 128 256 512
iPhone 13 Pro; pro; 2021-09-24; 128 256 512 1024
iPhone 13 Pro Max; pro_max; 2021-09-24; 128 256 512 1024
iPhone SE 2022; se; 2022-03-18; 64 128 256
iPhone 14; base; 2022-09-16; 128 256 512
iPhone 14 Plus; plus; 2022-10-07; 128 256 512
iPhone 14 Pro; pro; 2022-09-16; 128 256 512 1024
iPhone 14 Pro Max; pro_max; 2022-09-16; 128 256 512 1024
iPhone 15; base; 2023-09-22; 128 256 512
iPhone 15 Plus; plus; 2023-09-22; 128 256 512
iPhone 15 Pro; pro; 2023-09-22; 128 256 512 1024
iPhone 15 Pro Max; pro_max; 2023-09-22; 256 512 1024
iPhone 16; base; 2024-09-20; 128 256 512
iPhone 16 Plus; plus; 2024-09-20; 128 256 512
iPhone 16 Pro; pro; 2024-09-20; 128 256 512 1024
iPhone 16 Pro Max; pro_max; 2024-09-20; 256 512 1024
iPhone 16e; e; 2025-02-28; 128 256 512
iPhone 17; base; 2025-09-19; 256 512
iPhone Air; air; 2025-09-19; 256 512 1024
iPhone 17 Pro; pro; 2025-09-19; 256 512 1024
iPhone 17 Pro Max; pro_max; 2025-09-19; 256 512 1024 2048
"""


def rows() -> list[tuple[str, str, dt.date, list[int]]]:
    found = []
    for line in CATALOG_LINES.strip().splitlines():
        name, tier, released, options = (x.strip() for x in line.split(";"))
        found.append((name, tier, dt.date.fromisoformat(released), [int(x) for x in options.split()]))
    return found


def names() -> list[str]:
    return [r[0] for r in rows()]


def catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), CATALOG_SCHEMA)


def lookup_key(name: Column) -> Column:
    """Case and white space do not matter."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " "))


def with_model(df: DataFrame, models: DataFrame, model: str = "model") -> DataFrame:
    """``df`` with tier, release_date and storage_options of its model, null where it is not in the catalogue."""
    keyed = models.select(lookup_key(F.col("name")).alias("_model_key"), "tier", "release_date", "storage_options")
    return df.join(F.broadcast(keyed), lookup_key(df[model]) == F.col("_model_key"), "left").drop("_model_key")  # a catalogue of tens of rows


def require_models(df: DataFrame, models: DataFrame, model: str = "model") -> DataFrame:
    """Inner lookup that raises if a model is unknown."""
    found = with_model(df, models, model)
    missing = found.where(F.col("release_date").isNull()).select(model).limit(1).collect()
    if missing:
        raise KeyError(f"unknown model: {missing[0][0]!r}")
    return found


def offered(storage: Column, options: Column | None = None) -> Column:
    """Whether a capacity is among the options of its model."""
    return F.array_contains(F.col("storage_options") if options is None else options, storage)


def storage_set(models: DataFrame) -> Column:
    """Aggregate: the sorted set of all options."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list("storage_options"))))
