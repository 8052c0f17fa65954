"""Synthetic raw listings: every value is drawn from hashes of (seed, row), so any partitioning gives the same rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.sources.catalog import catalog

# ---- Fixed values: shape of the price, popular models, regions with weight and level.
STORAGE_STEP, BATTERY_SLOPE, REFERENCE_BATTERY, BOX, RECEIPT = 1.12, 0.007, 88, 1.03, 1.02
CONDITIONS = (("used", 0.78, 1.0, "Хорошее"), ("new", 0.12, 1.22, "Новое"), ("refurbished", 0.10, 0.9, "Восстановленное"))
REGIONS = (
    ("Москва", 0.34, 1.04), ("Санкт-Петербург", 0.16, 1.02), ("Московская область", 0.10, 1.01), ("Екатеринбург", 0.07, 0.98), ("Новосибирск", 0.06, 0.97), ("Казань", 0.06, 0.98), ("Краснодар", 0.06, 0.99), ("Нижний Новгород", 0.05, 0.97),
    ("Ростов-на-Дону", 0.05, 0.98), ("Самара", 0.05, 0.97),
)
POPULAR = ("iPhone 11", "iPhone 12", "iPhone 13", "iPhone 13 Pro", "iPhone 14", "iPhone 14 Pro", "iPhone 14 Pro Max", "iPhone 15", "iPhone 15 Pro", "iPhone 15 Pro Max", "iPhone 16 Pro")
JUNK = ("На запчасти, не включается.", "Заблокирован на iCloud, пароль не помню.", "Экран разбит, остальное работает.", "Утопленник, после воды не заряжается.", "Реплика, точная копия.")
FIRST_ID = 4_000_000_000


@dataclass(frozen=True)
class Shares:
    """Shares of row kinds and gaps."""

    junk: float = 0.08
    anomaly: float = 0.04
    duplicate: float = 0.03
    no_battery: float = 0.3
    unparsed: float = 0.2
    noise: float = 0.06


def uniform(ident: Column, seed: int, salt: str) -> Column:
    """A number in [0, 1) that depends on the id, the seed and the salt alone."""
    return F.pmod(F.xxhash64(ident, F.lit(seed), F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def normal(ident: Column, seed: int, salt: str) -> Column:
    """A standard normal draw (Box-Muller)."""
    u, v = uniform(ident, seed, salt + "/u"), uniform(ident, seed, salt + "/v")
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * 3.141592653589793 * v)


def weighted(u: Column, choices: list[tuple[object, float]]) -> Column:
    """The choice whose cumulated share of the weights covers ``u``."""
    total, reached, out = sum(w for _, w in choices), 0.0, F.lit(None)
    bounds = []
    for value, w in choices:
        reached += w / total
        bounds.append((value, reached))
    for value, bound in reversed(bounds):
        out = F.when(u < bound, F.lit(value)).otherwise(out if value is not bounds[-1][0] else F.lit(value))
    return out


def expected_price(base: Column, step: Column, condition: Column, battery: Column, box: Column, receipt: Column, region: Column) -> Column:
    """Price without noise: base, storage step, condition, battery of used devices, extras, region."""
    level = F.create_map(*[F.lit(x) for c in CONDITIONS for x in (c[0], c[2])])[condition]
    place = F.coalesce(F.create_map(*[F.lit(x) for r in REGIONS for x in (r[0], r[2])])[region], F.lit(1.0))
    worn = F.when(condition == "used", 1 + BATTERY_SLOPE * (battery - REFERENCE_BATTERY)).otherwise(1.0)
    return base * F.pow(F.lit(STORAGE_STEP), step) * level * worn * F.when(box, BOX).otherwise(1.0) * F.when(receipt, RECEIPT).otherwise(1.0) * place


def synthetic_listings(spark: SparkSession, rows: int = 3000, seed: int = 42, shares: Shares | None = None, scraped_at: str = "2026-09-01T12:00:00+00:00") -> DataFrame:
    """Raw listings: clean, junk, anomalies and duplicates in the given shares, in hashed order."""
    s = shares or Shares()
    duplicates = int(round(rows * s.duplicate))
    own = max(1, rows - duplicates)
    i = F.col("id")
    models = catalog(spark).select("name", "release_date", "storage_options", F.year("release_date").alias("y"))
    entries = [(r[0], 3.0 if r[0] in POPULAR else 1.0) for r in models.select("name").collect()]
    base = spark.range(own).withColumns({
        "model": weighted(uniform(i, seed, "model"), entries), "condition": weighted(uniform(i, seed, "condition"), [(c[0], c[1]) for c in CONDITIONS]), "region": weighted(uniform(i, seed, "region"), [(r[0], r[1]) for r in REGIONS]),
        "box": uniform(i, seed, "box") < 0.6, "receipt": uniform(i, seed, "receipt") < 0.4, "kind": uniform(i, seed, "kind"),
    }).join(F.broadcast(models), F.col("model") == F.col("name"))
    step = F.floor(uniform(i, seed, "storage") * F.size("storage_options")).cast("int")
    age = F.lit(2026) - F.col("y")
    battery = F.when(F.col("condition") == "used", F.greatest(F.lit(60), F.least(F.lit(100), F.bround(97 - 2.6 * age + 4 * normal(i, seed, "battery"), 0)))).otherwise(100).cast("int")
    listed = base.withColumns({"step": step, "battery": battery, "storage": F.get("storage_options", step)})
    start = F.lit(7_000) * F.pow(F.lit(1.33), F.col("y") - 2017)  # a base price that grows with the year of release
    fair = expected_price(start, F.col("step"), F.col("condition"), F.col("battery"), F.col("box"), F.col("receipt"), F.col("region"))
    price = F.bround(fair * F.exp(s.noise * normal(i, seed, "noise")) / 500, 0) * 500
    price = F.when((price >= 10_000) & (uniform(i, seed, "ending") < 0.3), price - 10).otherwise(price)
    junk, odd = F.col("kind") < s.junk, (F.col("kind") >= s.junk) & (F.col("kind") < s.junk + s.anomaly)
    price = F.when(junk, F.bround(price * 0.35 / 500, 0) * 500).when(odd, F.when(uniform(i, seed, "odd") < 0.5, price * 0.2).otherwise(price * 4)).otherwise(price)
    label = F.when(F.col("storage") >= 1024, F.concat((F.col("storage") / 1024).cast("int"), F.lit(" ТБ"))).otherwise(F.concat(F.col("storage"), F.lit(" ГБ")))
    shown = uniform(i, seed, "shown") >= s.no_battery
    kit = F.when(F.col("box") & F.col("receipt"), "Коробка, чек, документы — все есть.").when(F.col("box"), "Коробка есть, чека нет.").when(F.col("receipt"), "Без коробки, но есть чек.").otherwise("Коробки и чека нет.")
    body = F.concat_ws(" ", F.when(shown, F.concat(F.lit("АКБ "), F.col("battery"), F.lit("%."))), kit, F.concat(F.lit("Объявление "), i.cast("string"), F.lit(", торг при осмотре.")))
    said = F.create_map(*[F.lit(x) for c in CONDITIONS for x in (c[0], c[3])])[F.col("condition")]
    parsed = uniform(i, seed, "parsed") >= s.unparsed
    bad = F.element_at(F.array(*[F.lit(j) for j in JUNK]), (F.floor(uniform(i, seed, "junk") * len(JUNK)) + 1).cast("int"))
    out = listed.select(
        (FIRST_ID + i).cast("string").alias("item_id"), F.concat(F.lit("https://board.example/telefony/iphone_"), FIRST_ID + i).alias("listing_url"), F.concat_ws(", ", F.col("model"), label).alias("title"), F.when(parsed, F.col("model")).alias("model"),
        F.when(parsed, F.col("storage").cast("string")).alias("storage_gb"), F.when(parsed, F.col("condition")).alias("condition"), F.when(parsed & shown, F.col("battery").cast("string")).alias("battery_health"), price.cast("bigint").cast("string").alias("price"),
        F.when(junk, F.concat_ws(" ", bad, F.concat(F.lit("Номер "), i.cast("string")))).otherwise(body).alias("description"), F.concat(F.col("region"), F.lit(", центр")).alias("location"), F.to_json(F.create_map(F.lit("Модель"), F.col("model"), F.lit("Состояние"), said)).alias("params"),
        F.lit(scraped_at).alias("scraped_at"), i.alias("_i"),
    )
    again = out.where(F.col("_i") < duplicates).withColumn("_i", F.col("_i") + own)
    return out.unionByName(again).orderBy(F.xxhash64("_i", F.lit(seed))).drop("_i")
