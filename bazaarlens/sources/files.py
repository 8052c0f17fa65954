"""CSV sources and sinks of listings, with the null tokens and quoting of spreadsheet exports."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType()}


def _schema(fields: str) -> T.StructType:
    """A schema from 'name kind' pairs, without a session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (f.split() for f in fields.split(","))])


RAW_SCHEMA = _schema("item_id string, listing_url string, title string, model string, storage_gb string, condition string, battery_health string, price string, description string, location string, params string, scraped_at string")
RAW_COLUMNS = RAW_SCHEMA.fieldNames()
CLEAN_SCHEMA = _schema(
    "item_id string, listing_url string, title string, model string, storage_gb bigint, condition string, battery_health bigint, battery_known bigint, price bigint, location string, region string, has_box bigint, has_receipt bigint, "
    "release_year int, phone_age_months int, description string, scraped_at string"
)
CLEAN_COLUMNS = CLEAN_SCHEMA.fieldNames()
# ---- Fixed values: texts that stand for a missing value in tabular exports.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def null_tokens(df: DataFrame) -> DataFrame:
    """Texts that stand for missing values become null."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in texts})


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes; columns are found by name and absent ones are null."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    as_text = reader.csv(path)
    present = {c.lower(): c for c in as_text.columns}
    texts = null_tokens(as_text)
    return texts.select(*[(F.col(f"`{present[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in present else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV that :func:`read_csv` reads back as it was, blanks at the ends of texts and line breaks in them included."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(header=True, quote='"', escape='"', **keep).csv(path)


def from_records(spark: SparkSession, records: list[dict], schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Records with any subset of the columns, as texts where the schema has texts."""
    as_text = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}

    def value(r: dict, c: str):  # noqa: ANN202
        v = r.get(c)
        if v is None or c not in as_text or isinstance(v, str):
            return v
        return json.dumps(v, ensure_ascii=False) if isinstance(v, dict) else str(v)

    return spark.createDataFrame([tuple(value(r, c) for c in schema.fieldNames()) for r in records], schema)


def known_ids(spark: SparkSession, path: str, column: str = "item_id") -> DataFrame:
    """Distinct non-empty ids of a stored table; a missing one gives an empty set."""
    if not Path(path).exists():
        return spark.createDataFrame([], f"{column} string")
    return read_csv(spark, path, RAW_SCHEMA).select(column).where(F.coalesce(F.col(column), F.lit("")) != "").distinct()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines of a text file without blank ones and comments."""
    line = F.trim("value")
    return spark.read.text(path).select(line.alias("line")).where((F.col("line") != "") & ~F.col("line").startswith("#"))


def records_to_text(df: DataFrame, params: str = "params") -> DataFrame:
    """The map column as JSON text, letters of all scripts kept as they are."""
    return df.withColumn(params, F.to_json(params))


def write_json(document: dict, path: str) -> None:
    """A small document of the driver, such as metrics."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(document, ensure_ascii=False, indent=2), encoding="utf-8")
