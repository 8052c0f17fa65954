"""Parquet table source of the test and production layouts (one folder or file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Table ``name`` under ``folder``; ``columns`` prunes at the scan."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
