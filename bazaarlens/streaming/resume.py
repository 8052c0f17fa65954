"""Streaming forms: captured pages or rows that arrive as files, appended once for each id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bazaarlens.operators.rules import not_seen


def append_new(batch: DataFrame, path: str, key: str = "item_id") -> int:
    """Append rows whose key is not stored under ``path`` yet; returns how many were written."""
    spark = batch.sparkSession
    try:
        known = spark.read.parquet(path).select(key)
    except Exception:  # nothing stored yet  # noqa: BLE001
        known = spark.createDataFrame([], T.StructType([batch.schema[key]]))
    fresh = not_seen(batch, known, key).persist()
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    fresh.unpersist()
    return n


def _followed(spark: SparkSession, source: str, schema: T.StructType, only: str | None) -> DataFrame:
    """A stream of a folder's parquet files; ``only`` names a file or a folder of files in it."""
    return spark.readStream.schema(schema).parquet(f"{source.rstrip('/')}/{only}*" if only else source)


def stream_append(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str, key: str = "item_id", only: str | None = None) -> StreamingQuery:
    """Follow a folder of parquet files (those named ``only``, if given) into a table without repeated keys; a rerun writes nothing twice."""
    rows = _followed(spark, source, schema, only)
    return rows.writeStream.foreachBatch(lambda df, _: append_new(df, sink, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_latest_counts(spark: SparkSession, source: str, schema: T.StructType, time: str, group: str, width: str = "1 day", late: str = "7 days", only: str | None = None) -> DataFrame:
    """Rows for each group and window of event time; rows later than ``late`` are left out."""
    rows = _followed(spark, source, schema, only).withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", late)
    return rows.groupBy(F.window("_at", width).alias("w"), F.col(group).alias("group")).agg(F.count("*").alias("rows")).select(F.col("w.start").alias("window_start"), "group", "rows")
