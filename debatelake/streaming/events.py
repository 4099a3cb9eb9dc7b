"""Streaming forms: ingestion of files, deduplication, and sessions by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_a_trigger: int = 1000) -> DataFrame:
    """New files as a stream; its checkpoint stands for skipping what is done."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).format(fmt).load(path)


def first_of_key(stream: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def sessions(stream: DataFrame, key: list[str], time: str, gap: str, delay: str) -> DataFrame:
    """Rows of a key that follow each other within a gap, counted; late rows beyond the delay are dropped."""
    out = stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), *key).agg(F.count("*").alias("n"))
    return out.select(*key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def windows(stream: DataFrame, key: list[str], time: str, width: str, delay: str, slide: str | None = None) -> DataFrame:
    out = stream.withWatermark(time, delay).groupBy(F.window(time, width, slide).alias("w"), *key).agg(F.count("*").alias("n"))
    return out.select(*key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
