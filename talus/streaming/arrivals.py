"""Postings and events as streams (an extension: the batch operators stay the measure)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, schema: str, path: str, per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def windowed_counts(events: DataFrame, ts: str, by: str, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Tumbling counts; rows later than the watermark are left out."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return rows.groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def first_seen(events: DataFrame, key: str, ts: str, late: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
