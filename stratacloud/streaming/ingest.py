"""File streams of points: idempotent running voxel counts and time-bin origins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clouds import voxels


def point_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def voxel_counts(stream: DataFrame, size: float) -> DataFrame:
    """Running count and centroid per voxel; state grows with the occupied voxels only."""
    return stream.groupBy(*voxels(size)).agg(F.count("*").alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"), F.avg("z").alias("z"))


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, key: str) -> DataFrame:
    """Counts per key and time window; state of windows behind the watermark is dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
