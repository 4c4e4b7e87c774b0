"""Session settings the engine is written for; a cluster's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def configured(builder: SparkSession.Builder | None = None, **more: str) -> SparkSession:
    builder = builder or SparkSession.builder
    for key, value in {**DEFAULTS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
