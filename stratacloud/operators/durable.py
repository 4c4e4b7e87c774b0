"""Breaking a long lineage so that lost executors don't undo it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame, clear: bool = False) -> DataFrame:
    """df written to the checkpoint folder that the session names, and read from there. A local folder is made only where none
    is named and the session is local, as in tests; on a cluster other machines would not see it. With clear, the shuffle files that
    this took go as soon as it is written, not when the driver next collects its garbage."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="stratacloud-checkpoint-"))
    if not clear:
        return df.checkpoint()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        # a plan takes the setting when it is made, so that plans over df made elsewhere keep their files
        return df.select("*").checkpoint()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
