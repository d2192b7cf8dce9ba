"""Cutting lineage with reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpoint(df: DataFrame) -> DataFrame:
    """A checkpoint in the folder that spark.checkpoint.dir names; a local session without one, as in tests, gets a temporary folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints"))
    return df.checkpoint(eager=True)
