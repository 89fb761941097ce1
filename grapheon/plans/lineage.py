"""Cutting lineage in loops."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the session's spark.checkpoint.dir. A temporary folder only where that is unset and the master is local; on a cluster that is an error."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint"))
    return df.checkpoint(eager=True)
