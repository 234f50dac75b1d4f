"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where that is unset on a local master, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("a cluster needs spark.checkpoint.dir, a folder that the driver and all executors share")
        context.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "corvane-checkpoints"))
    return context.getCheckpointDir()


#: Spark's own switch: what an execution shuffled is removed when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, drop_shuffles: bool = False) -> DataFrame:
    """The same rows, computed once, in the shared folder. ``drop_shuffles`` removes the shuffle files behind them once they are written."""
    shared_folder(df.sparkSession)
    if not drop_shuffles:
        return df.checkpoint()
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    try:
        conf.set(CLEANUP, "true")
        # The switch is read when a plan is made, so the plan is made anew.
        return df.select("*").checkpoint()
    finally:
        conf.set(CLEANUP, before)
