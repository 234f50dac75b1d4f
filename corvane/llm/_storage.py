"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> None:
    """Use the folder in ``spark.checkpoint.dir``; only where it is unset on a local master, as in tests, one of our own."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("a cluster needs spark.checkpoint.dir, a folder that the driver and all executors share")
        context.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "corvane-checkpoints"))


#: Rows of an Arrow batch while rows are computed and written: some megabytes of texts or sets on either side of a Python worker.
BATCH_ROWS = 2000


#: Spark's own switch: what an execution shuffled is removed when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, batch_rows: int = BATCH_ROWS, drop_shuffles: bool = False) -> DataFrame:
    """The same rows, computed once; they survive the loss of executors. Large rows ask for fewer of them in a batch.

    ``drop_shuffles`` removes the shuffle files behind them once they are written, when nothing reads those again.
    """
    shared_folder(df.sparkSession)
    conf = df.sparkSession.conf
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch_rows)}
    if 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= batch_rows:
        wanted = {}
    if drop_shuffles:
        wanted[CLEANUP] = "true"
    before = {key: conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            conf.set(key, value)
        # The switch is read when a plan is made, so the plan is made anew.
        return (df.select("*") if drop_shuffles else df).checkpoint()
    finally:
        for key, value in before.items():
            conf.set(key, value)
