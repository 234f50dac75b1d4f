"""Rows in a total order without gathering a key's rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm._storage import materialise


def placed(rows: DataFrame, order: list[str], keep: list | None = None) -> DataFrame:
    """The rows, or of them the columns ``keep``, with ``place``: it grows with ``order``, nulls first, over all partitions.

    Rows are dealt by ranges of the whole order, so a key that has a third of them is cut into many ranges. They are
    written, since places must not change when a partition is lost.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    there = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    return materialise(there.select(*(keep or there.columns), F.monotonically_increasing_id().alias("place")))


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """``placed`` rows, ordered by ``key`` first, with ``pos``: 1, 2, ... within each key. Only (key, partition) counts are summed up."""
    part = F.shiftright("place", 33)
    heads = rows.groupBy(key, part.alias("part")).agg(F.min("place").alias("head"), F.count("*").alias("many"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(key, "part", (F.col("head") - F.coalesce(F.sum("many").over(before), F.lit(0)) - 1).alias("zero"))
    return rows.withColumn("part", part).join(heads, [key, "part"]).withColumn("pos", F.col("place") - F.col("zero")).drop("part", "zero", "place")
