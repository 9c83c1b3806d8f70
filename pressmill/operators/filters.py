"""Filters on computed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_where(rows: DataFrame, condition: Column) -> DataFrame:
    """Filter above the projections that computed the columns, not below.

    Catalyst pushes a plain filter down by repeating, inside the condition,
    every expression the columns were made of; with parsing or regular
    expressions in them that costs more than the rows it saves. A projection
    that reads the task number cannot be passed, so each column is computed
    once. Filters on stored columns should stay plain and reach the scan.
    """
    pinned = rows.withColumn("_task", F.spark_partition_id())
    return pinned.where((F.col("_task") >= 0) & condition).drop("_task")
