"""Positions of rows within groups, without one task for a group and without a total sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.operators.joins import null_safe_join
from llm.common import drop, written

#: ``monotonically_increasing_id`` has the partition above this bit and the place in it below.
_PARTITION_BIT = 33


def positions(df: DataFrame, group: Sequence[str], order: Sequence[Column], label: str) -> DataFrame:
    """``df`` with ``position``, 0, 1, ... within each group in ``order``, which begins with the
    group's columns. A null is a group like another.

    Rows are range partitioned, so a group of any size is spread over tasks; what is joined back is
    one row per partition and group. Equal rows are told apart by their place in the written input,
    so repeated rows also spread. ``df`` is written, so that sampling for the ranges computes
    nothing twice, and again in order, which makes the positions final.
    """
    stored = written(df, f"{label}_rows").withColumn("__tie", F.monotonically_increasing_id())
    ranged = stored.repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie")
    placed = written(
        ranged.drop("__tie").withColumn("__place", F.monotonically_increasing_id()), f"{label}_places"
    ).withColumn("__part", F.shiftright("__place", _PARTITION_BIT).cast("int"))
    drop(stored)

    runs = placed.groupBy("__part", *group).agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__n").over(earlier), F.lit(0).cast("long"))
    starts = runs.withColumn("__before", before).drop("__n")
    return null_safe_join(placed, starts, ["__part", *group], "left").select(
        *df.columns, (F.col("__place") - F.col("__first") + F.col("__before")).alias("position")
    )
