"""Surrogate keys and distinct key sets."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.operators.joins import null_safe_join
from lakestrata.session import materialise

_PARTITION_SHIFT = 33  # monotonically_increasing_id: partition above, position below this bit


def union_distinct(frames: Iterable[DataFrame], key: str) -> DataFrame:
    """Distinct members of ``key`` over all frames; each is reduced before the union."""
    parts = [df.select(key).distinct() for df in frames]
    return reduce(DataFrame.unionByName, parts).distinct()


def surrogate_keys(members: DataFrame, id_column: str, key_column: str) -> DataFrame:
    """Dense keys 1..n in id order over distinct members, 0 for a NULL id.

    Two phases instead of one global sort: the members are range partitioned and written with
    their position, and the rows per partition (one row for each partition) give the offset of
    every partition, which is joined back. The written table makes the positions final.
    """
    ranged = (
        members.repartitionByRange(F.col(id_column).asc_nulls_first())
        .sortWithinPartitions(F.col(id_column).asc_nulls_first())
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = materialise(ranged, key_column)
    partition = F.shiftright("_place", _PARTITION_SHIFT).cast("int")
    position = F.col("_place").bitwiseAND((1 << _PARTITION_SHIFT) - 1)

    counts = placed.groupBy(partition.alias("_p")).agg(
        F.count("*").alias("n"), F.max(F.col(id_column).isNull().cast("int")).alias("has_null")
    )
    # One row per partition: few enough for one window.
    before = F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select("_p", (before + 1 - F.max("has_null").over(whole)).alias("_offset"))
    return (
        placed.withColumn("_p", partition)
        .join(offsets, "_p")
        .withColumn(key_column, F.col("_offset") + position)
        .select(*members.columns, key_column)
    )


def kept_keys(members: DataFrame, id_column: str, key_column: str, known: DataFrame | None) -> DataFrame:
    """Keys that stay from run to run: ids of ``known`` (the stored dimension) keep theirs, new ids
    are numbered after the largest in id order, a NULL id has key 0.

    Ids which no longer occur keep their row as it was stored, for older facts refer to it; a known
    id takes the attributes of ``members``. Without ``known`` all ids are new.
    """
    if known is None:
        return surrogate_keys(members, id_column, key_column)
    members = materialise(members, f"{key_column}_members")
    looked_up = null_safe_join(members, known.select(id_column, key_column), [id_column], "left")
    new = surrogate_keys(looked_up.filter(F.col(key_column).isNull()).drop(key_column), id_column, key_column)
    largest = known.agg(F.coalesce(F.max(key_column), F.lit(0))).scalar()
    after = F.when(F.col(id_column).isNotNull(), F.col(key_column) + largest).otherwise(F.lit(0)).cast("long")
    still = members.select(id_column).distinct().alias("m")
    gone = known.alias("k").join(still, F.col(f"k.{id_column}").eqNullSafe(F.col(f"m.{id_column}")), "left_anti")
    return (
        looked_up.filter(F.col(key_column).isNotNull())
        .unionByName(new.withColumn(key_column, after))
        .unionByName(gone.select(*looked_up.columns))
    )
