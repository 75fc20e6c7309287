"""Which dated points lie inside an interval of their key, and how many keys have one at a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def covered_points(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    point: str,
    start: str,
    end: str,
) -> DataFrame:
    """Distinct (key, point) with ``is_covered``: some interval has start <= point <= end.

    A running count of starts and ends per key answers this without forming pairs. Intervals and
    points are gathered by key once, an interval as one row; its two changes are made there, and
    one sort puts the changes of a day before its points and equal points next to each other.
    """
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    spans = _valid(intervals.filter(known), start, end).select(
        *on, F.col(start).alias("day"), F.col(end).alias("end"), F.lit(False).alias("is_point")
    )
    asked = points.select(
        *on, F.col(point).alias("day"), F.lit(None).cast("date").alias("end"), F.lit(True).alias("is_point")
    )
    gathered = spans.unionByName(asked).repartition(*on)
    change = F.when(F.col("is_point"), F.lit(0)).otherwise(F.lit(1))
    changes = gathered.select(*on, "is_point", F.explode(_changes("day", "end", change)).alias("c"))
    order = Window.partitionBy(*on).orderBy(F.col("day").asc_nulls_first(), "is_point")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.struct("day", "is_point")
    return (
        changes.select(*on, "is_point", "c.day", "c.change")
        .withColumns({"open": F.sum("change").over(upto), "again": F.lag(here).over(order).eqNullSafe(here)})
        .filter(F.col("is_point") & ~F.col("again"))
        .select(*on, F.col("day").alias(point), (F.col("open") > 0).alias("is_covered"))
    )


def _valid(intervals: DataFrame, start: str, end: str) -> DataFrame:
    return intervals.filter(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start))))


def _changes(start: str, end: str, change: Column) -> Column:
    """The days at which an interval begins and no longer holds, each with its change."""
    begin = F.struct(F.col(start).alias("day"), change.alias("change"))
    back = F.struct(F.date_add(F.col(end), 1).alias("day"), F.lit(-1).alias("change"))
    return F.when(F.col(end).isNull(), F.array(begin)).otherwise(F.array(begin, back))


def keys_covered_on(
    intervals: DataFrame, by: Sequence[str], key: str, start: str, end: str, dates: DataFrame, date: str, name: str
) -> DataFrame:
    """``dates`` (``by`` and ``date``) with the number of distinct keys of the group that have an
    interval with start <= date <= end; an open end never ends, an interval without a start or key
    never begins.

    A sweep over time: where the running count of a key's starts and ends leaves or reaches zero the
    key becomes covered or free. These turns are summed per group and day, and their running sum is
    the answer on every date; turns to and fro on one day add up to none, in whatever order. Intervals
    are gathered by key once, and what is made of them grows with intervals plus dates, not with
    their pairs.
    """
    valid = _valid(intervals.filter(F.col(key).isNotNull()), start, end).select(*by, key, start, end)
    gathered = valid.repartition(*by, key)
    changes = gathered.select(*by, key, F.explode(_changes(start, end, F.lit(1))).alias("c")).select(*by, key, "c.*")
    upto = Window.partitionBy(*by, key).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turned = (F.col("open") > 0).cast("int") - (F.col("open") - F.col("change") > 0).cast("int")
    turns = changes.withColumn("open", F.sum("change").over(upto)).withColumn("turn", turned).filter("turn <> 0")

    asked = dates.select(*by, F.col(date).alias("day"), F.lit(0).alias("turn"), F.lit(True).alias("asked")).distinct()
    days = (
        turns.select(*by, "day", "turn", F.lit(False).alias("asked"))
        .unionByName(asked)
        .groupBy(*by, "day")
        .agg(F.sum("turn").alias("turn"), F.max("asked").alias("asked"))
    )
    running = F.sum("turn").over(Window.partitionBy(*by).orderBy(F.col("day").asc_nulls_first()))
    counted = F.when(F.col("day").isNull(), 0).otherwise(F.col("covered")).cast("long")
    return days.withColumn("covered", running).filter("asked").select(*by, F.col("day").alias(date), counted.alias(name))
