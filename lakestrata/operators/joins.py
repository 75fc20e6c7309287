"""Equi joins of the star: NULL-safe keys, intervals laid on decades, month alignment.

No join is salted by hand and none is forced to broadcast (that of events with snapshots never is). A side is broadcast by its known size
(``autoBroadcastJoinThreshold``) or, once its shuffle has been measured, by adaptive execution;
otherwise both sides are shuffled and adaptive execution cuts a skewed partition into pieces by
the tasks that wrote it, which also spreads exact copies of one row. Every join reads each of its
inputs once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL equals NULL. Columns: those of ``left`` (of a full join: the keys
    of either side in their place), then those of ``right`` which are not keys."""
    keys = set(on)
    rest = [c for c in right.columns if c not in keys]
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *rest)
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(f"l.{c}").eqNullSafe(F.col(f"r._r_{c}"))
    marked = left.withColumn("_l_is_there", F.lit(True)) if how == "full" else left
    joined = marked.alias("l").join(renamed.alias("r"), condition, how)

    def key(c: str):
        if how != "full" or c not in keys:
            return F.col(f"l.{c}")
        return F.when(F.col("l._l_is_there"), F.col(f"l.{c}")).otherwise(F.col(f"r._r_{c}")).alias(c)

    return joined.select(*[key(c) for c in left.columns], *[f"r.{c}" for c in rest])


def lookup_key(fact: DataFrame, dim: DataFrame, id_column: str, key_column: str) -> DataFrame:
    """Left join which replaces nothing and adds the dimension's key.

    A NULL id meets the NULL member of the dimension if there is one; an unknown id gets NULL.
    """
    return null_safe_join(fact, dim.select(id_column, key_column), [id_column], "left")


def _decade(day: Column) -> Column:
    return F.floor(F.year(day) / 10).cast("int")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    point: str,
    start: str,
    end: str,
) -> DataFrame:
    """Left join: each point with every interval of its key which contains it (both ends in).

    An open end (NULL) never ends. Each interval is laid on those of its decades in which there
    are points at all, so the join is an equi join on key and decade in which a point has one
    place, and a point without any interval is simply one that finds no partner. Decades and not
    shorter spans: an interval is written for each span it touches, and within a decade it is
    compared with a bounded number of dates of its key. A NULL in the key matches nothing.
    """
    kept = [c for c in intervals.columns if c not in set(on)]
    decades = points.agg(F.collect_set(_decade(F.col(point))).alias("decades")).scalar()
    known = F.col(start).isNotNull()
    for c in on:
        known = known & F.col(c).isNotNull()
    earliest, latest = F.array_min("_decades"), F.array_max("_decades")
    first = F.greatest(_decade(F.col(start)), earliest)
    last = F.least(F.coalesce(_decade(F.col(end)), latest), latest)
    own = F.when(first <= last, F.sequence(first, last))
    touched = F.array_intersect(own, F.col("_decades"))
    laid_out = (
        intervals.filter(known)
        .withColumn("_decades", decades)
        .withColumn("_r_decade", F.explode(touched))
        .select(*[F.col(c).alias(f"_r_{c}") for c in on], "_r_decade", *[F.col(c).alias(f"_v_{c}") for c in kept])
    )
    condition = F.col("l._decade") == F.col("r._r_decade")
    for c in on:
        condition = condition & (F.col(f"l.{c}") == F.col(f"r._r_{c}"))
    condition = condition & (F.col(f"r._v_{start}") <= F.col(f"l.{point}"))
    condition = condition & (F.col(f"r._v_{end}").isNull() | (F.col(f"r._v_{end}") >= F.col(f"l.{point}")))
    joined = points.withColumn("_decade", _decade(F.col(point))).alias("l").join(laid_out.alias("r"), condition, "left")
    return joined.select(*[f"l.{c}" for c in points.columns], *[F.col(f"r._v_{c}").alias(c) for c in kept])


def month_aligned_join(
    events: DataFrame,
    snapshots: DataFrame,
    on: Sequence[str],
    event_date: str,
    snapshot_date: str,
) -> DataFrame:
    """Inner join of events with the snapshot of the same key in the same month.

    Snapshots are often made by an explode, whose rows Spark does not count: it takes millions of
    them for a few MB and would send them to the driver for a broadcast. Both sides are shuffled.
    """
    left = events.withColumn("_month", F.trunc(event_date, "MM"))
    right = snapshots.withColumn("_month", F.trunc(snapshot_date, "MM"))
    return left.hint("merge").join(right, [*on, "_month"]).select(
        *[left[c] for c in events.columns], *[right[c] for c in snapshots.columns if c not in set(on)]
    )
