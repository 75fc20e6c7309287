"""Shares, ranks and rolling distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.numbers import percent
from lakestrata.operators.joins import null_safe_join
from lakestrata.session import materialise

ROLLING_DAYS = 90


def share_of_total(counts: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the share of each row in its group's total, in percent.

    ``counts`` is already aggregated to one row per member of a group. It is written once and
    read for the totals and for the rows; the totals are summed with a partial aggregate and
    joined back, so a group with very many members is never one window in one task.
    """
    stored = materialise(counts, "counts")
    totals = stored.groupBy(*group).agg(F.sum(value).alias("_total"))
    joined = null_safe_join(stored, totals, group, "left")
    return joined.withColumn(name, percent(F.col(value), F.col("_total"))).drop("_total")


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    Catalyst turns the rank filter into a group limit below the shuffle, so at most ``k`` rows
    per group leave a task.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def report_dates(dim_date: DataFrame, unit: str = "day") -> DataFrame:
    """``report_date``: the last day of every period the calendar has."""
    if unit == "day":
        return dim_date.select(F.col("date").alias("report_date"))
    return dim_date.groupBy(F.trunc("date", unit).alias("period")).agg(F.max("date").alias("report_date")).select("report_date")


def on_reports(groups: DataFrame, reports: DataFrame) -> DataFrame:
    """Each group with each report date; the dates are a few thousand days at most."""
    dates = reports.agg(F.sort_array(F.collect_set("report_date")).alias("dates")).scalar()
    return groups.withColumn("report_date", F.explode(dates))


def rolling_distinct(
    df: DataFrame,
    key: str,
    day: str,
    by: Sequence[str],
    name: str,
    reports: DataFrame,
    days: int = ROLLING_DAYS,
) -> DataFrame:
    """Distinct keys in the ``days`` calendar days which end on each report date, per group.

    Spark has no distinct window aggregate, and repeating each row for ``days`` report dates
    would cost a factor of ``days``. Instead: a key seen on a day counts for that day and the
    ``days - 1`` after it; overlapping spans of one key are merged, every merged piece adds 1 at
    its start and takes 1 away after its end, and a running sum over the days gives the count.

    There is a row for every group of ``df`` and every date of ``reports``, zeros included.
    """
    seen = df.filter(F.col(day).isNotNull() & F.col(key).isNotNull())
    seen = seen.select(*by, key, F.col(day).alias("day")).distinct()
    before = F.lag("day").over(Window.partitionBy(*by, key).orderBy("day"))
    spans = seen.withColumn("since", F.greatest("day", F.date_add(before, days)))
    plus = F.struct(F.col("since").alias("at"), F.lit(1).alias("change"))
    minus = F.struct(F.date_add("day", days).alias("at"), F.lit(-1).alias("change"))
    changes = spans.select(*by, F.explode(F.array(plus, minus)).alias("c")).select(*by, "c.*")

    groups = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    asked = on_reports(groups, reports).withColumnRenamed("report_date", "at")
    per_day = (
        changes.withColumn("asked", F.lit(False))
        .unionByName(asked.select(*by, "at", F.lit(0).alias("change"), F.lit(True).alias("asked")))
        .groupBy(*by, "at")
        .agg(F.sum("change").alias("change"), F.max("asked").alias("asked"))
    )
    running = F.sum("change").over(Window.partitionBy(*by).orderBy("at"))
    return (
        per_day.withColumn(name, running)
        .filter("asked")
        .select(*by, F.col("at").alias("report_date"), name)
    )
