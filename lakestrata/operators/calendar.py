"""Calendar rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last``, two date columns of the single-row ``bounds``."""
    days = bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))
    return days.select(
        "date",
        F.year("date").cast("short").alias("year"),
        F.month("date").cast("short").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.day("date").cast("short").alias("day"),
    )
