"""Facts partitioned by the month of their date: written, delivered again and read by month."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.plans import gold
from lakestrata.sources.layers import Version, read_if_written, read_layer, write_layer

MONTH = "month"

# The date that a fact's rows are filed under; rows without one are a partition of their own.
FACT_DATES = {
    "fact_adp_shifts": "shift_date",
    "fact_care_history": "change_date",
    "fact_gbp_reviews": "review_date",
    "fact_hubspot_leads": "created_date",
    "fact_incidents": "incident_date",
    "fact_leases": "move_in_date",
    "fact_residents": "last_date",
    "fact_units": "snapshot_date",
}


def month_of(day: str) -> str:
    return f"{day[:7]}-01"


def write_fact(df: DataFrame, name: str, path: str, months: Iterable[str | None] | None = None) -> Version:
    """Write a fact by month; with ``months`` (first days, None for rows without a date) only these
    are replaced, and ``df`` holds their rows."""
    filed = df.withColumn(MONTH, F.trunc(FACT_DATES[name], "MM"))
    wanted = None if months is None else set(months)
    replace = None if wanted is None else lambda values: values[MONTH] in wanted
    return write_layer(filed, path, [MONTH], gather=True, replace=replace)


def read_fact(spark: SparkSession, path: str, name: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """A fact's rows, all or those dated from ``first`` to ``last`` (ISO days, either may be left
    out), read from the partitions of those months alone."""
    if first is None and last is None:
        return read_layer(spark, path).drop(MONTH)

    def keep(values: dict[str, str | None]) -> bool:
        month = values[MONTH]
        return month is not None and (first is None or month >= month_of(first)) and (last is None or month <= month_of(last))

    rows = read_layer(spark, path, keep=keep).drop(MONTH)
    if first is not None:
        rows = rows.filter(F.col(FACT_DATES[name]) >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.filter(F.col(FACT_DATES[name]) <= F.lit(last).cast("date"))
    return rows


def redeliver(spark: SparkSession, out: str, name: str, months: Iterable[str | None]) -> Version:
    """Build a fact's given months anew from silver and the written dimensions, and replace them.

    The rows of other months are neither read from gold nor written.
    """
    months = list(months)
    dataset, lookups = gold.FACT_SOURCES[name]
    source = read_layer(spark, f"{out}/silver/{dataset}")
    dims = {dim: read_if_written(spark, f"{out}/gold/dim/{dim}") for dim, _, _ in lookups}
    day = FACT_DATES[name]
    known = [F.lit(m).cast("date") for m in months if m is not None]
    wanted = F.trunc(F.col(day), "MM").isin(*known) if known else F.lit(False)
    if None in months:
        wanted = wanted | F.col(day).isNull()
    rows = gold.fact(name, source.filter(wanted), {dim: df for dim, df in dims.items() if df is not None})
    return write_fact(rows, name, f"{out}/gold/fact/{name}", months)
