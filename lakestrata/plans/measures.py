"""Report measures; each takes the columns to group by.

Grouping columns are columns of the fact the measure counts; rows without a value in them are a
group of their own. A ratio without a divisor is 0. Trailing measures have a row for each group
and each report date, and the report dates are those of the calendar: every day, or the last day
of every month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.numbers import divide
from lakestrata.operators.joins import null_safe_join
from lakestrata.operators.occupancy import keys_covered_on
from lakestrata.operators.windows import ROLLING_DAYS, on_reports, report_dates, rolling_distinct


def _period(date: str, unit: str) -> Column:
    return F.trunc(date, unit).alias("period")


def active_residents(fact_residents: DataFrame, by: Sequence[str], unit: str = "month") -> DataFrame:
    """Distinct residents with an active snapshot in the period."""
    active = fact_residents.filter("status = 'Active'")
    return active.groupBy(*by, _period("last_date", unit)).agg(
        F.count_distinct("resident_key").alias("active_residents")
    )


def selected_days(dim_date: DataFrame, unit: str = "month") -> DataFrame:
    return dim_date.groupBy(_period("date", unit)).agg(F.count("date").alias("selected_days"))


def resident_days(
    fact_residents: DataFrame, dim_date: DataFrame, by: Sequence[str], unit: str = "month"
) -> DataFrame:
    """Active residents of the period times its calendar days.

    A period of the residents which the calendar does not have stays, with no selected days.
    """
    residents = active_residents(fact_residents, by, unit)
    days = null_safe_join(residents, selected_days(dim_date, unit), ["period"], "left")
    days = days.withColumn("selected_days", F.coalesce("selected_days", F.lit(0).cast("long")))
    return days.withColumn("resident_days", F.col("active_residents") * F.col("selected_days"))


def incident_rate(
    fact_incidents: DataFrame,
    fact_residents: DataFrame,
    dim_date: DataFrame,
    by: Sequence[str],
    unit: str = "month",
) -> DataFrame:
    """Distinct incidents per 100 resident-days; periods with neither are absent."""
    incidents = fact_incidents.groupBy(*by, _period("incident_date", unit)).agg(
        F.count_distinct("incident_id").alias("total_incidents")
    )
    days = resident_days(fact_residents, dim_date, by, unit).select(*by, "period", "resident_days")
    n = F.coalesce("total_incidents", F.lit(0).cast("long"))
    return null_safe_join(days, incidents, [*by, "period"], "full").select(
        *by,
        "period",
        n.alias("total_incidents"),
        F.coalesce("resident_days", F.lit(0).cast("long")).alias("resident_days"),
        (divide(n, F.col("resident_days")) * 100).alias("incident_rate"),
    )


def within_calendar(df: DataFrame, day: str, dim_date: DataFrame) -> DataFrame:
    """All rows; a day outside the calendar, which has no gaps, becomes NULL."""
    bounds = dim_date.agg(F.struct(F.min("date").alias("first"), F.max("date").alias("last")).alias("bounds")).scalar()
    return df.withColumn(day, F.when(F.col(day).between(bounds["first"], bounds["last"]), F.col(day)))


def trailing_moveouts(
    fact_leases: DataFrame, dim_date: DataFrame, by: Sequence[str], unit: str = "month"
) -> DataFrame:
    """Distinct residents who moved out in the 90 days up to each report date."""
    reports = report_dates(dim_date, unit)
    return rolling_distinct(fact_leases, "resident_key", "move_out_date", by, "move_outs", reports)


def trailing_average_active(
    fact_residents: DataFrame,
    dim_date: DataFrame,
    by: Sequence[str],
    unit: str = "month",
    days: int = ROLLING_DAYS,
) -> DataFrame:
    """Mean of the active residents over the snapshots in each trailing window, as far as the
    calendar reaches.

    A snapshot without any active resident has no value and does not count; a window without any
    value has no mean. The snapshots are counted first; sums of them run over the days, and the
    window's sum is what has come in less what came in ``days`` before.
    """
    active = within_calendar(fact_residents.filter("status = 'Active'"), "last_date", dim_date)
    per_snapshot = active.filter("last_date IS NOT NULL").groupBy(*by, F.col("last_date").alias("at")).agg(
        F.count_distinct("resident_key").alias("residents")
    )
    entered = F.struct(F.col("at"), F.col("residents"), F.lit(1).alias("snapshots"))
    left = F.struct(F.date_add("at", days).alias("at"), -F.col("residents"), F.lit(-1).alias("snapshots"))
    left = left.cast("struct<at:date,residents:bigint,snapshots:int>")
    changes = per_snapshot.select(*by, F.explode(F.array(entered, left)).alias("c")).select(*by, "c.*")
    groups = fact_residents.select(*by).distinct() if by else fact_residents.sparkSession.range(1).select()
    asked = on_reports(groups, report_dates(dim_date, unit)).select(
        *by, F.col("report_date").alias("at"), F.lit(0).cast("long").alias("residents"), F.lit(0).alias("snapshots")
    )
    per_day = (
        changes.withColumn("asked", F.lit(False))
        .unionByName(asked.withColumn("asked", F.lit(True)))
        .groupBy(*by, "at")
        .agg(F.sum("residents").alias("residents"), F.sum("snapshots").alias("snapshots"), F.max("asked").alias("asked"))
    )
    order = Window.partitionBy(*by).orderBy("at")
    running = per_day.withColumns({
        "residents": F.sum("residents").over(order), "snapshots": F.sum("snapshots").over(order)
    })
    mean = F.when(F.col("snapshots") > 0, divide(F.col("residents"), F.col("snapshots")))
    return running.filter("asked").select(*by, F.col("at").alias("report_date"), mean.alias("average_active"))


def moveout_rate(
    fact_leases: DataFrame, fact_residents: DataFrame, dim_date: DataFrame, by: Sequence[str], unit: str = "month"
) -> DataFrame:
    """Trailing move-outs over the trailing average of active residents."""
    moved = trailing_moveouts(fact_leases, dim_date, by, unit)
    average = trailing_average_active(fact_residents, dim_date, by, unit)
    n = F.coalesce("move_outs", F.lit(0).cast("long"))
    return null_safe_join(moved, average, [*by, "report_date"], "full").select(
        *by,
        "report_date",
        n.alias("move_outs"),
        "average_active",
        divide(n, F.col("average_active")).alias("moveout_rate"),
    )


def occupancy(
    fact_units: DataFrame, fact_leases: DataFrame, by: Sequence[str], unit: str | None = None
) -> DataFrame:
    """Occupied units at the latest snapshot over all units, per group, and per period of the
    snapshots if ``unit`` is given.

    The lease's own group decides, its community is not compared with that of the unit. Leases are
    swept once for all snapshots, however many there are.
    """
    axis = [*by] if unit is None else [*by, "period"]
    period = F.col("snapshot_date") if unit == "day" else F.trunc("snapshot_date", unit or "month")
    units = fact_units if unit is None else fact_units.withColumn("period", period)
    latest = units.groupBy(*axis).agg(
        F.count_distinct("unit_key").alias("total_units"),
        F.max("snapshot_date").alias("snapshot_date"),
    )
    occupied = keys_covered_on(
        fact_leases.select(*by, "unit_key", "move_in_date", "move_out_date"),
        by, "unit_key", "move_in_date", "move_out_date", latest, "snapshot_date", "occupied_units",
    )
    both = null_safe_join(latest, occupied, [*by, "snapshot_date"], "left")
    n = F.coalesce("occupied_units", F.lit(0).cast("long"))
    return both.select(
        *axis,
        "snapshot_date",
        "total_units",
        n.alias("occupied_units"),
        divide(n, F.col("total_units")).alias("occupancy"),
    )


def occupied_units(fact_leases: DataFrame, dim_date: DataFrame, by: Sequence[str]) -> DataFrame:
    """Occupied units per group of the leases on every day of the calendar, zeros included."""
    groups = fact_leases.select(*by).distinct() if by else fact_leases.sparkSession.range(1).select()
    dates = on_reports(groups, report_dates(dim_date))
    return keys_covered_on(
        fact_leases.select(*by, "unit_key", "move_in_date", "move_out_date"),
        by, "unit_key", "move_in_date", "move_out_date", dates, "report_date", "occupied_units",
    )


def lead_conversion(
    fact_leads: DataFrame, dim_date: DataFrame, by: Sequence[str], unit: str = "month"
) -> DataFrame:
    """Rolling 90-day leads, won leads and their ratio, over leads created within the calendar.

    Won leads are counted in the same pass: a won lead is seen under both tags.
    """
    tags = F.when(F.col("status") == "Won", F.array(F.lit("all"), F.lit("won"))).otherwise(
        F.array(F.lit("all"))
    )
    dated = within_calendar(fact_leads, "created_date", dim_date)
    tagged = dated.select(*by, "lead_id", "created_date", F.explode(tags).alias("tag"))
    rolled = rolling_distinct(
        tagged, "lead_id", "created_date", [*by, "tag"], "n", report_dates(dim_date, unit)
    )
    both = rolled.groupBy(*by, "report_date").agg(
        F.sum(F.when(F.col("tag") == "all", F.col("n"))).alias("leads"),
        F.coalesce(F.sum(F.when(F.col("tag") == "won", F.col("n"))), F.lit(0).cast("long")).alias("won_leads"),
    )
    rate = divide(F.col("won_leads"), F.col("leads"))
    return both.withColumn("conversion_rate", rate)
