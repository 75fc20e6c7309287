"""The three analysis queries on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.numbers import percent
from lakestrata.operators.joins import month_aligned_join
from lakestrata.operators.occupancy import covered_points
from lakestrata.operators.windows import share_of_total, top_k


def occupancy_by_community(
    fact_units: DataFrame, fact_leases: DataFrame, dim_community: DataFrame
) -> DataFrame:
    """Units and occupied units per community and snapshot.

    A unit is occupied when one of its leases in the same community covers the snapshot date.
    Each unit is one row by then, so plain counts replace two distinct counts.
    """
    on = ["unit_key", "community_key"]
    units = covered_points(
        fact_units, fact_leases, on, "snapshot_date", "move_in_date", "move_out_date"
    )
    per_community = units.groupBy("community_key", "snapshot_date").agg(
        F.count("unit_key").alias("total_units"),
        F.count(F.when(F.col("is_covered"), F.col("unit_key"))).alias("occupied_units"),
    )
    return (
        per_community.join(dim_community, "community_key")
        .select(
            "community_id",
            "snapshot_date",
            "total_units",
            "occupied_units",
            percent(F.col("occupied_units"), F.col("total_units")).alias("occupancy_rate_percent"),
        )
        .orderBy("snapshot_date", "community_id")
    )


def moveout_reasons(fact_leases: DataFrame, first: str, before: str) -> DataFrame:
    """Distinct leases per community and stated reason, of the move-outs in a period."""
    moved = fact_leases.filter(
        (F.col("move_out_date") >= F.lit(first).cast("date"))
        & (F.col("move_out_date") < F.lit(before).cast("date"))
        & (F.col("move_out_reason") != "N/A")
    )
    return moved.groupBy("community_key", "move_out_reason").agg(
        F.count_distinct("lease_id").alias("move_outs")
    )


def top_moveout_reasons(
    fact_leases: DataFrame,
    dim_community: DataFrame,
    first: str = "2025-01-01",
    before: str = "2025-07-01",
    k: int = 3,
) -> DataFrame:
    """The most frequent move-out reasons per community, each with its share of all of them."""
    counts = moveout_reasons(fact_leases, first, before)
    shares = share_of_total(counts, ["community_key"], "move_outs", "move_out_percentage")
    ranked = top_k(shares, ["community_key"], [F.desc("move_outs"), F.asc("move_out_reason")], k)
    return (
        ranked.join(dim_community, "community_key")
        .orderBy("community_id", "rank")
        .select("community_id", "move_out_reason", "move_outs", "move_out_percentage")
    )


def resident_days(fact_residents: DataFrame) -> DataFrame:
    """Active residents of each monthly snapshot times the days of that month, summed."""
    monthly = (
        fact_residents.filter("status = 'Active'")
        .groupBy("community_key", "care_level", "last_date")
        .agg(F.count_distinct("resident_key").alias("residents"))
    )
    days = F.col("residents") * F.day("last_date")
    return monthly.groupBy("community_key", "care_level").agg(
        F.sum(days).alias("total_resident_days")
    )


def incidents_by_care_level(fact_incidents: DataFrame, fact_residents: DataFrame) -> DataFrame:
    """Distinct incidents per community and the care level of the snapshot in their month.

    Both sides are reduced to the distinct rows the count needs before they meet.
    """
    keys = ["resident_key", "community_key"]
    month: Column = F.trunc("incident_date", "MM").alias("incident_date")
    incidents = fact_incidents.select("incident_id", *keys, month).distinct()
    levels = fact_residents.select(*keys, F.trunc("last_date", "MM").alias("last_date"), "care_level")
    joined = month_aligned_join(incidents, levels.distinct(), keys, "incident_date", "last_date")
    return joined.groupBy("community_key", "care_level").agg(
        F.count_distinct("incident_id").alias("total_incidents")
    )


def incident_rate(
    fact_incidents: DataFrame, fact_residents: DataFrame, dim_community: DataFrame
) -> DataFrame:
    """Incidents per 100 resident-days by community and care level."""
    days = resident_days(fact_residents)
    incidents = incidents_by_care_level(fact_incidents, fact_residents)
    n = F.coalesce("total_incidents", F.lit(0))
    return (
        days.join(dim_community, "community_key")
        .join(incidents, ["community_key", "care_level"], "left")
        .select(
            "community_id",
            "care_level",
            n.alias("total_incidents"),
            "total_resident_days",
            percent(n, F.col("total_resident_days")).alias("incidents_per_100_resident_days"),
        )
        .orderBy("community_id", "care_level")
    )
