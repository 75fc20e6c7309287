"""What the physical plans must not contain."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import joins, windows
from lakestrata.operators.dedupe import keep_first
from lakestrata.operators.occupancy import covered_points, keys_covered_on
from lakestrata.plans import analysis, gold
from lakestrata.session import materialise, new_shared_path, scratch, shared_folder

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "SinglePartition")


def plan_of(df):
    """The physical plan without its scalar subqueries, which are one small row each."""
    kept, within = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if within is not None and depth > within:
            continue
        within = depth if line.lstrip(" :+-").startswith(("Subquery", "ReusedSubquery")) else None
        if within is None:
            kept.append(line)
    return "\n".join(kept)


@pytest.fixture
def tables(spark):
    n = spark.range(1000)
    day = F.date_add(F.lit(date(2025, 1, 1)), (F.col("id") % 100).cast("int"))
    units = n.select((F.col("id") % 50).alias("unit_key"), (F.col("id") % 5).alias("community_key"), day.alias("snapshot_date"))
    leases = n.select(
        "id", (F.col("id") % 50).alias("unit_key"), (F.col("id") % 5).alias("community_key"),
        day.alias("move_in_date"), F.date_add(day, 30).alias("move_out_date"),
        F.lit("x").alias("move_out_reason"), F.col("id").cast("string").alias("lease_id"),
    )
    dim = spark.range(5).select(F.col("id").alias("community_key"), F.concat(F.lit("C"), "id").alias("community_id"))
    return units, leases, dim


def test_no_pairs_and_no_single_partition(spark, no_broadcast, tables):
    units, leases, dim = tables
    on = ["unit_key", "community_key"]
    days = spark.createDataFrame([(date(2025, 1, 31),)], "date date")
    plans = [
        plan_of(covered_points(units, leases, on, "snapshot_date", "move_in_date", "move_out_date")),
        plan_of(joins.interval_join(units, leases, on, "snapshot_date", "move_in_date", "move_out_date")),
        plan_of(windows.rolling_distinct(leases, "id", "move_in_date", ["community_key"], "n", windows.report_dates(days))),
        plan_of(keep_first(leases, on, ["lease_id"])),
        plan_of(analysis.top_moveout_reasons(leases, dim).drop("x")),
    ]
    for plan in plans:
        for node in FORBIDDEN:
            assert node not in plan, plan


def test_lookups_scan_the_source_and_each_dimension_once(spark, no_broadcast, tmp_path):
    """A fact with three lookups: one scan of the source, one of each dimension's table and one
    for the offsets of its keys; nothing is read again for the next lookup."""
    leases = spark.range(100).select(
        F.col("id").cast("string").alias("lease_id"), *[(F.col("id") % 7).cast("string").alias(c) for c in ("resident_id", "community_id", "unit_id")],
        F.lit("2025-01-01").cast("date").alias("move_in_date"), F.lit(None).cast("date").alias("move_out_date"),
        F.lit("x").alias("move_out_reason"), F.lit("1").alias("monthly_rate"),
    )
    dims = {}
    for dim, id_column, key_column in gold.FACT_SOURCES["fact_leases"][1]:
        stored = materialise(leases.select(id_column).distinct().withColumn(key_column, F.lit(1).cast("long")), dim)
        dims[dim] = stored
    plan = plan_of(gold.fact("fact_leases", materialise(leases, "leases"), dims))
    assert plan.count("FileScan parquet") == 1 + len(dims)
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == len(dims) and "BroadcastExchange" not in plan


def test_interval_join_reads_each_side_once(spark, no_broadcast, tables):
    units, leases, _ = tables
    on = ["unit_key", "community_key"]
    points, intervals = materialise(units, "units"), materialise(leases.drop("id"), "leases")
    plan = plan_of(joins.interval_join(points, intervals, on, "snapshot_date", "move_in_date", "move_out_date"))
    assert plan.count("FileScan parquet") == 2 and plan.count("Generate explode") == 1


def test_duplicates_are_shuffled_and_sorted_by_hashes(spark, tables):
    plan = plan_of(keep_first(tables[1], ["unit_key", "move_out_reason"], ["lease_id"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
    assert all("move_out_reason" not in line for line in plan.splitlines() if "Sort [" in line)


def test_scratch_tables_end_with_their_block(spark):
    with scratch(spark):
        table = materialise(spark.range(3).toDF("x"), "short")
        file = table.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(file) and table.count() == 3
    assert not os.path.exists(file)


def test_top_k_limits_groups_before_the_shuffle(spark, tables):
    counts = tables[1].select("community_key", "lease_id", "id")
    assert "WindowGroupLimit" in plan_of(windows.top_k(counts, ["community_key"], [F.desc("id")], 3))


def test_a_fact_reader_reads_its_columns_only(spark, tables):
    path = new_shared_path(spark, "leases")
    tables[1].write.parquet(path)
    read = spark.read.parquet(path)
    counts = analysis.moveout_reasons(read, "2025-01-01", "2025-07-01")
    plan = plan_of(counts)
    assert "ReadSchema: struct<community_key:bigint,move_out_date:date,move_out_reason:string,lease_id:string>" in plan or (
        "unit_key" not in plan.split("ReadSchema")[1] and "move_in_date" not in plan.split("ReadSchema")[1]
    )
    assert "GreaterThanOrEqual(move_out_date" in plan


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == configured.rstrip("/")
    assert new_shared_path(spark, "a").startswith(shared_folder(spark))


def test_sweeps_gather_intervals_and_points_once(spark, tables):
    """One shuffle by key, of an interval as one row; the second sweep adds up its turns per group."""
    units, leases, _ = tables
    on, dates = ["unit_key", "community_key"], ("move_in_date", "move_out_date")
    plan = plan_of(covered_points(units, leases, on, "snapshot_date", *dates))
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan.split("Exchange")[1]
    asked = units.select("community_key", "snapshot_date")
    plan = plan_of(keys_covered_on(leases, ["community_key"], "unit_key", *dates, asked, "snapshot_date", "n"))
    by_unit = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "unit_key" in line]
    assert len(by_unit) == 1
