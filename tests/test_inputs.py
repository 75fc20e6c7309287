"""The extracts made of the given tables."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import inputs as inputs_module
from checks.inputs import RAW, Inputs
from lakestrata.sources import drops

FOLDER = entry.SMOKE_FOLDER

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.mark.parametrize("dataset", ["pcc_residents", "yardi_units"])
def test_every_month_of_the_orders_has_a_snapshot(spark, dataset):
    inputs = Inputs(spark, FOLDER)
    ordered = {r[0] for r in inputs.table("orders").select(F.date_format("o_orderdate", "yyyy_MM")).distinct().collect()}
    files = {r[0] for r in inputs.raw(dataset).select("source_file").distinct().collect()}
    months = {f.removeprefix(f"{dataset}_").removesuffix(".csv") for f in files}
    first, last = min(ordered), max(ordered)
    every = {f"{y}_{m:02d}" for y in range(int(first[:4]), int(last[:4]) + 1) for m in range(1, 13)}
    assert months == {m for m in every if first <= m <= last}


def test_a_trailing_window_averages_several_snapshots(spark):
    """Once residents have moved in, no month end is without an average, and averages are of several months."""
    rows = entry.queries()["m_trailing_avg_active"](spark, FOLDER).collect()
    settled = [r.average_active for r in rows if "1996" <= r.report_date < "2001"]
    assert settled and None not in settled
    assert any(average % 1 for average in settled)


def test_reconciliation_sees_what_the_reader_loses(spark, monkeypatch):
    read = drops.read_dataset

    def losing(spark, dataset, *rest):
        rows = read(spark, dataset, *rest)
        if dataset == "pcc_incidents":
            return rows.filter("severity <> '1'")
        if dataset == "adp_shifts":
            return rows.withColumn(drops.CORRUPT, F.when(F.col("role") == "CNA", "too,long"))
        return rows.drop("mobility_status") if dataset == "pcc_residents" else rows

    monkeypatch.setattr(drops, "read_dataset", losing)
    found = {r.dataset: r for r in entry.queries()["layer_reconciliation"](spark, FOLDER).collect()}
    assert {d for d, r in found.items() if r.row_check == "FAIL"} == {"pcc_incidents", "adp_shifts"}
    assert {d for d, r in found.items() if r.column_check == "FAIL"} == {"pcc_residents"}
    assert {d for d, r in found.items() if r.content_check == "FAIL"} == {"pcc_incidents", "adp_shifts", "pcc_residents"}


@pytest.mark.parametrize("dataset", RAW)
def test_extracts_are_not_dealt_by_file(spark, dataset):
    """A month with most of the rows must not be one task's."""
    plan = Inputs(spark, FOLDER).raw(dataset)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan


def test_snapshots_are_laid_out_by_many_tasks_and_are_the_rows_of_the_sql(spark, tmp_path, monkeypatch):
    """The table is one file of one row group, which one task reads; keys repeat and may be NULL."""
    monkeypatch.setattr(inputs_module, "ROWS_OF_TASK", 10)
    day = "CAST('2024-01-01' AS TIMESTAMP) + make_interval(0, 0, 0, CAST(id AS INT))"
    keys = "CASE WHEN id % 17 = 0 THEN NULL ELSE id % 40 END"
    tables = {
        "orders": f"SELECT id AS o_orderkey, {keys} AS o_custkey, {day} AS o_orderdate FROM range(90)",
        "customer": f"SELECT {keys} AS c_custkey, 'n' || id AS c_name, 'm' AS c_mktsegment, id / 3.0D AS c_acctbal FROM range(60)",
        "part": f"SELECT {keys} AS p_partkey, 'LARGE' AS p_type, id / 7.0D AS p_retailprice FROM range(60)",
    }
    for name, sql in tables.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    inputs = Inputs(spark, str(tmp_path))
    for dataset in inputs_module.SNAPSHOTS:
        rows = inputs.raw(dataset)
        assert rows.rdd.getNumPartitions() >= 6
        expected = inputs._select(inputs_module.raw_sql(dataset, inputs_module.SPARK_MONTHS))
        assert rows.columns == expected.columns
        assert Counter(map(tuple, rows.collect())) == Counter(map(tuple, expected.collect()))


def test_a_fact_of_some_columns_keeps_every_row(spark):
    """Rows are told apart by all cells of an extract, also those which are not asked for."""
    inputs = Inputs(spark, FOLDER)
    whole = inputs.fact("fact_incidents").groupBy("resident_key", "incident_date").count().collect()
    part = inputs.fact("fact_incidents", "resident_key", "incident_date")
    assert part.columns == ["resident_key", "incident_date"]
    assert Counter(part.groupBy("resident_key", "incident_date").count().collect()) == Counter(whole)


@pytest.mark.parametrize("dim, key", [("dim_residents", "resident_id"), ("dim_unit", "unit_id"), ("dim_employee", "employee_id")])
def test_a_dimension_cleanses_its_attributes_once_for_each_id(spark, dim, key, monkeypatch):
    dataset = {"dim_residents": "pcc_residents", "dim_unit": "yardi_units", "dim_employee": "adp_shifts"}[dim]
    attributes = {"dim_residents": ["first_name", "last_name", "dob", "gender"], "dim_unit": ["unit_type"], "dim_employee": ["role"]}[dim]
    seen = []
    first = inputs_module.first_by_key
    monkeypatch.setattr(inputs_module, "first_by_key", lambda rows, *rest: seen.append(rows) or first(rows, *rest))
    inputs = Inputs(spark, FOLDER)
    found = inputs.dim(dim).drop(key.replace("_id", "_key"))
    (rows,) = seen
    raw = inputs.raw(dataset)
    assert not rows.select(*attributes).exceptAll(raw.select(*attributes)).limit(1).count()
    cleansed = inputs.clean(dataset, key, *attributes, "source_file", "row_ordinal")
    wanted = first(cleansed, [key], attributes)
    assert Counter(found.select(*wanted.columns).collect()) == Counter(wanted.collect())


def test_silver_of_some_columns_keeps_every_row(spark, tmp_path):
    """Rows which are equal in the columns asked for and differ in others stay apart; copies go."""
    parts = [(1, "LARGE", 10.0), (1, "LARGE", 20.0), (1, "LARGE", 20.0), (None, "SMALL", 1.0)]
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT id AS o_orderkey, TIMESTAMP '2024-01-05' AS o_orderdate FROM range(1)").write.parquet(f"{tmp_path}/orders.parquet")
    inputs = Inputs(spark, str(tmp_path))
    columns = ["unit_id", "community_id", "snapshot_date"]
    part = inputs.silver("yardi_units", *columns)
    assert part.columns == columns and part.count() == 3
    assert Counter(part.collect()) == Counter(inputs.silver("yardi_units").select(*columns).collect())
    assert "source_file" not in part._jdf.queryExecution().executedPlan().toString()


def test_a_distinct_fact_has_each_of_its_rows_once(spark, tmp_path):
    parts = [(1, "LARGE", 10.0), (1, "LARGE", 20.0), (1, "LARGE", 20.0), (2, "SMALL", 1.0), (None, "SMALL", 1.0)]
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT id AS o_orderkey, id AS o_custkey, TIMESTAMP '2024-01-05' AS o_orderdate FROM range(1)").write.parquet(f"{tmp_path}/orders.parquet")
    rows = Inputs(spark, str(tmp_path)).raw("yardi_units")
    inputs = Inputs(spark, str(tmp_path))
    inputs._built["raw yardi_units"] = rows.unionByName(rows)
    inputs._built["dim_community"] = spark.createDataFrame([("C002", 2), ("C003", 3)], "community_id string, community_key long")
    columns = ["unit_key", "community_key", "snapshot_date"]
    found = inputs.distinct_fact("fact_units", *columns)
    assert found.columns == columns
    assert Counter(found.collect()) == Counter(inputs.fact("fact_units", *columns).distinct().collect())
    assert found.count() == 3 and inputs.fact("fact_units", *columns).count() == 4
    assert "xxhash64" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_reconciliation_keeps_few_datasets_on_disk(spark, monkeypatch):
    """Extracts go once bronze is written, and bronze once its content is taken; settings are as before."""
    from checks import ingest

    left, at_once, write = [], [], ingest.write_layer

    def writing(rows, path, *args, **kwargs):
        done = write(rows, path, *args, **kwargs)
        folder = path.rsplit("/bronze/", 1)[0].removeprefix("file://")
        at_once.append(sum(os.path.isdir(f"{folder}/{kind}/{d}") for kind in ("raw", "bronze") for d in RAW))
        left.append(folder)
        return done

    monkeypatch.setattr(ingest, "write_layer", writing)
    settings = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in settings]
    found = entry.queries()["layer_reconciliation"](spark, FOLDER).collect()
    assert {r.dataset for r in found} == set(RAW) and {r.content_check for r in found} == {"PASS"}
    assert len(at_once) == len(RAW) and max(at_once) <= 4
    assert not any(os.path.exists(folder) for folder in left)
    assert [spark.conf.get(name) for name in settings] == before
