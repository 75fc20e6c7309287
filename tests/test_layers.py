"""Layers are replaced in one step, whole or by partition, and facts are read by month."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from lakestrata.plans import analysis, measures, months
from lakestrata.sources import layers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "a int")


def test_replacement_and_what_earlier_readers_see(spark, tmp_path):
    path = str(tmp_path / "layer")
    assert layers.read_if_written(spark, path) is None
    layers.write_layer(numbers(spark, [1, 2]), path)
    first = layers.read_layer(spark, path)
    layers.write_layer(numbers(spark, [3]), path)
    second = layers.read_layer(spark, path)
    assert rows(second) == [(3,)]
    # Made before the replacement, read after it.
    assert rows(first) == [(1,), (2,)]
    layers.write_layer(numbers(spark, [4]), path)
    assert rows(second) == [(3,)] and rows(layers.read_layer(spark, path)) == [(4,)]
    assert len(list((tmp_path / "layer").glob(f"{layers.VERSION}=*"))) == layers.KEPT


def test_a_write_that_dies_leaves_the_old_layer(spark, tmp_path):
    path = str(tmp_path / "layer")
    layers.write_layer(numbers(spark, [1, 2]), path)
    before = layers.current(spark, path)
    dying = spark.range(100).repartition(4).select(
        F.when(F.col("id") == 77, F.raise_error("half way")).otherwise(F.col("id")).cast("int").alias("a")
    )
    with pytest.raises(Exception, match="half way"):
        layers.write_layer(dying, path)
    assert layers.current(spark, path) == before
    assert rows(layers.read_layer(spark, path)) == [(1,), (2,)]


def test_of_two_writers_the_second_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "layer")
    layers.write_layer(numbers(spark, [1]), path)
    stale = layers.current(spark, path)
    layers.write_layer(numbers(spark, [2]), path)
    monkeypatch.setattr(layers, "current", lambda *_: stale)
    with pytest.raises(Exception, match="FileAlreadyExists"):
        layers.write_layer(numbers(spark, [3]), path)
    monkeypatch.undo()
    assert rows(layers.read_layer(spark, path)) == [(2,)]


def test_an_empty_layer_keeps_its_columns(spark, tmp_path):
    for name, by in (("whole", []), ("parts", ["month"])):
        path = str(tmp_path / name)
        layers.write_layer(spark.createDataFrame([], "a int, month date"), path, by)
        assert layers.read_layer(spark, path).dtypes == [("a", "int"), ("month", "date")]
        assert rows(layers.read_layer(spark, path)) == []


FACT = "incident_id string, resident_key long, community_key long, incident_date date, severity smallint"


def incidents(spark, path):
    found = [(f"I{m}{n}", n, 1, date(2025, m, n), 1) for m in range(1, 8) for n in range(1, 4)]
    found.append(("I0", 1, 1, None, 1))
    df = spark.createDataFrame(found, FACT).repartition(3)
    months.write_fact(df, "fact_incidents", path)
    return df


def test_a_month_delivered_again_rewrites_its_partition_alone(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = incidents(spark, path)
    before = layers.current(spark, path).folders
    assert len(before) == 8 and rows(months.read_fact(spark, path, "fact_incidents")) == rows(df)
    changed = spark.createDataFrame([("I9", 9, 1, date(2025, 3, 9), 5)], FACT)
    months.write_fact(changed, "fact_incidents", path, ["2025-03-01"])
    after = layers.current(spark, path).folders
    assert {p for p in after if after[p] != before.get(p)} == {"month=2025-03-01"}
    march = months.read_fact(spark, path, "fact_incidents", "2025-03-01", "2025-03-31")
    assert [tuple(r)[0] for r in march.collect()] == ["I9"]
    # A month whose rows are all withdrawn, and the rows without a date.
    months.write_fact(changed.limit(0), "fact_incidents", path, ["2025-03-01", None])
    assert len(layers.current(spark, path).folders) == 6
    with pytest.raises(ValueError, match="not to be replaced"):
        months.write_fact(changed, "fact_incidents", path, ["2025-04-01"])


def test_a_quarter_reads_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "fact")
    incidents(spark, path)
    quarter = months.read_fact(spark, path, "fact_incidents", "2025-02-02", "2025-04-30")
    read = {f.split("month=")[1][:7] for f in quarter.inputFiles()}
    assert read == {"2025-02", "2025-03", "2025-04"}
    assert quarter.count() == 8 and quarter.columns == FACT.replace(",", "").split()[::2]
    assert months.read_fact(spark, path, "fact_incidents", last="2025-01-02").count() == 2


def test_measures_of_a_quarter_equal_those_cut_from_all(spark, tmp_path):
    days = spark.sql("SELECT explode(sequence(DATE'2025-04-01', DATE'2025-06-30')) AS date")
    residents = spark.createDataFrame(
        [(n, 1, "Active", "Memory Care", date(2025, m, 28)) for m in range(1, 8) for n in range(1, 4)],
        "resident_key long, community_key long, status string, care_level string, last_date date",
    )
    months.write_fact(residents, "fact_residents", str(tmp_path / "residents"))
    facts = incidents(spark, str(tmp_path / "fact"))
    bounds = ("2025-04-01", "2025-06-30")
    some = months.read_fact(spark, str(tmp_path / "fact"), "fact_incidents", *bounds)
    here = months.read_fact(spark, str(tmp_path / "residents"), "fact_residents", *bounds)
    community = spark.createDataFrame([(1, "C001")], "community_key long, community_id string")
    inside = F.col("period").between(*bounds)
    whole = measures.incident_rate(facts, residents, days, ["community_key"]).filter(inside)
    assert rows(measures.incident_rate(some, here, days, ["community_key"])) == rows(whole)
    cut = [df.filter(F.col(c).between(*bounds)) for df, c in ((facts, "incident_date"), (residents, "last_date"))]
    assert rows(analysis.incident_rate(some, here, community)) == rows(analysis.incident_rate(*cut, community))
