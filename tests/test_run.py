"""Extracts with all their oddities, and one whole run from extracts to measures."""

from __future__ import annotations

import csv
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakestrata.plans import analysis, measures, months, run
from lakestrata.schemas import DATASETS
from lakestrata.sources import drops, layers


def read(spark, folder, name="shop_items", multiline=False):
    paths = drops.discover(spark, str(folder))[name]
    return drops.read_dataset(spark, name, paths, str(folder), "batch", "now", multiline)


def test_discover_groups_months_and_sorts(spark, tmp_path):
    for name in ("b/units_2025_02.csv", "units_2025_01.csv", "lookup.csv", "a_2025_1.csv", "notes.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("id\n1\n")
    found = drops.discover(spark, str(tmp_path))
    assert {d: [p.rsplit("/", 1)[1] for p in ps] for d, ps in found.items()} == {
        "a_2025_1": ["a_2025_1.csv"],
        "lookup": ["lookup.csv"],
        "units": ["units_2025_02.csv", "units_2025_01.csv"],
    }


def test_text_scan(spark, tmp_path):
    lines = ["id,name,note", '1,"a, b",x', "2,,", "3", '4,"say ""hi""",007', "5,p,q,r", "6,p,q,", "", "7, pad ,N/A"]
    (tmp_path / "shop_items_2025_01.csv").write_text("\ufeff" + "\n".join(lines) + "\n", encoding="utf-8")
    rows = read(spark, tmp_path)
    assert rows.columns[:3] == ["id", "name", "note"]
    good = rows.filter(F.col(drops.CORRUPT).isNull())
    assert [tuple(r)[:3] for r in good.orderBy("row_ordinal").collect()] == [
        ("1", "a, b", "x"), ("2", "", ""), ("3", "", ""), ("4", 'say "hi"', "007"), ("7", " pad ", "N/A")
    ]
    bad = rows.filter(F.col(drops.CORRUPT).isNotNull())
    assert sorted(r[drops.CORRUPT] for r in bad.collect()) == ["5,p,q,r", "6,p,q,"]


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "shop_items_2025_01.csv").write_text('id,note\n1,"two\nlines"\n2,x\n')
    rows = read(spark, tmp_path, multiline=True).orderBy("id").collect()
    assert [(r.id, r.note) for r in rows] == [("1", "two\nlines"), ("2", "x")]


def test_differing_headers_are_joined_by_name(spark, tmp_path):
    (tmp_path / "shop_items_2025_01.csv").write_text("id,name\n1,a\n")
    (tmp_path / "shop_items_2025_02.csv").write_text("id,extra,name\n2,e,b\n")
    rows = read(spark, tmp_path)
    assert rows.columns[:3] == ["id", "name", "extra"]
    found = sorted(tuple(r)[:3] for r in rows.collect())
    assert found == [("1", "a", None), ("2", "b", "e")]
    lineage = rows.orderBy("id").select("source_file", "source_system", "batch_id", "ingestion_timestamp").collect()
    assert [tuple(r) for r in lineage] == [
        ("shop_items_2025_01.csv", "shop", "batch", "now"), ("shop_items_2025_02.csv", "shop", "batch", "now")
    ]
    # Each hash covers the columns of its own file.
    assert rows.select("row_hash").distinct().count() == 2


def test_metadata_names_are_refused(spark, tmp_path):
    (tmp_path / "shop_items_2025_01.csv").write_text("id,row_hash\n1,a\n")
    with pytest.raises(ValueError, match="row_hash"):
        read(spark, tmp_path)
    (tmp_path / "shop_empty_2025_01.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read(spark, tmp_path, "shop_empty")


MONTHS = ("01", "02", "03")


def extracts(folder):
    """Three months of all eight datasets, small enough to know every answer."""

    def put(dataset, month, rows):
        with open(folder / f"{dataset}_2025_{month}.csv", "w", newline="") as f:
            csv.writer(f).writerows([DATASETS[dataset], *rows])

    for month in MONTHS:
        units = [(f"U{n}", "C001" if n < 3 else "C002", "AL", "4000", f"2025-{month}-01") for n in range(1, 5)]
        put("yardi_units", month, units)
        residents = [
            ("R1", "C001", "Ann", "A", "1940-01-02", "F", "2024-01-01", "", "AL", "1.5", "Cane"),
            ("R2", "C001", "Bob", "B", "03/04/1941", "M", "01/05/2025", "02/10/2025", " assisted ", "2", "N/A"),
            ("R3", "C002", "Cy", "C", "", "null", "2025-03-02", "", "MC", "x", ""),
        ]
        put("pcc_residents", month, residents)
        put("pcc_care_history", month, [("R1", f"2025-{month}-05", "", "AL", "Admission")])
        put("adp_shifts", month, [
            (f"S{month}1", "E00001", "C001", "CNA", f"2025-{month}-03", "8.5", "{'CNA': 18.5, 'RN': 42}"),
            (f"S{month}2", "E00002", "C002", "Cook", f"{month}/04/2025", "8", "{'CNA': 18.5}"),
        ])
        put("gbp_reviews", month, [(f"G{month}", "C001", f"2025-{month}-07", "4", "Good, really", "", "")])
    lease = ("L1", "R1", "U1", "C001", "2024-01-01", "", "", "5000")
    put("yardi_leases", "01", [lease, ("L2", "R2", "U2", "C001", "2025-01-05", "2025-02-10", "Financial", "5000")])
    put("yardi_leases", "02", [lease, ("L3", "R3", "U3", "C002", "2025-03-02", "", "", "")])
    put("pcc_incidents", "01", [("I1", "R1", "C001", "2025-01-20", "Fall", "2", "E1")])
    put("pcc_incidents", "02", [("I2", "R2", "C001", "2025-02-01", " Fall", "9", "E1"), ("I3", "N/A", "C001", "bad", "NULL", "1", "E1")])
    put("hubspot_leads", "01", [
        ("H1", "C001", "Web", "2025-01-10", "", "2025-01-20", "2025-01-15", "Won", ""),
        ("H2", "C002", "Web", "2025-01-31", "", "", "", "Lost", "Price"),
        ("H1", "C002", "Web", "2025-02-01", "", "", "", "Open", " "),
    ])


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), str(tmp_path_factory.mktemp("out"))
    extracts(raw)
    return out, {name: report.collect() for name, report in run.run(spark, str(raw), out).items()}


def gold(spark, out, name):
    return stored(spark, out[0], name)


def stored(spark, folder, name):
    if name.startswith("dim"):
        return layers.read_layer(spark, f"{folder}/gold/dim/{name}")
    return months.read_fact(spark, f"{folder}/gold/fact/{name}", name)


def test_reports(spark, out):
    reports = out[1]
    assert {r.row_check for r in reports["reconciliation"]} == {"PASS"}
    assert {r.column_check for r in reports["reconciliation"]} == {"PASS"}
    assert len(reports["reconciliation"]) == 8
    counters = {(r.dataset, r.counter): r.value for r in reports["counters"]}
    assert counters["yardi_leases", "duplicates_removed"] == 1
    assert counters["pcc_residents", "discharge_date_ok"] == 3
    assert counters["pcc_residents", "discharge_date_blank"] == 6
    assert counters["pcc_incidents", "incident_date_invalid"] == 1
    assert counters["adp_shifts", "rate_found"] == 3
    broken = {(r.table, r.rule): r.violations for r in reports["rules"] if r.violations}
    assert broken["fact_hubspot_leads", "unique (lead_id)"] == 1
    assert broken["fact_incidents", "severity out of range"] == 1
    assert broken["fact_adp_shifts", "total_labor_cost is null"] == 3
    assert broken["fact_incidents", "resident_key is null"] == 1
    assert broken["pcc_residents", "acuity_score is no decimal(8,2)"] == 3
    assert broken["fact_residents", "admit_date in dimension"] == 3


def test_rows_that_break_rules_are_set_apart(spark, out):
    leads = layers.read_layer(spark, f"{out[0]}/quarantine/fact_hubspot_leads")
    assert sorted((r.lead_id, r.broken_rules) for r in leads.collect()) == [("H1", ["unique (lead_id)"])] * 2
    incidents = {r.incident_id: r.broken_rules for r in layers.read_layer(spark, f"{out[0]}/quarantine/fact_incidents").collect()}
    assert incidents["I2"] == ["severity out of range"]
    assert "resident_key is null" in incidents["I3"] and "I1" not in incidents
    counted = {(r.table, r.rule): r.violations for r in out[1]["rules"]}
    shifts = layers.read_layer(spark, f"{out[0]}/quarantine/fact_adp_shifts")
    assert shifts.count() == counted["fact_adp_shifts", "total_labor_cost is null"]


def test_facts(spark, out):
    shifts = gold(spark, out, "fact_adp_shifts").orderBy("shift_id").collect()
    assert [float(r.total_labor_cost) if r.total_labor_cost else None for r in shifts] == [157.25, None] * 3
    residents = gold(spark, out, "fact_residents")
    assert residents.count() == 9
    status = {(r.resident_key, r.last_date.month): r.status for r in residents.collect()}
    assert [status[2, m] for m in (1, 2, 3)] == ["Active", "Active", "Not Active"]
    assert [status[3, m] for m in (1, 2, 3)] == ["Not Active", "Not Active", "Active"]
    assert gold(spark, out, "dim_date").count() == 181
    assert {r.community_id: r.community_key for r in gold(spark, out, "dim_community").collect()} == {"C001": 1, "C002": 2}


def test_analysis(spark, out):
    community = gold(spark, out, "dim_community")
    occupancy = analysis.occupancy_by_community(gold(spark, out, "fact_units"), gold(spark, out, "fact_leases"), community)
    found = {(r.community_id, r.snapshot_date.month): (r.occupied_units, r.total_units, r.occupancy_rate_percent) for r in occupancy.collect()}
    assert found == {
        ("C001", 1): (1, 2, 50.0), ("C001", 2): (2, 2, 100.0), ("C001", 3): (1, 2, 50.0),
        ("C002", 1): (0, 2, 0.0), ("C002", 2): (0, 2, 0.0), ("C002", 3): (0, 2, 0.0),
    }
    reasons = analysis.top_moveout_reasons(gold(spark, out, "fact_leases"), community)
    assert [tuple(r) for r in reasons.collect()] == [("C001", "Financial", 1, 100.0)]
    rate = analysis.incident_rate(gold(spark, out, "fact_incidents"), gold(spark, out, "fact_residents"), community)
    assert [tuple(r) for r in rate.collect()] == [
        ("C001", "Assisted Living", 2, 31 * 2 + 28 * 2 + 31, 1.34), ("C002", "Memory Care", 0, 31, 0.0)
    ]


def test_measures(spark, out):
    days = gold(spark, out, "dim_date")
    leads = measures.lead_conversion(gold(spark, out, "fact_hubspot_leads"), days, [])
    found = {r.report_date: (r.leads, r.won_leads, r.conversion_rate) for r in leads.collect()}
    assert found[date(2025, 1, 31)] == (2, 1, 0.5)
    assert found[date(2025, 4, 30)] == (2, 0, 0.0)
    assert max(found) == date(2025, 6, 30) and found[date(2025, 6, 30)] == (0, 0, 0.0)
    whole = measures.occupancy(gold(spark, out, "fact_units"), gold(spark, out, "fact_leases"), [])
    assert tuple(whole.first())[1:] == (4, 1, 0.25)
    monthly = measures.occupancy(gold(spark, out, "fact_units"), gold(spark, out, "fact_leases"), [], "month")
    assert {r.period.month: r.occupied_units for r in monthly.collect()} == {1: 1, 2: 2, 3: 1}
    moved = measures.moveout_rate(gold(spark, out, "fact_leases"), gold(spark, out, "fact_residents"), days, [])
    march = {r.report_date: r for r in moved.collect()}[date(2025, 3, 31)]
    assert (march.move_outs, march.average_active) == (1, 2.0)
    rate = measures.incident_rate(
        gold(spark, out, "fact_incidents"), gold(spark, out, "fact_residents"), days, [], "quarter"
    )
    quarter = {r.period: r for r in rate.collect()}[date(2025, 1, 1)]
    assert (quarter.total_incidents, quarter.resident_days) == (2, 3 * 90)


def test_measures_outside_the_calendar(spark):
    """Windows end at the calendar, periods it lacks are reported with no days, and rows without
    a group are one group."""
    days = spark.createDataFrame([(date(2025, 2, n),) for n in range(1, 29)], "date date")
    residents = spark.createDataFrame(
        [(1, None, "Active", date(2025, 1, 31)), (2, None, "Active", date(2025, 2, 28)), (3, None, "Active", date(2025, 2, 28))],
        "resident_key long, community_key long, status string, last_date date",
    )
    incidents = spark.createDataFrame([("I1", None, date(2025, 2, 3))], "incident_id string, community_key long, incident_date date")
    rate = {r.period: tuple(r) for r in measures.incident_rate(incidents, residents, days, ["community_key"]).collect()}
    assert rate == {
        date(2025, 1, 1): (None, date(2025, 1, 1), 0, 0, 0.0),
        date(2025, 2, 1): (None, date(2025, 2, 1), 1, 56, 1 / 56 * 100),
    }
    mean = measures.trailing_average_active(residents, days, ["community_key"])
    assert [tuple(r) for r in mean.collect()] == [(None, date(2025, 2, 28), 2.0)]
    leads = spark.createDataFrame([("H1", date(2020, 3, 5), "Won"), ("H2", date(2025, 2, 1), "Open")], "lead_id string, created_date date, status string")
    assert [tuple(r) for r in measures.lead_conversion(leads, days, []).collect()] == [(date(2025, 2, 28), 1, 0, 0.0)]


def test_calendar_bounds_of_a_run(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    extracts(raw)
    reports = run.run(spark, str(raw), str(tmp_path / "out"), first="2025-01-01", last="2025-12-31")
    assert layers.read_layer(spark, f"{tmp_path}/out/gold/dim/dim_date").count() == 365
    assert layers.read_layer(spark, f"{tmp_path}/out/reports/rules").count() == reports["rules"].count()


def test_names_spark_would_not_read_are_refused(spark, tmp_path):
    for name in ("_x_2025_01.csv", "x[1]_2025_01.csv"):
        folder = tmp_path / str(len(name))
        folder.mkdir()
        (folder / name).write_text("id\n1\n")
        with pytest.raises(ValueError, match="Spark skips|pattern"):
            drops.discover(spark, str(folder))


def test_source_file_keeps_plus_and_blank(spark, tmp_path):
    for name in ("a+b_2025_01.csv", "a b_2025_02.csv", "a%41_2025_03.csv"):
        (tmp_path / name).write_text("id\n1\n")
    paths = [p for found in drops.discover(spark, str(tmp_path)).values() for p in found]
    rows = drops.read_dataset(spark, "a", paths, str(tmp_path), "batch", "now")
    assert sorted(r.source_file for r in rows.collect()) == ["a b_2025_02.csv", "a%41_2025_03.csv", "a+b_2025_01.csv"]


def test_a_second_run_gives_the_same_gold(spark, out, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    extracts(raw)
    run.run(spark, str(raw), str(tmp_path / "out"))
    for name in ("fact_leases", "fact_residents", "dim_residents"):
        again = stored(spark, str(tmp_path / "out"), name)
        assert sorted(map(repr, again.collect())) == sorted(map(repr, gold(spark, out, name).collect()))


def test_keys_and_months_of_a_later_run(spark, tmp_path):
    """A run into the same folder after an id came and one went, and one month delivered again."""
    raw, folder = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    extracts(raw)
    run.run(spark, str(raw), folder)
    before = {r.resident_id: r.resident_key for r in stored(spark, folder, "dim_residents").collect()}
    path = raw / "pcc_residents_2025_03.csv"
    path.write_text(path.read_text().replace("R2", "R0"))
    for month in ("01", "02"):
        other = raw / f"pcc_residents_2025_{month}.csv"
        other.write_text("".join(line for line in other.read_text().splitlines(True) if not line.startswith("R2")))
    run.run(spark, str(raw), folder)
    after = {r.resident_id: r.resident_key for r in stored(spark, folder, "dim_residents").collect()}
    assert after == {**before, "R0": 4}
    fact = f"{folder}/gold/fact/fact_residents"
    folders = layers.current(spark, fact).folders
    months.redeliver(spark, folder, "fact_residents", ["2025-02-01"])
    again = layers.current(spark, fact).folders
    assert {p for p in again if again[p] != folders[p]} == {"month=2025-02-01"}
    february = months.read_fact(spark, fact, "fact_residents", "2025-02-01", "2025-02-28")
    assert sorted(r.resident_key for r in february.collect()) == [1, 3]


def test_only_new_and_changed_extracts_are_parsed(spark, tmp_path, monkeypatch):
    raw, folder = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    extracts(raw)
    run.run_bronze(spark, str(raw), folder)
    parsed = []
    read = drops.read_dataset
    monkeypatch.setattr(drops, "read_dataset", lambda s, d, paths, *rest: parsed.append([p.rsplit("/", 1)[1] for p in paths]) or read(s, d, paths, *rest))
    before = {(r.extract, r.batch_id) for r in layers.read_layer(spark, f"{folder}/bronze/yardi_units").collect()}
    report = {r.dataset: r for r in run.run_bronze(spark, str(raw), folder).collect()}
    assert parsed == [] and {r.row_check for r in report.values()} == {"PASS"}

    (raw / "yardi_units_2025_02.csv").unlink()
    (raw / "yardi_units_2025_03.csv").write_text("unit_id,community_id,colour\nU9,C001,red\nU8,C001,blue\n")
    (raw / "pcc_incidents_2025_04.csv").write_text((raw / "pcc_incidents_2025_01.csv").read_text())
    report = {r.dataset: r for r in run.run_bronze(spark, str(raw), folder).collect()}
    assert parsed == [["pcc_incidents_2025_04.csv"], ["yardi_units_2025_03.csv"]]
    assert {(r.row_check, r.column_check) for r in report.values()} == {("PASS", "PASS")}
    assert (report["yardi_units"].raw_rows, report["pcc_incidents"].raw_rows) == (6, 4)
    units = layers.read_layer(spark, f"{folder}/bronze/yardi_units")
    assert {r.extract: r.n for r in units.groupBy("extract").agg(F.count("*").alias("n")).collect()} == {
        "yardi_units_2025_01.csv": 4, "yardi_units_2025_03.csv": 2
    }
    # What stayed keeps its lineage, and columns of either delivery are there.
    assert {(r.extract, r.batch_id) for r in units.collect()} & before == {b for b in before if "2025_01" in b[0]}
    assert {r.colour for r in units.collect()} == {None, "red", "blue"}
    assert run.bronze(spark, folder, "yardi_units").count() == 6


def test_audit_of_bronze_finds_a_changed_cell(spark, tmp_path):
    raw, folder = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    extracts(raw)
    run.run_bronze(spark, str(raw), folder)
    assert {r.content_check for r in run.audit_bronze(spark, str(raw), folder).collect()} == {"PASS"}
    path = raw / "gbp_reviews_2025_01.csv"
    path.write_text(path.read_text().replace(",4,", ",5,"))
    checks = {r.dataset: r.content_check for r in run.audit_bronze(spark, str(raw), folder).collect()}
    assert checks.pop("gbp_reviews") == "FAIL" and set(checks.values()) == {"PASS"}


def test_publish(spark, out, tmp_path):
    fact = gold(spark, out, "fact_care_history")
    layers.publish(fact, "fact_care_history", "admin", str(tmp_path / "care"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "care")).collect()]
    assert len(lines) == 3 and set(lines[0]) == set(fact.columns) and lines[0]["previous_level"] is None
    with pytest.raises(PermissionError):
        layers.publish(fact, "fact_care_history", "staff", str(tmp_path / "x"))


def test_run_without_extracts(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run.run(spark, str(tmp_path), str(tmp_path / "out"))
