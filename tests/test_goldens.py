"""The published figures of the data, on generated extracts of the same shape.

346 lease rows of which 302 remain; 915 units of which 30 to 191 are occupied at the six monthly
snapshots; 37 reasons with 64 move-outs; 391 and 438 leads with 69 and 87 won in the two 90-day
windows; 34 move-ins before the deposit; dates beyond the calendar.
"""

from __future__ import annotations

import csv
from datetime import date, timedelta

import pytest

from lakestrata.operators import quality
from lakestrata.plans import analysis, measures, run
from lakestrata.schemas import DATASETS

OCCUPIED = (30, 64, 112, 139, 176, 191)
COMMUNITIES = [f"C{n:03d}" for n in range(1, 15)]
REASONS = ("Financial", "Other", "Family Decision")


def community_of(unit: int) -> str:
    return COMMUNITIES[unit % 14]


def lease(number: int, unit: int, start: date, end: date | None = None, reason: str = "") -> tuple:
    return (f"L{number}", f"R{number}", f"U{unit}", community_of(unit), start.isoformat(), end.isoformat() if end else "", reason, "4000")


def leases() -> list[list[tuple]]:
    """Six files; 191 units fill up over the months, 64 leases lie between two snapshots, 47 are
    second leases of occupied units. 31 of the first begin before the calendar."""
    found, unit = [], 0
    for month, upto in enumerate(OCCUPIED, 1):
        for unit in range(unit, upto):
            start = date(2024, 6, 1) if month == 1 else date(2025, month, 1)
            found.append(lease(len(found), unit, start))
        unit = upto
    pairs = [(c, r) for r in REASONS for c in range(14)][:37]
    for n in range(64):
        c, reason = pairs[n % 37]
        found.append(lease(len(found), 500 + c - 500 % 14 + 14, date(2025, 1, 5), date(2025, 1, 20), reason))
    for n in range(47):
        found.append(lease(len(found), n, date(2024, 12, 31) if n == 0 else date(2025, 5, 30)))
    assert len(found) == 302
    files = [found[i::6] for i in range(6)]
    files[5] += [row for file in files[:5] for row in file][:44]
    return files


def leads() -> list[tuple]:
    """91 leads in March, 300 in both windows, 138 in June; the last ones reach beyond June."""
    found = []
    for n, (first, size, won) in enumerate([(date(2025, 3, 3), 91, 19), (date(2025, 4, 2), 300, 50), (date(2025, 6, 1), 138, 37)]):
        for i in range(size):
            created = first + timedelta(i % 30)
            late = n == 2
            tour = date(2025, 7, 2) if late and i < 37 else created
            deposit = date(2025, 7, 10) if late and i < 34 else created
            # Those with a deposit in July move in before it, others after.
            move_in = date(2025, 7, 5) if late and i < 34 else date(2025, 7, 20) if late and i < 44 else created
            found.append((f"H{n}-{i}", COMMUNITIES[i % 14], "Web", *(d.isoformat() for d in (created, tour, deposit, move_in)), "Won" if i < won else "Open", ""))
    return found


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), str(tmp_path_factory.mktemp("out"))

    def put(dataset: str, month: int, rows: list[tuple]) -> None:
        with open(raw / f"{dataset}_2025_{month:02d}.csv", "w", newline="") as file:
            csv.writer(file).writerows([DATASETS[dataset], *rows])

    for month, rows in enumerate(leases(), 1):
        put("yardi_leases", month, rows)
        put("yardi_units", month, [(f"U{u}", community_of(u), "AL", "4000", f"2025-{month:02d}-01") for u in range(915)])
    put("hubspot_leads", 6, leads())
    put("gbp_reviews", 6, [(f"G{i}", "C001", "2025-06-20", "4", "good", "thanks", "2025-07-03" if i < 11 else "") for i in range(40)])
    reports = run.run(spark, str(raw), out)
    return out, {name: report.collect() for name, report in reports.items()}


def gold(spark, out, name):
    return spark.read.parquet(f"{out[0]}/gold/{'dim' if name.startswith('dim') else 'fact'}/{name}")


def test_leases_before_and_after_duplicates(out):
    counters = {(r.dataset, r.counter): r.value for r in out[1]["counters"]}
    assert counters["yardi_leases", "rows_read"] == 346
    assert counters["yardi_leases", "rows_written"] == 302
    assert counters["yardi_leases", "duplicates_removed"] == 44


def test_occupancy(spark, out):
    units, leases_, community = (gold(spark, out, n) for n in ("fact_units", "fact_leases", "dim_community"))
    rows = analysis.occupancy_by_community(units, leases_, community).collect()
    assert len(rows) == 6 * 14
    for month, occupied in enumerate(OCCUPIED, 1):
        own = [r for r in rows if r.snapshot_date.month == month]
        assert (sum(r.occupied_units for r in own), sum(r.total_units for r in own)) == (occupied, 915)
    june = measures.occupancy(units, leases_, []).first()
    assert (june.occupied_units, june.total_units, round(100 * june.occupancy, 2)) == (191, 915, 20.87)


def test_moveout_reasons(spark, out):
    rows = analysis.top_moveout_reasons(gold(spark, out, "fact_leases"), gold(spark, out, "dim_community")).collect()
    assert (len(rows), sum(r.move_outs for r in rows)) == (37, 64)


def test_rolling_leads(spark, out):
    rows = measures.lead_conversion(gold(spark, out, "fact_hubspot_leads"), gold(spark, out, "dim_date"), []).collect()
    found = {r.report_date: (r.leads, r.won_leads, round(100 * r.conversion_rate, 2)) for r in rows}
    assert found[date(2025, 5, 31)] == (391, 69, 17.65)
    assert found[date(2025, 6, 30)] == (438, 87, 19.86)
    assert len(found) == 6 and found[date(2025, 1, 31)] == (0, 0, 0.0)


def test_rules(spark, out):
    broken = {(r.table, r.rule): r.violations for r in out[1]["rules"]}
    assert broken["fact_leases", "move_in_date in dimension"] == 31
    assert [broken["fact_hubspot_leads", f"{c} in dimension"] for c in ("tour_date", "deposit_date", "move_in_date")] == [37, 34, 44]
    assert broken["fact_gbp_reviews", "responded_at in dimension"] == 11
    funnel = quality.count_violations(gold(spark, out, "fact_hubspot_leads"), "leads", quality.ordered_dates([("deposit_date", "move_in_date")]))
    assert funnel.first().violations == 34
