"""The layers once more, in plain SQL for the oracle engine."""

from __future__ import annotations

import re

from checks.inputs import ORACLE_MONTHS, RAW, raw_sql
from lakestrata.schemas import DATASETS


def strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9))"


def nulled(x: str) -> str:
    return f"CASE WHEN {strip(x)} IN ('', 'N/A', 'NULL', 'null', 'None', 'none') THEN NULL ELSE {strip(x)} END"


def blank(x: str) -> str:
    return f"({x} IS NULL OR lower({strip(x)}) IN ('', 'null', 'n/a', 'nan', 'pd.na', 'none'))"


def defaulted(x: str) -> str:
    return f"CASE WHEN {blank(x)} THEN 'N/A' ELSE {strip(x)} END"


def emptied(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def parsed(x: str, *formats: str) -> str:
    tries = ", ".join(f"try_strptime({strip(x)}, '{f}')" for f in formats)
    return f"CAST(coalesce({tries}) AS DATE)"


def strict(x: str) -> str:
    return parsed(x, "%Y-%m-%d", "%m/%d/%Y")


def lenient(x: str) -> str:
    return parsed(x, "%Y-%m-%d", "%m/%d/%Y", "%Y-%m-%d %H:%M", "%Y%m%d", "%m-%d-%Y", "%d/%m/%Y", "%B %d, %Y")


def level(x: str) -> str:
    """Exact-case label."""
    v = strip(x)
    return f"CASE WHEN {v} IN ('AL', 'Assisted') THEN 'Assisted Living' WHEN {v} IN ('IL', 'Independent') THEN 'Independent Living' WHEN {v} IN ('MC', 'Memory') THEN 'Memory Care' ELSE {v} END"


def level_any_case(x: str) -> str:
    v = f"lower({nulled(x)})"
    return f"CASE WHEN {v} IN ('al', 'assisted', 'assisted living') THEN 'Assisted Living' WHEN {v} IN ('il', 'independent', 'independent living') THEN 'Independent Living' WHEN {v} IN ('mc', 'memory', 'memory care') THEN 'Memory Care' ELSE {nulled(x)} END"


def percent(n: str, d: str) -> str:
    return f"((2 * ({n}) * 10000 + ({d})) // (2 * nullif({d}, 0))) / 100.0::DOUBLE"


def rate(role: str, rates: str) -> str:
    """A regular expression finds the role's number in the text."""
    return f"CAST(nullif(regexp_extract({rates}, '''' || {strip(role)} || ''': ([0-9.]+)', 1), '') AS DOUBLE)"


def month_end(source_file: str) -> str:
    ym = f"regexp_extract({source_file}, '_([0-9]{{4}}_[0-9]{{2}})[.]csv$', 1)"
    return f"last_day(CAST(try_strptime({ym} || '_01', '%Y_%m_%d') AS DATE))"


def status(admit: str, discharge: str, last: str) -> str:
    return f"CASE WHEN {admit} <= {last} AND ({discharge} IS NULL OR {discharge} >= date_trunc('month', {last})) THEN 'Active' ELSE 'Not Active' END"


_CLEAN = {
    "adp_shifts": ("shift_id", "employee_id", "community_id", "role", lenient("shift_date") + " AS shift_date", "hours_worked", rate("role", "hourly_rate") + " AS standard_hourly_rate", "TRY_CAST(hours_worked AS DOUBLE) * " + rate("role", "hourly_rate") + " AS total_labor_cost"),
    "gbp_reviews": ("review_id", "community_id", lenient("review_date") + " AS review_date", "rating", "review_text", defaulted("response_text") + " AS response_text", lenient("responded_at") + " AS responded_at"),
    "hubspot_leads": ("lead_id", "community_id", "lead_source", *[f"{lenient(c)} AS {c}" for c in ("created_date", "tour_date", "deposit_date", "move_in_date")], "status", defaulted("lost_reason") + " AS lost_reason"),
    "pcc_care_history": ("resident_id", lenient("change_date") + " AS change_date", f"nullif({level('previous_level')}, '') AS previous_level", level("new_level") + " AS new_level", "reason"),
    "pcc_incidents": (*[f"{nulled(c)} AS {c}" for c in ("incident_id", "resident_id", "community_id")], strict("incident_date") + " AS incident_date", *[f"{nulled(c)} AS {c}" for c in ("incident_type", "severity", "reported_by")]),
    "pcc_residents": (*[f"{nulled(c)} AS {c}" for c in ("resident_id", "community_id", "first_name", "last_name", "gender", "acuity_score", "mobility_status")], *[f"{strict(c)} AS {c}" for c in ("dob", "admit_date", "discharge_date")], level_any_case("care_level") + " AS care_level", month_end("source_file") + " AS last_date"),
    "yardi_leases": ("lease_id", "resident_id", "unit_id", "community_id", lenient("move_in_date") + " AS move_in_date", lenient("move_out_date") + " AS move_out_date", emptied("move_out_reason") + " AS move_out_reason", "monthly_rate"),
    "yardi_units": ("unit_id", "community_id", level("unit_type") + " AS unit_type", "monthly_rent", lenient("snapshot_date") + " AS snapshot_date"),
}


def _clean_sql(dataset: str) -> str:
    columns = [c if " AS " in c else f"{strip(c)} AS {c}" for c in _CLEAN[dataset]]
    inner = f"SELECT {', '.join(columns)}, source_file, row_ordinal FROM raw_{dataset}"
    if dataset == "pcc_residents":
        return f"SELECT *, {status('admit_date', 'discharge_date', 'last_date')} AS status FROM ({inner})"
    return inner


def business(dataset: str) -> list[str]:
    names = [c.rsplit(" AS ", 1)[-1] for c in _CLEAN[dataset]]
    return [*names, "status"] if dataset == "pcc_residents" else names


def _silver_sql(dataset: str) -> str:
    keys = ", ".join(business(dataset))
    return (
        f"SELECT * EXCLUDE (copy) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY source_file, row_ordinal) AS copy FROM clean_{dataset}) WHERE copy = 1"
    )


def _dim_sql(dataset: str, id_column: str, key: str, attributes: tuple[str, ...]) -> str:
    extra = "".join(f", {a}" for a in attributes)
    return (
        f"SELECT {id_column}{extra}, row_number() OVER (ORDER BY {id_column} NULLS FIRST) "
        f"- max(CASE WHEN {id_column} IS NULL THEN 1 ELSE 0 END) OVER () AS {key} "
        f"FROM (SELECT *, row_number() OVER (PARTITION BY {id_column} ORDER BY source_file, row_ordinal) AS nth FROM clean_{dataset}) WHERE nth = 1"
    )


_WITH_COMMUNITY = [d for d in RAW if "community_id" in DATASETS[d]]


_COMMUNITY = ("dim_community", "community_id", "community_key")
_EMPLOYEE = ("dim_employee", "employee_id", "employee_key")
_RESIDENT = ("dim_residents", "resident_id", "resident_key")
_UNIT = ("dim_unit", "unit_id", "unit_key")


def _fact_sql(dataset: str, lookups, columns: str) -> str:
    joins = " ".join(f"LEFT JOIN {d} ON {d}.{i} IS NOT DISTINCT FROM f.{i}" for d, i, _ in lookups)
    keys = ", ".join(f"{d}.{k}" for d, _, k in lookups)
    return f"SELECT {keys}, {columns} FROM silver_{dataset} f {joins}"


LAYERS: dict[str, str] = {}
for _d in RAW:
    LAYERS[f"raw_{_d}"] = raw_sql(_d, ORACLE_MONTHS)
    LAYERS[f"clean_{_d}"] = _clean_sql(_d)
    LAYERS[f"silver_{_d}"] = _silver_sql(_d)
LAYERS |= {
    "dim_community": "SELECT community_id, row_number() OVER (ORDER BY community_id) AS community_key FROM ("
    + " UNION ".join(f"SELECT community_id FROM clean_{d}" for d in _WITH_COMMUNITY)
    + ")",
    "dim_employee": _dim_sql("adp_shifts", "employee_id", "employee_key", ("role",)),
    "dim_residents": _dim_sql("pcc_residents", "resident_id", "resident_key", ("first_name", "last_name", "dob", "gender")),
    "dim_unit": _dim_sql("yardi_units", "unit_id", "unit_key", ("unit_type",)),
    "bounds": "SELECT date_trunc('month', min(d))::DATE AS first_day, last_day(max(d)) AS last_day FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)",
    "dim_date": "SELECT CAST(d AS DATE) AS date, CAST(year(d) AS SMALLINT) AS year, CAST(month(d) AS SMALLINT) AS month, monthname(d) AS month_name, CAST(day(d) AS SMALLINT) AS day FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM bounds)",
    "month_ends": "SELECT DISTINCT last_day(date) AS report_date FROM dim_date",
    "fact_adp_shifts": _fact_sql("adp_shifts", (_EMPLOYEE, _COMMUNITY), "shift_id, shift_date, TRY_CAST(hours_worked AS DECIMAL(8,2)) AS hours_worked, CAST(standard_hourly_rate AS DECIMAL(10,2)) AS standard_hourly_rate, CAST(total_labor_cost AS DECIMAL(14,2)) AS total_labor_cost"),
    "fact_care_history": _fact_sql("pcc_care_history", (_RESIDENT,), "change_date, previous_level, new_level, reason"),
    "fact_gbp_reviews": _fact_sql("gbp_reviews", (_COMMUNITY,), "review_id, review_date, TRY_CAST(rating AS SMALLINT) AS rating, review_text, response_text, responded_at"),
    "fact_hubspot_leads": _fact_sql("hubspot_leads", (_COMMUNITY,), "lead_id, lead_source, created_date, tour_date, deposit_date, move_in_date, status, lost_reason"),
    "fact_incidents": _fact_sql("pcc_incidents", (_COMMUNITY, _RESIDENT), "incident_id, incident_date, incident_type, TRY_CAST(severity AS SMALLINT) AS severity, reported_by"),
    "fact_leases": _fact_sql("yardi_leases", (_RESIDENT, _COMMUNITY, _UNIT), "lease_id, move_in_date, move_out_date, move_out_reason, TRY_CAST(monthly_rate AS DECIMAL(12,2)) AS monthly_rate"),
    "fact_residents": _fact_sql("pcc_residents", (_RESIDENT, _COMMUNITY), "admit_date, discharge_date, care_level, TRY_CAST(acuity_score AS DECIMAL(8,2)) AS acuity_score, mobility_status, status, CAST(discharge_date IS NOT NULL AS INT) AS discharged_resident_count, last_date"),
    "fact_units": _fact_sql("yardi_units", (_UNIT, _COMMUNITY), "f.unit_type, TRY_CAST(monthly_rent AS DECIMAL(12,2)) AS monthly_rent, snapshot_date"),
}


def on_layers(final: str) -> str:
    """``final`` with the layers it names, and those they name, as common table expressions."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in LAYERS:
            if name not in needed and _names(sql, name):
                visit(LAYERS[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    ctes = ",\n".join(f"{name} AS ({LAYERS[name]})" for name in needed)
    if not ctes:
        return final
    if final.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{final.lstrip()[5:]}"
    return f"WITH {ctes}\n{final}"


def _names(sql: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", sql) is not None
