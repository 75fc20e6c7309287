"""Columns, types, keys and rules of every layer."""

from __future__ import annotations

from dataclasses import dataclass, field

METADATA = ("ingestion_timestamp", "source_file", "source_system", "batch_id", "row_hash")
# The position of a row in its source file; with source_file it orders equal rows.
ROW_ORDINAL = "row_ordinal"

# Columns of each monthly extract.
DATASETS = {
    "adp_shifts": ("shift_id", "employee_id", "community_id", "role", "shift_date", "hours_worked", "hourly_rate"),
    "gbp_reviews": ("review_id", "community_id", "review_date", "rating", "review_text", "response_text", "responded_at"),
    "hubspot_leads": ("lead_id", "community_id", "lead_source", "created_date", "tour_date", "deposit_date", "move_in_date", "status", "lost_reason"),
    "pcc_care_history": ("resident_id", "change_date", "previous_level", "new_level", "reason"),
    "pcc_incidents": ("incident_id", "resident_id", "community_id", "incident_date", "incident_type", "severity", "reported_by"),
    "pcc_residents": ("resident_id", "community_id", "first_name", "last_name", "dob", "gender", "admit_date", "discharge_date", "care_level", "acuity_score", "mobility_status"),
    "yardi_leases": ("lease_id", "resident_id", "unit_id", "community_id", "move_in_date", "move_out_date", "move_out_reason", "monthly_rate"),
    "yardi_units": ("unit_id", "community_id", "unit_type", "monthly_rent", "snapshot_date"),
}

EXPECTED_COMMUNITIES = tuple(f"C{n:03d}" for n in range(1, 15))
CALENDAR = ("2025-01-01", "2025-06-30")
LEAD_STATUSES = ("Won", "Lost", "Open")


@dataclass(frozen=True)
class Table:
    """One table of the star: its columns with SQL types and the rules on it."""

    columns: dict[str, str]
    unique: tuple[tuple[str, ...], ...]
    required: tuple[str, ...]
    references: tuple[tuple[str, str, str], ...] = ()
    at_least: tuple[tuple[str, int], ...] = ()
    between: tuple[tuple[str, int, int], ...] = ()
    one_of: tuple[tuple[str, tuple[str, ...]], ...] = ()
    date_order: tuple[tuple[str, str], ...] = field(default=())


DIMENSIONS = {
    "dim_community": Table(
        {"community_key": "bigint", "community_id": "varchar(20)"},
        (("community_key",), ("community_id",)),
        ("community_key", "community_id"),
    ),
    "dim_employee": Table(
        {"employee_key": "bigint", "employee_id": "varchar(30)", "role": "varchar(100)"},
        (("employee_key",), ("employee_id",)),
        ("employee_key", "employee_id", "role"),
    ),
    "dim_residents": Table(
        {"resident_key": "bigint", "resident_id": "varchar(30)", "first_name": "varchar(100)", "last_name": "varchar(100)", "dob": "date", "gender": "varchar(30)"},
        (("resident_key",), ("resident_id",)),
        ("resident_key", "resident_id"),
    ),
    "dim_unit": Table(
        {"unit_key": "bigint", "unit_id": "varchar(30)", "unit_type": "varchar(100)"},
        (("unit_key",), ("unit_id",)),
        ("unit_key", "unit_id"),
    ),
    "dim_date": Table(
        {"date": "date", "year": "smallint", "month": "smallint", "month_name": "varchar(20)", "day": "smallint"},
        (("date",),),
        ("date", "year", "month", "month_name", "day"),
        between=(("month", 1, 12), ("day", 1, 31)),
    ),
    "dim_care_level": Table({"care_level": "varchar(50)"}, (("care_level",),), ("care_level",)),
}

FACTS = {
    "fact_adp_shifts": Table(
        {"shift_id": "varchar(30)", "employee_key": "bigint", "community_key": "bigint", "shift_date": "date", "hours_worked": "decimal(8,2)", "standard_hourly_rate": "decimal(10,2)", "total_labor_cost": "decimal(14,2)"},
        (("shift_id",),),
        ("shift_id", "employee_key", "community_key", "shift_date", "hours_worked", "standard_hourly_rate", "total_labor_cost"),
        (("employee_key", "dim_employee", "employee_key"), ("community_key", "dim_community", "community_key"), ("shift_date", "dim_date", "date")),
    ),
    "fact_care_history": Table(
        {"resident_key": "bigint", "change_date": "date", "previous_level": "varchar(50)", "new_level": "varchar(50)", "reason": "varchar(200)"},
        (("resident_key", "change_date"),),
        ("resident_key", "change_date", "new_level", "reason"),
        (("resident_key", "dim_residents", "resident_key"), ("change_date", "dim_date", "date"), ("new_level", "dim_care_level", "care_level")),
    ),
    "fact_gbp_reviews": Table(
        {"review_id": "varchar(30)", "community_key": "bigint", "review_date": "date", "rating": "smallint", "review_text": "string", "response_text": "string", "responded_at": "date"},
        (("review_id",),),
        ("review_id", "community_key", "review_date", "rating"),
        (("community_key", "dim_community", "community_key"), ("review_date", "dim_date", "date"), ("responded_at", "dim_date", "date")),
        between=(("rating", 1, 5),),
        date_order=(("review_date", "responded_at"),),
    ),
    "fact_hubspot_leads": Table(
        {"lead_id": "varchar(30)", "community_key": "bigint", "lead_source": "varchar(100)", "created_date": "date", "tour_date": "date", "deposit_date": "date", "move_in_date": "date", "status": "varchar(20)", "lost_reason": "varchar(200)"},
        (("lead_id",),),
        ("lead_id", "community_key", "lead_source", "created_date", "status"),
        (("community_key", "dim_community", "community_key"), ("created_date", "dim_date", "date"), ("tour_date", "dim_date", "date"), ("deposit_date", "dim_date", "date"), ("move_in_date", "dim_date", "date")),
        one_of=(("status", LEAD_STATUSES),),
        date_order=(("created_date", "tour_date"), ("created_date", "deposit_date"), ("created_date", "move_in_date")),
    ),
    "fact_incidents": Table(
        {"incident_id": "varchar(30)", "resident_key": "bigint", "community_key": "bigint", "incident_date": "date", "incident_type": "varchar(100)", "severity": "smallint", "reported_by": "varchar(30)"},
        (("incident_id",),),
        ("incident_id", "resident_key", "community_key", "incident_date", "incident_type", "severity", "reported_by"),
        (("resident_key", "dim_residents", "resident_key"), ("community_key", "dim_community", "community_key"), ("incident_date", "dim_date", "date")),
        between=(("severity", 1, 5),),
    ),
    "fact_leases": Table(
        {"lease_id": "varchar(30)", "resident_key": "bigint", "unit_key": "bigint", "community_key": "bigint", "move_in_date": "date", "move_out_date": "date", "move_out_reason": "varchar(200)", "monthly_rate": "decimal(12,2)"},
        (("lease_id",),),
        ("lease_id", "resident_key", "unit_key", "community_key", "move_in_date"),
        (("resident_key", "dim_residents", "resident_key"), ("unit_key", "dim_unit", "unit_key"), ("community_key", "dim_community", "community_key"), ("move_in_date", "dim_date", "date"), ("move_out_date", "dim_date", "date")),
        at_least=(("monthly_rate", 0),),
        date_order=(("move_in_date", "move_out_date"),),
    ),
    "fact_residents": Table(
        {"resident_key": "bigint", "community_key": "bigint", "admit_date": "date", "discharge_date": "date", "care_level": "varchar(50)", "acuity_score": "decimal(8,2)", "mobility_status": "varchar(100)", "status": "varchar(50)", "discharged_resident_count": "int", "last_date": "date"},
        (("resident_key", "community_key", "last_date"),),
        ("resident_key", "community_key", "admit_date", "care_level", "status", "discharged_resident_count", "last_date"),
        (("resident_key", "dim_residents", "resident_key"), ("community_key", "dim_community", "community_key"), ("care_level", "dim_care_level", "care_level"), ("admit_date", "dim_date", "date"), ("discharge_date", "dim_date", "date"), ("last_date", "dim_date", "date")),
        between=(("discharged_resident_count", 0, 1),),
        date_order=(("admit_date", "discharge_date"),),
    ),
    "fact_units": Table(
        {"unit_key": "bigint", "community_key": "bigint", "unit_type": "varchar(100)", "monthly_rent": "decimal(12,2)", "snapshot_date": "date"},
        (("unit_key", "community_key", "snapshot_date"),),
        ("unit_key", "community_key", "unit_type", "snapshot_date"),
        (("unit_key", "dim_unit", "unit_key"), ("community_key", "dim_community", "community_key"), ("snapshot_date", "dim_date", "date")),
        at_least=(("monthly_rent", 0),),
    ),
}
