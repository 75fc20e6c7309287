"""Cell by cell cleansing."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import oracle as o
from checks.inputs import Inputs
from checks.registry import day, query
from lakestrata.functions import dates, numbers, text
from lakestrata.operators import quality
from lakestrata.plans.silver import SPECS, cleansing_counters

_RESIDENT_TEXTS = ("first_name", "last_name", "care_level", "mobility_status")


@query(
    "trim_strings",
    "SELECT resident_id, source_file, "
    + ", ".join(f"{o.strip(c)} AS {c}" for c in _RESIDENT_TEXTS)
    + ", CAST("
    + " + ".join(f"CAST({c} <> {o.strip(c)} AS INT)" for c in _RESIDENT_TEXTS)
    + " AS INT) AS trimmed_cells FROM raw_pcc_residents",
)
def trim_strings(inputs: Inputs) -> DataFrame:
    changed = [text.was_trimmed(F.col(c)).cast("int") for c in _RESIDENT_TEXTS]
    return inputs.raw("pcc_residents").select(
        "resident_id",
        "source_file",
        *[text.strip(F.col(c)).alias(c) for c in _RESIDENT_TEXTS],
        reduce(add, changed).alias("trimmed_cells"),
    )


@query(
    "null_tokens",
    "SELECT resident_id, source_file, "
    + ", ".join(f"{o.nulled(c)} AS {c}" for c in ("gender", "discharge_date", "mobility_status"))
    + " FROM raw_pcc_residents",
)
def null_tokens(inputs: Inputs) -> DataFrame:
    columns = ("gender", "discharge_date", "mobility_status")
    cleaned = [text.null_tokens_to_null(F.col(c)).alias(c) for c in columns]
    return inputs.raw("pcc_residents").select("resident_id", "source_file", *cleaned)


@query(
    "blank_to_default",
    f"SELECT row_ordinal, lost_reason AS raw_reason, CASE WHEN {o.blank('lost_reason')} THEN 'N/A' ELSE lost_reason END AS lost_reason FROM raw_hubspot_leads",
)
def blank_to_default(inputs: Inputs) -> DataFrame:
    return inputs.raw("hubspot_leads").select(
        "row_ordinal",
        F.col("lost_reason").alias("raw_reason"),
        text.blank_to_default(F.col("lost_reason")).alias("lost_reason"),
    )


@query(
    "mixed_date_parse",
    f"SELECT row_ordinal, source_file, incident_date AS raw_date, CAST({o.strict('incident_date')} AS VARCHAR) AS incident_date FROM raw_pcc_incidents",
)
def mixed_date_parse(inputs: Inputs) -> DataFrame:
    return inputs.raw("pcc_incidents").select(
        "row_ordinal",
        "source_file",
        F.col("incident_date").alias("raw_date"),
        dates.mixed_date(F.col("incident_date")).alias("incident_date"),
    )


@query(
    "mixed_date_parse_lenient",
    f"SELECT row_ordinal, created_date AS raw_date, CAST({o.lenient('created_date')} AS VARCHAR) AS created_date FROM raw_hubspot_leads",
)
def mixed_date_parse_lenient(inputs: Inputs) -> DataFrame:
    return inputs.raw("hubspot_leads").select(
        "row_ordinal",
        F.col("created_date").alias("raw_date"),
        dates.mixed_date_lenient(F.col("created_date")).alias("created_date"),
    )


_COUNTED_DATES = (
    ("pcc_incidents", "incident_date"),
    ("pcc_residents", "admit_date"),
    ("pcc_residents", "discharge_date"),
)


@query(
    "date_parse_counters",
    "SELECT column_name, outcome, count(*) AS cells FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CASE WHEN {o.strict(c)} IS NOT NULL THEN 'ok' WHEN {o.blank(c)} THEN 'blank' ELSE 'invalid' END AS outcome FROM raw_{d}"
        for d, c in _COUNTED_DATES
    )
    + ") GROUP BY ALL",
)
def date_parse_counters(inputs: Inputs) -> DataFrame:
    parts = [
        inputs.raw(d).select(
            F.lit(c).alias("column_name"),
            dates.date_outcome(F.col(c), dates.mixed_date(F.col(c))).alias("outcome"),
        )
        for d, c in _COUNTED_DATES
    ]
    cells = reduce(DataFrame.unionByName, parts)
    return cells.groupBy("column_name", "outcome").agg(F.count("*").alias("cells"))


_CANDIDATES = ("resident_id", "dob", "gender", "admit_date", "discharge_date", "care_level")


@query(
    "infer_date_columns",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(sum(filled) AS BIGINT) AS filled, CAST(sum(parsed) AS BIGINT) AS parsed,
                   CASE WHEN sum(filled) > 0 AND sum(filled) = sum(parsed) THEN 'date' ELSE 'text' END AS kind
            FROM (SELECT CAST(NOT {o.blank(c)} AS INT) AS filled, CAST(NOT {o.blank(c)} AND {o.strict(c)} IS NOT NULL AS INT) AS parsed FROM raw_pcc_residents)"""
        for c in _CANDIDATES
    ),
)
def infer_date_columns(inputs: Inputs) -> DataFrame:
    return quality.date_column_report(inputs.raw("pcc_residents"), _CANDIDATES)


@query(
    "label_standardise",
    f"SELECT resident_id, source_file, {o.level_any_case('care_level')} AS care_level FROM raw_pcc_residents",
)
def label_standardise(inputs: Inputs) -> DataFrame:
    level = text.label_any_case(text.strip(F.col("care_level")))
    return inputs.raw("pcc_residents").select("resident_id", "source_file", level.alias("care_level"))


@query(
    "label_standardise_exact",
    f"SELECT row_ordinal, {o.level('previous_level')} AS previous_level, {o.level('new_level')} AS new_level FROM raw_pcc_care_history",
)
def label_standardise_exact(inputs: Inputs) -> DataFrame:
    levels = [text.label_exact(text.strip(F.col(c))).alias(c) for c in ("previous_level", "new_level")]
    return inputs.raw("pcc_care_history").select("row_ordinal", *levels)


@query(
    "map_literal_lookup",
    f"SELECT shift_id, source_file, role, hourly_rate, {o.rate('role', 'hourly_rate')} AS standard_hourly_rate FROM raw_adp_shifts",
)
def map_literal_lookup(inputs: Inputs) -> DataFrame:
    rate = numbers.rate_for(F.col("role"), F.col("hourly_rate")).alias("standard_hourly_rate")
    return inputs.raw("adp_shifts").select("shift_id", "source_file", "role", "hourly_rate", rate)


@query(
    "labor_cost",
    "SELECT row_ordinal, source_file, employee_id, hours_worked, standard_hourly_rate, total_labor_cost FROM clean_adp_shifts",
)
def labor_cost(inputs: Inputs) -> DataFrame:
    return inputs.clean("adp_shifts").select(
        "row_ordinal", "source_file", "employee_id", "hours_worked", "standard_hourly_rate", "total_labor_cost"
    )


@query(
    "snapshot_month_end",
    f"SELECT unit_id, source_file, CAST({o.month_end('source_file')} AS VARCHAR) AS month_end FROM raw_yardi_units",
)
def snapshot_month_end(inputs: Inputs) -> DataFrame:
    month_end = dates.month_end_of_file(F.col("source_file")).alias("month_end")
    return inputs.raw("yardi_units").select("unit_id", "source_file", month_end)


@query(
    "snapshot_status",
    f"SELECT resident_id, {day('admit_date', 'discharge_date', 'last_date')}, status FROM clean_pcc_residents",
)
def snapshot_status(inputs: Inputs) -> DataFrame:
    return inputs.clean("pcc_residents").select(
        "resident_id", "admit_date", "discharge_date", "last_date", "status"
    )


@query(
    "safe_ratio",
    f"""SELECT l_suppkey, returned, huge, {o.percent('returned', 'line_count')} AS returned_percent,
               {o.percent('returned', 'huge')} AS null_percent, CAST(returned AS DOUBLE) / line_count AS returned_ratio,
               coalesce(CAST(returned AS DOUBLE) / nullif(huge, 0), 0) AS zero_ratio
        FROM (SELECT l_suppkey, count(*) AS line_count, count(*) FILTER (l_returnflag = 'R') AS returned,
                     count(*) FILTER (l_quantity > 49 AND l_discount > 0.09) AS huge FROM lineitem GROUP BY l_suppkey)""",
)
def safe_ratio(inputs: Inputs) -> DataFrame:
    per_supplier = inputs.table("lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("line_count"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if((F.col("l_quantity") > 49) & (F.col("l_discount") > 0.09)).alias("huge"),
    )
    returned, lines, huge = F.col("returned"), F.col("line_count"), F.col("huge")
    return per_supplier.select(
        "l_suppkey",
        "returned",
        "huge",
        numbers.percent(returned, lines).alias("returned_percent"),
        numbers.percent(returned, huge).alias("null_percent"),
        numbers.divide(returned, lines).alias("returned_ratio"),
        numbers.divide(returned, huge).alias("zero_ratio"),
    )


_LEAD_DATES = ("created_date", "tour_date", "deposit_date", "move_in_date")
_LEAD_TEXTS = ("lead_id", "community_id", "lead_source", *_LEAD_DATES, "status", "lost_reason")


def _kind(c: str) -> str:
    return f"CASE WHEN {o.lenient(c)} IS NOT NULL THEN 'ok' WHEN {o.blank(c)} THEN 'blank' ELSE 'invalid' END"


@query(
    "silver_quality_metrics",
    "SELECT count(*) AS rows_read, CAST(sum("
    + " + ".join(f"coalesce(CAST({c} <> {o.strip(c)} AS INT), 0)" for c in _LEAD_TEXTS)
    + ") AS BIGINT) AS trimmed_cells, "
    + ", ".join(
        f"count(*) FILTER ({_kind(c)} = '{k}') AS {c}_{k}" for c in _LEAD_DATES for k in ("ok", "blank", "invalid")
    )
    + f", count(*) FILTER ({o.blank('lost_reason')}) AS lost_reason_defaulted FROM raw_hubspot_leads",
)
def silver_quality_metrics(inputs: Inputs) -> DataFrame:
    rows = inputs.raw("hubspot_leads").drop("row_ordinal")
    return cleansing_counters(rows, SPECS["hubspot_leads"])


@query(
    "format_census",
    """SELECT 'created_date' AS column_name, regexp_replace(regexp_replace(created_date, '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g') AS shape, count(*) AS row_count
       FROM raw_hubspot_leads GROUP BY ALL
       UNION ALL
       SELECT 'previous_level', regexp_replace(regexp_replace(previous_level, '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g'), count(*)
       FROM raw_pcc_care_history GROUP BY ALL""",
)
def format_census(inputs: Inputs) -> DataFrame:
    census = [
        quality.format_census(inputs.raw(d), c).withColumn("column_name", F.lit(c))
        for d, c in (("hubspot_leads", "created_date"), ("pcc_care_history", "previous_level"))
    ]
    return reduce(DataFrame.unionByName, census)
