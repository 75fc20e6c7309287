"""Report measures per community, source and period."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.inputs import Inputs
from checks.registry import query
from lakestrata.operators.cube import distinct_cube, distinct_per, distinct_trailing
from lakestrata.operators.windows import report_dates, rolling_distinct
from lakestrata.plans import measures
from lakestrata.session import in_parallel, materialise

# What the measures read of a fact that is written for them.
_RESIDENT_COLUMNS = ("resident_key", "community_key", "last_date", "status")
_LEASE_COLUMNS = ("resident_key", "community_key", "move_out_date")

_QUARTER = "CAST(date_trunc('quarter', {d}) AS DATE)"


def _quarter(d: str) -> str:
    return _QUARTER.format(d=d)


_ACTIVE = f"""SELECT community_key, {_quarter('last_date')} AS period, count(DISTINCT resident_key) AS active_residents
              FROM fact_residents WHERE status = 'Active' GROUP BY ALL"""
_DAYS = f"SELECT {_quarter('date')} AS period, count(*) AS selected_days FROM dim_date GROUP BY ALL"


@query(
    "m_active_residents",
    f"SELECT community_key, CAST(period AS VARCHAR) AS period, active_residents FROM ({_ACTIVE})",
)
def m_active_residents(inputs: Inputs) -> DataFrame:
    return measures.active_residents(inputs.fact("fact_residents"), ["community_key"], "quarter")


@query(
    "m_resident_days",
    f"""SELECT community_key, CAST(period AS VARCHAR) AS period, active_residents, selected_days,
               active_residents * selected_days AS resident_days
        FROM ({_ACTIVE}) a JOIN ({_DAYS}) d USING (period)""",
)
def m_resident_days(inputs: Inputs) -> DataFrame:
    return measures.resident_days(
        inputs.fact("fact_residents"), inputs.dim("dim_date"), ["community_key"], "quarter"
    )


# Rows of an unknown community (key 0) form a group without a key.
_UNKNOWN = "nullif(community_key, 0)"


def _with_unknown(fact: DataFrame) -> DataFrame:
    return fact.withColumn("community_key", F.nullif("community_key", F.lit(0)))


@query(
    "m_incident_rate",
    f"""WITH happened AS (SELECT DISTINCT {_UNKNOWN} AS community_key, {_quarter('incident_date')} AS period, incident_id FROM fact_incidents),
             lived AS (SELECT DISTINCT {_UNKNOWN} AS community_key, {_quarter('last_date')} AS period, resident_key FROM fact_residents WHERE status = 'Active'),
             line AS (SELECT community_key, period FROM happened UNION SELECT community_key, period FROM lived),
             counted AS (
               SELECT community_key, period,
                      (SELECT count(*) FROM happened h WHERE h.community_key IS NOT DISTINCT FROM line.community_key AND h.period IS NOT DISTINCT FROM line.period AND h.incident_id IS NOT NULL) AS total_incidents,
                      (SELECT count(*) FROM lived v WHERE v.community_key IS NOT DISTINCT FROM line.community_key AND v.period IS NOT DISTINCT FROM line.period AND v.resident_key IS NOT NULL)
                      * (SELECT count(*) FROM dim_date c WHERE {_quarter('c.date')} = line.period) AS resident_days
               FROM line)
        SELECT community_key, CAST(period AS VARCHAR) AS period, total_incidents, resident_days,
               CASE WHEN resident_days = 0 THEN 0.0::DOUBLE ELSE total_incidents::DOUBLE / resident_days::DOUBLE END * 100 AS incident_rate
        FROM counted""",
)
def m_incident_rate(inputs: Inputs) -> DataFrame:
    return measures.incident_rate(
        *map(_with_unknown, in_parallel(*[partial(inputs.fact, f) for f in ("fact_incidents", "fact_residents")])),
        inputs.dim("dim_date"),
        ["community_key"],
        "quarter",
    )


def _counts(fact: str, group: str, key: str, day: str, name: str, reports: str, where: str = "TRUE") -> str:
    """Distinct keys of the trailing window, for every group of the fact and every report."""
    return f"""SELECT g.{group}, r.report_date, count(DISTINCT f.{key}) AS {name}
               FROM (SELECT DISTINCT {group} FROM {fact}) g CROSS JOIN {reports} r
               LEFT JOIN (SELECT * FROM {fact} WHERE {where}) f ON f.{group} IS NOT DISTINCT FROM g.{group}
                AND f.{day} > r.report_date - 90 AND f.{day} <= r.report_date
               GROUP BY ALL"""


_LEASES = f"(SELECT {_UNKNOWN} AS community_key, resident_key, move_out_date FROM fact_leases)"
_RESIDENTS = f"(SELECT {_UNKNOWN} AS community_key, resident_key, last_date, status FROM fact_residents)"
_MOVED = _counts("fact_leases", "community_key", "resident_key", "move_out_date", "move_outs", "month_ends")
_AVERAGE = """SELECT g.community_key, m.report_date, CAST(sum(residents) AS DOUBLE) / count(residents) AS average_active
              FROM (SELECT DISTINCT community_key FROM {residents}) g CROSS JOIN month_ends m
              LEFT JOIN (SELECT community_key, last_date, count(DISTINCT resident_key) AS residents FROM {residents}
                         WHERE status = 'Active' AND last_date IN (SELECT date FROM dim_date) GROUP BY ALL) s
                ON s.community_key IS NOT DISTINCT FROM g.community_key AND s.last_date > m.report_date - 90 AND s.last_date <= m.report_date
              GROUP BY ALL"""


@query(
    "m_trailing_moveouts",
    f"SELECT community_key, CAST(report_date AS VARCHAR) AS report_date, move_outs FROM ({_MOVED})",
)
def m_trailing_moveouts(inputs: Inputs) -> DataFrame:
    return measures.trailing_moveouts(inputs.stored_fact("fact_leases", *_LEASE_COLUMNS), inputs.dim("dim_date"), ["community_key"])


@query(
    "m_trailing_avg_active",
    f"SELECT community_key, CAST(report_date AS VARCHAR) AS report_date, average_active FROM ({_AVERAGE.format(residents='fact_residents')})",
)
def m_trailing_avg_active(inputs: Inputs) -> DataFrame:
    return measures.trailing_average_active(
        inputs.stored_fact("fact_residents", *_RESIDENT_COLUMNS), inputs.dim("dim_date"), ["community_key"]
    )


@query(
    "m_moveout_rate",
    f"""SELECT coalesce(m.community_key, a.community_key) AS community_key, CAST(coalesce(m.report_date, a.report_date) AS VARCHAR) AS report_date,
               coalesce(move_outs, 0) AS move_outs, average_active,
               coalesce(CAST(coalesce(move_outs, 0) AS DOUBLE) / nullif(average_active, 0), 0) AS moveout_rate
        FROM ({_counts(_LEASES, "community_key", "resident_key", "move_out_date", "move_outs", "month_ends")}) m
        FULL JOIN ({_AVERAGE.format(residents=_RESIDENTS)}) a ON m.community_key IS NOT DISTINCT FROM a.community_key AND m.report_date = a.report_date""",
)
def m_moveout_rate(inputs: Inputs) -> DataFrame:
    both = inputs.stored_facts("fact_leases", "fact_residents", columns=(*_LEASE_COLUMNS, *_RESIDENT_COLUMNS))
    leases, residents = map(_with_unknown, both)
    return measures.moveout_rate(leases, residents, inputs.dim("dim_date"), ["community_key"])


@query(
    "m_occupancy",
    f"""WITH asked AS (SELECT community_key, {_quarter('snapshot_date')} AS period, count(DISTINCT unit_key) AS total_units, max(snapshot_date) AS snapshot_date
                      FROM fact_units GROUP BY ALL),
             counted AS (
               SELECT *, (SELECT count(DISTINCT l.unit_key) FROM fact_leases l
                          WHERE l.community_key IS NOT DISTINCT FROM asked.community_key AND l.move_in_date <= asked.snapshot_date
                            AND coalesce(l.move_out_date >= asked.snapshot_date, TRUE)) AS occupied_units
               FROM asked)
        SELECT community_key, CAST(period AS VARCHAR) AS period, CAST(snapshot_date AS VARCHAR) AS snapshot_date, total_units, occupied_units,
               CAST(occupied_units AS DOUBLE) / total_units AS occupancy
        FROM counted""",
)
def m_occupancy(inputs: Inputs) -> DataFrame:
    """Distinct units are counted, so rows and leases that are equal in what is read are one."""
    units = materialise(inputs.distinct_fact("fact_units", "unit_key", "community_key", "snapshot_date"), "fact_units")
    leases = inputs.distinct_fact("fact_leases", "unit_key", "community_key", "move_in_date", "move_out_date")
    return measures.occupancy(units, leases, ["community_key"], "quarter")


@query(
    "m_rolling_leads",
    "SELECT lead_source, CAST(report_date AS VARCHAR) AS report_date, leads FROM ("
    + _counts("silver_hubspot_leads", "lead_source", "lead_id", "created_date", "leads", "(SELECT date AS report_date FROM dim_date)")
    + ")",
)
def m_rolling_leads(inputs: Inputs) -> DataFrame:
    """Daily reports."""
    leads = inputs.stored_silver("hubspot_leads")[0]
    return rolling_distinct(leads, "lead_id", "created_date", ["lead_source"], "leads", report_dates(inputs.dim("dim_date")))


@query(
    "m_rolling_won",
    "SELECT community_key, CAST(report_date AS VARCHAR) AS report_date, won_leads FROM ("
    + _counts("fact_hubspot_leads", "community_key", "lead_id", "created_date", "won_leads", "month_ends", "status = 'Won'")
    + ")",
)
def m_rolling_won(inputs: Inputs) -> DataFrame:
    leads = inputs.stored_fact("fact_hubspot_leads")
    won = leads.withColumn("lead_id", F.when(F.col("status") == "Won", F.col("lead_id")))
    reports = report_dates(inputs.dim("dim_date"), "month")
    return rolling_distinct(won, "lead_id", "created_date", ["community_key"], "won_leads", reports)


_WON = _counts("silver_hubspot_leads", "lead_source", "lead_id", "created_date", "won_leads", "month_ends", "status = 'Won'")
_ALL = _counts("silver_hubspot_leads", "lead_source", "lead_id", "created_date", "leads", "month_ends")


@query(
    "m_conversion_rate",
    f"""SELECT lead_source, CAST(report_date AS VARCHAR) AS report_date, leads, won_leads,
               coalesce(CAST(won_leads AS DOUBLE) / nullif(leads, 0), 0) AS conversion_rate
        FROM ({_ALL}) JOIN ({_WON}) USING (lead_source, report_date)""",
)
def m_conversion_rate(inputs: Inputs) -> DataFrame:
    return measures.lead_conversion(inputs.stored_silver("hubspot_leads")[0], inputs.dim("dim_date"), ["lead_source"])


@query(
    "m_occupied_units_daily",
    """SELECT g.community_key, CAST(d.date AS VARCHAR) AS report_date, count(DISTINCT l.unit_key) AS occupied_units
       FROM (SELECT DISTINCT community_key FROM fact_leases) g CROSS JOIN dim_date d
       LEFT JOIN (SELECT DISTINCT community_key, unit_key, move_in_date, move_out_date FROM fact_leases) l
         ON l.community_key IS NOT DISTINCT FROM g.community_key AND l.move_in_date <= d.date AND coalesce(l.move_out_date, DATE '9999-01-01') >= d.date
       GROUP BY ALL""",
)
def m_occupied_units_daily(inputs: Inputs) -> DataFrame:
    """Every day of the calendar."""
    leases = inputs.stored_fact("fact_leases", "community_key", "unit_key", "move_in_date", "move_out_date")
    return measures.occupied_units(leases, inputs.dim("dim_date"), ["community_key"])


_ACTIVE_ROWS = "(SELECT community_key, resident_key, last_date FROM fact_residents WHERE status = 'Active')"


@query(
    "m_distinct_cube",
    " UNION ALL ".join(
        f"""SELECT '{unit}' AS level, community_key, CAST(date_trunc('{unit}', last_date) AS DATE)::VARCHAR AS at, count(DISTINCT resident_key) AS active_residents
            FROM {_ACTIVE_ROWS} GROUP BY ALL"""
        for unit in ("month", "quarter", "year")
    )
    + f""" UNION ALL SELECT 'all communities', NULL, CAST(date_trunc('month', last_date) AS DATE)::VARCHAR, count(DISTINCT resident_key) FROM {_ACTIVE_ROWS} GROUP BY ALL
           UNION ALL SELECT 'trailing', community_key, CAST(report_date AS VARCHAR), active FROM (
           {_counts(_ACTIVE_ROWS, "community_key", "resident_key", "last_date", "active", "month_ends")})""",
)
def m_distinct_cube(inputs: Inputs) -> DataFrame:
    """Active residents of every period and trailing window from one cube, one scan of the fact."""
    active = inputs.fact("fact_residents").filter("status = 'Active'")
    cube = materialise(distinct_cube(active, "resident_key", "last_date", ["community_key"]), "resident_cube")
    counts = "active_residents"
    parts = [
        distinct_per(cube, ["community_key", F.trunc("day", unit).alias("at")], counts).withColumn("level", F.lit(unit))
        for unit in ("month", "quarter", "year")
    ]
    whole = distinct_per(cube, [F.trunc("day", "month").alias("at")], counts)
    parts.append(whole.withColumns({"level": F.lit("all communities"), "community_key": F.lit(None).cast("long")}))
    trailing = distinct_trailing(cube, ["community_key"], report_dates(inputs.dim("dim_date"), "month"), counts)
    parts.append(trailing.withColumnRenamed("report_date", "at").withColumn("level", F.lit("trailing")))
    return reduce(DataFrame.unionByName, parts)
