"""Duplicates, keys, dimensions, joins, facts and the analysis queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import oracle as o
from checks.inputs import RAW, Inputs
from checks.registry import day, query, real
from lakestrata.operators import joins, windows
from lakestrata.operators.dedupe import first_by_key
from lakestrata.operators.keys import kept_keys, surrogate_keys, union_distinct
from lakestrata.plans import analysis, months
from lakestrata.session import materialise, new_shared_path
from lakestrata.sources import layers

YEAR = ("1998-01-01", "1999-01-01")

_LEASE_TEXTS = "lease_id, resident_id, unit_id, community_id, move_out_reason, monthly_rate, source_file, row_ordinal"


@query(
    "dedupe_keep_first",
    f"SELECT {_LEASE_TEXTS}, {day('move_in_date', 'move_out_date')} FROM silver_yardi_leases",
)
def dedupe_keep_first(inputs: Inputs) -> DataFrame:
    return inputs.silver("yardi_leases")


@query(
    "dedupe_by_key",
    """SELECT lease_id, community_id, unit_id, monthly_rate FROM (
         SELECT *, row_number() OVER (PARTITION BY lease_id ORDER BY source_file, row_ordinal, unit_id, monthly_rate) AS nth
         FROM clean_yardi_leases) WHERE nth = 1""",
)
def dedupe_by_key(inputs: Inputs) -> DataFrame:
    """Lease records share ids; the id's first record wins (two more columns decide ties)."""
    order = ["source_file", "row_ordinal", "unit_id", "monthly_rate"]
    attributes = ["community_id", "unit_id", "monthly_rate"]
    return first_by_key(inputs.clean("yardi_leases"), ["lease_id"], attributes, order)


_WITH_RESIDENT = [d for d in RAW if d in ("pcc_residents", "pcc_incidents", "pcc_care_history", "yardi_leases")]


@query(
    "union_distinct_keys",
    " UNION ".join(f"SELECT resident_id FROM clean_{d}" for d in _WITH_RESIDENT),
)
def union_distinct_keys(inputs: Inputs) -> DataFrame:
    return union_distinct([inputs.clean(d, "resident_id") for d in _WITH_RESIDENT], "resident_id")


@query(
    "surrogate_keys",
    """SELECT resident_id, row_number() OVER (ORDER BY resident_id NULLS FIRST) - 1 AS resident_key
       FROM (SELECT DISTINCT resident_id FROM clean_pcc_incidents)""",
)
def surrogate_key_query(inputs: Inputs) -> DataFrame:
    """Incidents hold a NULL resident id, which gets key 0."""
    members = inputs.clean("pcc_incidents", "resident_id").distinct()
    return surrogate_keys(members, "resident_id", "resident_key")


@query(
    "surrogate_keys_kept",
    """WITH dated AS (SELECT resident_id, incident_date FROM clean_pcc_incidents),
            cut AS (SELECT min(incident_date) + CAST((max(incident_date) - min(incident_date)) // 2 AS INTEGER) AS day FROM dated),
            early AS (SELECT DISTINCT resident_id FROM dated, cut WHERE incident_date < day),
            late AS (SELECT DISTINCT resident_id FROM dated, cut WHERE incident_date >= day OR incident_date IS NULL),
            numbered AS (SELECT resident_id, row_number() OVER (ORDER BY resident_id) AS key FROM early WHERE resident_id IS NOT NULL),
            added AS (SELECT resident_id, row_number() OVER (ORDER BY resident_id) + (SELECT max(key) FROM numbered) AS key
                      FROM late WHERE resident_id IS NOT NULL AND resident_id NOT IN (SELECT resident_id FROM numbered)),
            every AS (SELECT * FROM numbered UNION ALL SELECT * FROM added
                      UNION ALL SELECT DISTINCT CAST(NULL AS VARCHAR), 0 FROM dated WHERE resident_id IS NULL)
       SELECT resident_id, key AS resident_key, EXISTS (SELECT 1 FROM late l WHERE l.resident_id IS NOT DISTINCT FROM e.resident_id) AS is_current
       FROM every e""",
)
def surrogate_keys_kept(inputs: Inputs) -> DataFrame:
    """Residents of the incidents of the first half, numbered; then those of the second half: some
    ids stay, some are new and some are gone."""
    dated = inputs.clean("pcc_incidents", "resident_id", "incident_date")
    half = F.expr("CAST(datediff(max(incident_date), min(incident_date)) div 2 AS INT)")
    cut = dated.agg(F.date_add(F.min("incident_date"), half)).scalar()
    early = dated.filter(F.col("incident_date") < cut).select("resident_id").distinct()
    late = dated.filter((F.col("incident_date") >= cut) | F.col("incident_date").isNull()).select("resident_id").distinct()
    late = materialise(late.withColumn("is_current", F.lit(True)), "late_residents")
    known = materialise(surrogate_keys(early, "resident_id", "resident_key"), "known_residents")
    stored = known.withColumn("is_current", F.lit(False))
    return kept_keys(late, "resident_id", "resident_key", stored).select("resident_id", "resident_key", "is_current")


@query("dim_community", "SELECT community_id, community_key FROM dim_community")
def dim_community(inputs: Inputs) -> DataFrame:
    return inputs.dim("dim_community")


@query("dim_employee", "SELECT employee_id, role, employee_key FROM dim_employee")
def dim_employee(inputs: Inputs) -> DataFrame:
    return inputs.dim("dim_employee")


@query(
    "dim_residents",
    f"SELECT resident_id, first_name, last_name, {day('dob')}, gender, resident_key FROM dim_residents",
)
def dim_residents(inputs: Inputs) -> DataFrame:
    return inputs.dim("dim_residents")


@query("dim_unit", "SELECT unit_id, unit_type, unit_key FROM dim_unit")
def dim_unit(inputs: Inputs) -> DataFrame:
    return inputs.dim("dim_unit")


@query("dim_date", f"SELECT {day('date')}, year, month, month_name, day FROM dim_date")
def dim_date(inputs: Inputs) -> DataFrame:
    return inputs.dim("dim_date")


@query("dim_care_level", "SELECT DISTINCT care_level FROM clean_pcc_residents")
def dim_care_level(inputs: Inputs) -> DataFrame:
    return inputs.dim("dim_care_level")


@query(
    "star_key_lookup",
    """SELECT shift_id, f.employee_id, f.source_file, employee_key
       FROM clean_adp_shifts f LEFT JOIN dim_employee d ON d.employee_id IS NOT DISTINCT FROM f.employee_id""",
)
def star_key_lookup(inputs: Inputs) -> DataFrame:
    """Shifts without an employee id find the dimension's NULL member (key 0)."""
    shifts = inputs.clean("adp_shifts", "shift_id", "employee_id", "source_file")
    return joins.lookup_key(shifts, inputs.dim("dim_employee"), "employee_id", "employee_key")


@query(
    "interval_join",
    f"""SELECT u.unit_id, u.community_id, CAST(u.snapshot_date AS VARCHAR) AS snapshot_date, l.lease_id,
               CAST(l.move_in_date AS VARCHAR) AS move_in_date, CAST(l.move_out_date AS VARCHAR) AS move_out_date
        FROM silver_yardi_units u LEFT JOIN silver_yardi_leases l
          ON l.unit_id = u.unit_id AND l.community_id = u.community_id
         AND l.move_in_date <= u.snapshot_date AND (l.move_out_date IS NULL OR l.move_out_date >= u.snapshot_date)""",
)
def interval_join(inputs: Inputs) -> DataFrame:
    on = ["unit_id", "community_id"]
    # The units are read for their decades and for the join, the leases once.
    units = materialise(inputs.silver("yardi_units", *on, "snapshot_date"), "unit_dates")
    leases = inputs.silver("yardi_leases", *on, "lease_id", "move_in_date", "move_out_date")
    return joins.interval_join(units, leases, on, "snapshot_date", "move_in_date", "move_out_date")


@query(
    "month_aligned_join",
    f"""SELECT i.incident_id, i.resident_id, i.community_id, CAST(i.incident_date AS VARCHAR) AS incident_date,
               CAST(r.last_date AS VARCHAR) AS last_date, r.care_level
        FROM silver_pcc_incidents i JOIN silver_pcc_residents r
          ON i.resident_id = r.resident_id AND i.community_id = r.community_id
         AND date_trunc('month', i.incident_date) = date_trunc('month', r.last_date)""",
)
def month_aligned_join(inputs: Inputs) -> DataFrame:
    on = ["resident_id", "community_id"]
    incidents = inputs.silver("pcc_incidents").select("incident_id", *on, "incident_date")
    snapshots = inputs.silver("pcc_residents").select(*on, "last_date", "care_level")
    return joins.month_aligned_join(incidents, snapshots, on, "incident_date", "last_date")


@query(
    "distinct_count_by_group",
    "SELECT community_id, move_out_reason, count(DISTINCT lease_id) AS leases, count(DISTINCT resident_id) AS residents FROM clean_yardi_leases GROUP BY ALL",
)
def distinct_count_by_group(inputs: Inputs) -> DataFrame:
    return inputs.clean("yardi_leases").groupBy("community_id", "move_out_reason").agg(
        F.count_distinct("lease_id").alias("leases"), F.count_distinct("resident_id").alias("residents")
    )


@query(
    "share_of_total",
    f"""WITH counts AS (SELECT community_id, lead_source, count(DISTINCT lead_id) AS leads FROM clean_hubspot_leads GROUP BY ALL),
             totals AS (SELECT community_id, CAST(sum(leads) AS BIGINT) AS total FROM counts GROUP BY ALL)
        SELECT community_id, lead_source, leads, {o.percent('leads', 'total')} AS share FROM counts JOIN totals USING (community_id)""",
)
def share_of_total(inputs: Inputs) -> DataFrame:
    counts = inputs.clean("hubspot_leads").groupBy("community_id", "lead_source").agg(
        F.count_distinct("lead_id").alias("leads")
    )
    return windows.share_of_total(counts, ["community_id"], "leads", "share")


@query(
    "top_k_per_group",
    """SELECT l_suppkey, l_partkey, quantity, rank FROM (
         SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY quantity DESC, l_partkey) AS INT) AS rank
         FROM (SELECT l_suppkey, l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY ALL))
       WHERE rank <= 3""",
)
def top_k_per_group(inputs: Inputs) -> DataFrame:
    quantity = F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    counts = inputs.table("lineitem").groupBy("l_suppkey", "l_partkey").agg(quantity)
    return windows.top_k(counts, ["l_suppkey"], [F.desc("quantity"), F.asc("l_partkey")], 3)


_FACTS = {
    "fact_shifts": ("fact_adp_shifts", f"employee_key, community_key, shift_id, {day('shift_date')}, {real('hours_worked', 'standard_hourly_rate', 'total_labor_cost')}"),
    "fact_care_history": ("fact_care_history", f"resident_key, {day('change_date')}, previous_level, new_level, reason"),
    "fact_reviews": ("fact_gbp_reviews", f"review_id, community_key, {day('review_date', 'responded_at')}, rating, review_text, response_text"),
    "fact_leads": ("fact_hubspot_leads", f"lead_id, community_key, lead_source, {day('created_date', 'tour_date', 'deposit_date', 'move_in_date')}, status, lost_reason"),
    "fact_incidents": ("fact_incidents", f"incident_id, resident_key, community_key, {day('incident_date')}, incident_type, severity, reported_by"),
    "fact_leases": ("fact_leases", f"lease_id, resident_key, unit_key, community_key, {day('move_in_date', 'move_out_date')}, move_out_reason, {real('monthly_rate')}"),
    "fact_residents": ("fact_residents", f"resident_key, community_key, {day('admit_date', 'discharge_date', 'last_date')}, care_level, {real('acuity_score')}, mobility_status, status, discharged_resident_count"),
    "fact_units": ("fact_units", f"unit_key, community_key, unit_type, {real('monthly_rent')}, {day('snapshot_date')}"),
}
for _name, (_table, _columns) in _FACTS.items():
    query(_name, f"SELECT {_columns} FROM {_table}")(lambda inputs, table=_table: inputs.fact(table))


@query(
    "occupancy_by_community",
    f"""WITH unit_day AS (
          SELECT DISTINCT unit_key, community_key, snapshot_date FROM fact_units WHERE unit_key IS NOT NULL),
        judged AS (
          SELECT *, EXISTS (SELECT 1 FROM fact_leases l WHERE l.unit_key = unit_day.unit_key AND l.community_key = unit_day.community_key
                            AND unit_day.snapshot_date BETWEEN l.move_in_date AND coalesce(l.move_out_date, DATE '9999-12-31')) AS taken
          FROM unit_day)
        SELECT (SELECT community_id FROM dim_community c WHERE c.community_key = judged.community_key) AS community_id,
               CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS total_units, count(*) FILTER (taken) AS occupied_units,
               {o.percent('count(*) FILTER (taken)', 'count(*)')} AS occupancy_rate_percent
        FROM judged GROUP BY community_key, snapshot_date""",
)
def occupancy_by_community(inputs: Inputs) -> DataFrame:
    """Units are counted once a snapshot, however many of their rows or leases are equal."""
    units = inputs.distinct_fact("fact_units", "unit_key", "community_key", "snapshot_date")
    leases = inputs.distinct_fact("fact_leases", "unit_key", "community_key", "move_in_date", "move_out_date")
    return analysis.occupancy_by_community(units, leases, inputs.dim("dim_community"))


@query(
    "top_moveout_reasons",
    f"""WITH gone AS (
          SELECT DISTINCT community_key, move_out_reason AS reason, lease_id FROM fact_leases
          WHERE year(move_out_date) = {YEAR[0][:4]} AND nullif(move_out_reason, 'N/A') IS NOT NULL AND lease_id IS NOT NULL),
        tally AS (SELECT community_key, reason, count(*) AS n FROM gone GROUP BY ALL),
        whole AS (SELECT community_key, sum(n)::BIGINT AS total FROM tally GROUP BY ALL)
        SELECT community_id, reason AS move_out_reason, n AS move_outs, {o.percent('n', 'total')} AS move_out_percentage
        FROM tally t NATURAL JOIN whole NATURAL JOIN dim_community
        WHERE (SELECT count(*) FROM tally b WHERE b.community_key = t.community_key AND (b.n > t.n OR b.n = t.n AND b.reason < t.reason)) < 3""",
)
def top_moveout_reasons(inputs: Inputs) -> DataFrame:
    return analysis.top_moveout_reasons(inputs.fact("fact_leases"), inputs.dim("dim_community"), *YEAR)


@query(
    "incident_rate",
    f"""WITH level_of AS (
          SELECT DISTINCT resident_key, community_key, year(last_date) * 12 + month(last_date) AS m, care_level FROM fact_residents),
        seen AS (
          SELECT DISTINCT incident_id, i.community_key, v.care_level
          FROM (SELECT incident_id, resident_key, community_key, year(incident_date) * 12 + month(incident_date) AS m FROM fact_incidents) i
          JOIN level_of v USING (resident_key, community_key, m)),
        present AS (
          SELECT DISTINCT community_key, care_level, last_date, resident_key FROM fact_residents WHERE status = 'Active' AND resident_key IS NOT NULL),
        line AS (
          SELECT community_key, care_level, sum(day(last_date))::BIGINT AS total_resident_days,
                 (SELECT count(incident_id) FROM seen s WHERE s.community_key = present.community_key AND s.care_level = present.care_level) AS total_incidents
          FROM present GROUP BY community_key, care_level)
        SELECT community_id, care_level, total_incidents, total_resident_days,
               {o.percent('total_incidents', 'total_resident_days')} AS incidents_per_100_resident_days
        FROM line NATURAL JOIN dim_community""",
)
def incident_rate(inputs: Inputs) -> DataFrame:
    columns = ("resident_key", "community_key", "last_date", "care_level", "status")
    residents = inputs.stored_fact("fact_residents", *columns)
    incidents = inputs.fact("fact_incidents", "incident_id", "resident_key", "community_key", "incident_date")
    return analysis.incident_rate(incidents, residents, inputs.dim("dim_community"))


@query(
    "fact_month_partitions",
    """WITH dated AS (SELECT CAST(date_trunc('month', incident_date) AS DATE) AS month, severity FROM fact_incidents),
            newest AS (SELECT max(month) AS last FROM dated)
       SELECT CAST(month AS VARCHAR) AS month, count(*) AS row_count,
              CAST(sum(severity + CASE WHEN month = last THEN 1 ELSE 0 END) AS BIGINT) AS severities,
              coalesce(month = last, false) AS was_rewritten,
              coalesce(month > last - INTERVAL 3 MONTH, false) AS read_for_quarter
       FROM dated, newest GROUP BY month, last""",
)
def fact_month_partitions(inputs: Inputs) -> DataFrame:
    """Incidents filed by month; the last month is delivered again with other severities, and the
    quarter up to it is read. Which partitions that wrote and read comes from their files."""
    spark = inputs.spark
    path = new_shared_path(spark, "fact_by_month")
    months.write_fact(inputs.fact("fact_incidents"), "fact_incidents", path)
    before = layers.current(spark, path).folders
    dated = [layers.partition_values(p)[months.MONTH] for p in before]
    last = max(m for m in dated if m is not None)
    end = str(spark.range(1).select(F.last_day(F.lit(last).cast("date"))).first()[0])
    again = months.read_fact(spark, path, "fact_incidents", last, end)
    months.write_fact(again.withColumn("severity", (F.col("severity") + 1).cast("smallint")), "fact_incidents", path, [last])
    after = layers.current(spark, path).folders

    begin = str(spark.range(1).select(F.add_months(F.lit(last).cast("date"), -2)).first()[0])
    quarter = set(months.read_fact(spark, path, "fact_incidents", begin, end).inputFiles())
    seen = [
        (layers.partition_values(p)[months.MONTH], folder != before[p], any(f"/{folder}/" in file for file in quarter))
        for p, folder in after.items()
    ]
    partitions = spark.createDataFrame(seen, "month string, was_rewritten boolean, read_for_quarter boolean")
    rows = months.read_fact(spark, path, "fact_incidents").groupBy(F.trunc("incident_date", "MM").cast("string").alias("month")).agg(
        F.count("*").alias("row_count"), F.sum("severity").cast("long").alias("severities")
    )
    return joins.null_safe_join(rows, partitions, ["month"], "left")
