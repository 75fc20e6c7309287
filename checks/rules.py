"""Constraints and anomaly reports."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import oracle as o
from checks.inputs import Inputs
from checks.registry import query
from lakestrata.operators import quality
from lakestrata.plans.run import key_counts_of, rules_of
from lakestrata.schemas import EXPECTED_COMMUNITIES, FACTS, LEAD_STATUSES
from lakestrata.session import in_parallel, materialise


def _together(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _violations(table: str, broken: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{rule}' AS rule, count(*) AS violations FROM {source} WHERE {condition}"
        for rule, condition in broken.items()
    )


_UNIQUE = {
    "fact_leases": ("lease_id",),
    "fact_hubspot_leads": ("lead_id",),
    "fact_care_history": ("resident_key", "change_date"),
    "fact_units": ("unit_key", "community_key", "snapshot_date"),
}


@query(
    "dq_unique",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", 'unique ({', '.join(k)})' AS rule, count(*) AS violations, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows
            FROM (SELECT count(*) AS n FROM {t} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in k)} GROUP BY {', '.join(k)} HAVING count(*) > 1)"""
        for t, k in _UNIQUE.items()
    ),
)
def dq_unique(inputs: Inputs) -> DataFrame:
    return _together([quality.unique_violations(inputs.fact(t, *k), t, k) for t, k in _UNIQUE.items()])


_REQUIRED = ("fact_adp_shifts", "fact_incidents", "fact_residents")


@query(
    "dq_not_null",
    " UNION ALL ".join(
        _violations(t, {f"{c} is null": f"{c} IS NULL" for c in FACTS[t].required}, t) for t in _REQUIRED
    ),
)
def dq_not_null(inputs: Inputs) -> DataFrame:
    facts = in_parallel(*[partial(inputs.fact, name, *FACTS[name].required) for name in _REQUIRED])
    return _together(
        [
            quality.count_violations(fact, t, quality.not_null(FACTS[t].required))
            for t, fact in zip(_REQUIRED, facts)
        ]
    )


# Every declared reference, and that of the level before a change, which the star does not declare.
_REFERENCES = (
    *((t, c, d, dc) for t, table in FACTS.items() for c, d, dc in table.references),
    ("fact_care_history", "previous_level", "dim_care_level", "care_level"),
)


@query(
    "dq_foreign_key",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c} in dimension' AS rule, count(*) AS violations FROM {t} f
            WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {d if d != 'dim_care_level' else '(SELECT care_level FROM clean_pcc_residents)'} d WHERE d.{dc} = f.{c})"""
        for t, c, d, dc in _REFERENCES
    ),
)
def dq_foreign_key(inputs: Inputs) -> DataFrame:
    """The references of a fact share one scan of it and one table of key counts; the members of a
    dimension are written once for all references to it."""
    facts = dict.fromkeys(t for t, _, _, _ in _REFERENCES)
    members = dict.fromkeys((d, dc) for _, _, d, dc in _REFERENCES)

    def counts(name: str) -> DataFrame:
        columns = [c for t, c, _, _ in _REFERENCES if t == name]
        return materialise(quality.key_counts(inputs.fact(name, *columns), {c: [c] for c in columns}), "keys")

    def written(dim: str, column: str) -> DataFrame:
        return materialise(inputs.dim(dim).select(column).distinct(), dim)

    found = dict(zip(facts, in_parallel(*[partial(counts, t) for t in facts])))
    dims = dict(zip(members, in_parallel(*[partial(written, *m) for m in members])))
    return _together([quality.foreign_report(found[t], t, c, dims[d, dc], dc) for t, c, d, dc in _REFERENCES])


@query(
    "dq_check_range",
    " UNION ALL ".join(
        [
            _violations("fact_gbp_reviews", {"rating out of range": "rating < 1 OR rating > 5"}, "fact_gbp_reviews"),
            _violations("fact_incidents", {"severity out of range": "severity < 1 OR severity > 5"}, "fact_incidents"),
            _violations("fact_leases", {"monthly_rate out of range": "monthly_rate < 0"}, "fact_leases"),
            _violations(
                "fact_residents",
                {
                    "acuity_score out of range": "acuity_score < 0",
                    "discharged_resident_count out of range": "discharged_resident_count < 0 OR discharged_resident_count > 1",
                },
                "fact_residents",
            ),
        ]
    ),
)
def dq_check_range(inputs: Inputs) -> DataFrame:
    rules = {
        "fact_gbp_reviews": quality.in_range("rating", 1, 5),
        "fact_incidents": quality.in_range("severity", 1, 5),
        "fact_leases": quality.in_range("monthly_rate", 0),
        "fact_residents": quality.in_range("acuity_score", 0)
        | quality.in_range("discharged_resident_count", 0, 1),
    }
    return _together([inputs.violations(t, r) for t, r in rules.items()])


@query(
    "dq_check_set",
    " UNION ALL ".join(
        [
            _violations("leads", {"status not allowed": "status NOT IN ('Won', 'Lost', 'Open')"}, "clean_hubspot_leads"),
            _violations("raw leads", {"status not allowed": "status NOT IN ('Won', 'Lost', 'Open')"}, "raw_hubspot_leads"),
        ]
    ),
)
def dq_check_set(inputs: Inputs) -> DataFrame:
    """Before cleansing the won leads carry a blank, after it none does."""
    rule = quality.in_set("status", LEAD_STATUSES)
    return _together(
        [
            quality.count_violations(inputs.clean("hubspot_leads"), "leads", rule),
            quality.count_violations(inputs.raw("hubspot_leads"), "raw leads", rule),
        ]
    )


_ORDERS = {
    "fact_gbp_reviews": (("review_date", "responded_at"),),
    "fact_hubspot_leads": (
        ("created_date", "tour_date"),
        ("created_date", "deposit_date"),
        ("created_date", "move_in_date"),
        ("deposit_date", "move_in_date"),
    ),
    "fact_leases": (("move_in_date", "move_out_date"),),
    "fact_residents": (("admit_date", "discharge_date"),),
}


@query(
    "dq_date_order",
    " UNION ALL ".join(
        _violations(t, {f"{b} before {a}": f"{b} < {a}" for a, b in pairs}, t) for t, pairs in _ORDERS.items()
    ),
)
def dq_date_order(inputs: Inputs) -> DataFrame:
    """Includes the sales funnel: move-ins before the deposit."""
    return _together([inputs.violations(t, quality.ordered_dates(p)) for t, p in _ORDERS.items()])


_TYPES = {
    "pcc_residents": {"resident_id": "varchar(7)", "acuity_score": "decimal(5,2)", "care_level": "varchar(10)"},
    "adp_shifts": {"shift_id": "varchar(5)", "hours_worked": "decimal(8,2)", "hourly_rate": "decimal(8,2)"},
    "gbp_reviews": {"rating": "smallint", "response_text": "varchar(12)"},
}


def _misfit(column: str, declared: str) -> str:
    if declared.startswith("varchar"):
        return f"length({column}) > {declared[8:-1]}"
    return f"NOT {o.blank(column)} AND TRY_CAST({column} AS {declared}) IS NULL"


@query(
    "dq_type_conform",
    " UNION ALL ".join(
        _violations(d, {f"{c} is no {t}": _misfit(c, t) for c, t in types.items()}, f"raw_{d}")
        for d, types in _TYPES.items()
    ),
)
def dq_type_conform(inputs: Inputs) -> DataFrame:
    return _together(
        [quality.count_violations(inputs.raw(d), d, quality.typed(t)) for d, t in _TYPES.items()]
    )


def _side(side: str, other: str, table: str, other_table: str) -> str:
    return f"""SELECT '{side}' AS side, count(*) AS id_rows, count(DISTINCT {side}) AS distinct_ids,
                      CAST(min(length({side})) AS INT) AS shortest, CAST(max(length({side})) AS INT) AS longest,
                      count(DISTINCT {side}) FILTER ({side} IN (SELECT {other} FROM {other_table} WHERE {other} IS NOT NULL)) AS shared_ids
               FROM {table} WHERE {side} IS NOT NULL"""


@query(
    "id_domain_overlap",
    _side("employee_id", "reported_by", "clean_adp_shifts", "clean_pcc_incidents")
    + " UNION ALL "
    + _side("reported_by", "employee_id", "clean_pcc_incidents", "clean_adp_shifts"),
)
def id_domain_overlap(inputs: Inputs) -> DataFrame:
    return quality.domain_overlap(
        inputs.clean("adp_shifts", "employee_id"),
        "employee_id",
        inputs.clean("pcc_incidents", "reported_by"),
        "reported_by",
    )


_REPEATED = ("yardi_leases", "pcc_incidents", "gbp_reviews")


@query(
    "duplicate_analysis",
    " UNION ALL ".join(
        f"""SELECT '{d}' AS "table", (SELECT count(*) FROM raw_{d}) AS all_rows,
                   (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{d})) AS distinct_with_metadata,
                   (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (source_file, row_ordinal) FROM raw_{d})) AS distinct_without_metadata"""
        for d in _REPEATED
    ),
)
def duplicate_analysis(inputs: Inputs) -> DataFrame:
    reports = []
    for d in _REPEATED:
        rows = inputs.raw(d)
        business = [c for c in rows.columns if c not in ("source_file", "row_ordinal")]
        reports.append(quality.duplicate_report(rows, d, business))
    return _together(reports)


@query(
    "unexpected_members",
    "SELECT community_id, count(*) AS row_count FROM clean_yardi_units WHERE community_id NOT IN ("
    + ", ".join(f"'{c}'" for c in EXPECTED_COMMUNITIES)
    + ") GROUP BY ALL",
)
def unexpected_members(inputs: Inputs) -> DataFrame:
    return quality.unexpected_members(inputs.clean("yardi_units", "community_id"), "community_id", EXPECTED_COMMUNITIES)


@query(
    "conflicting_keys",
    """SELECT lease_id, count(DISTINCT (unit_id, monthly_rate, resident_id)) AS versions, count(*) AS row_count
       FROM clean_yardi_leases GROUP BY lease_id HAVING count(DISTINCT (unit_id, monthly_rate, resident_id)) > 1""",
)
def conflicting_keys(inputs: Inputs) -> DataFrame:
    return quality.conflicting_keys(
        inputs.clean("yardi_leases"), "lease_id", ["unit_id", "monthly_rate", "resident_id"]
    )


@query(
    "dq_quarantine",
    """SELECT lead_id, CAST(created_date AS VARCHAR) AS created_date, CAST(deposit_date AS VARCHAR) AS deposit_date,
              CAST(move_in_date AS VARCHAR) AS move_in_date,
              concat_ws('; ', CASE WHEN move_in_date < deposit_date THEN 'move_in_date before deposit_date' END,
                              CASE WHEN tour_date IS NULL THEN 'tour_date is null' END) AS broken_rules
       FROM clean_hubspot_leads WHERE move_in_date < deposit_date OR tour_date IS NULL""",
)
def dq_quarantine(inputs: Inputs) -> DataFrame:
    broken = quality.ordered_dates([("deposit_date", "move_in_date")]) | quality.not_null(["tour_date"])
    marked = quality.quarantine(inputs.clean("hubspot_leads"), broken)
    rules = F.array_join("broken_rules", "; ").alias("broken_rules")
    return marked.select("lead_id", "created_date", "deposit_date", "move_in_date", rules)


def _rules_sql(table: str) -> str:
    """The names of the rules a row ``f`` of a fact breaks, from its declaration."""
    spec = FACTS[table]
    rules = [(f"{c} is null", f"f.{c} IS NULL") for c in spec.required]
    rules += [(f"{c} out of range", f"f.{c} < {low}") for c, low in spec.at_least]
    rules += [(f"{c} out of range", f"f.{c} < {low} OR f.{c} > {high}") for c, low, high in spec.between]
    rules += [(f"{c} not allowed", f"f.{c} NOT IN ({', '.join(repr(v) for v in allowed)})") for c, allowed in spec.one_of]
    rules += [(f"{b} before {a}", f"f.{b} < f.{a}") for a, b in spec.date_order]
    for key in spec.unique:
        same = " AND ".join(f"{c} IS NOT NULL" for c in key)
        names = ", ".join(key)
        rules.append((f"unique ({names})", f"({', '.join(f'f.{c}' for c in key)}) IN (SELECT ({names}) FROM {table} WHERE {same} GROUP BY {names} HAVING count(*) > 1)"))
    for column, dim, dim_column in spec.references:
        rules.append((f"{column} in dimension", f"f.{column} IS NOT NULL AND f.{column} NOT IN (SELECT {dim_column} FROM {dim} WHERE {dim_column} IS NOT NULL)"))
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {condition} THEN '{name}' END" for name, condition in rules) + ")"


_SET_APART = {"fact_incidents": "incident_id", "fact_hubspot_leads": "lead_id"}


@query(
    "dq_quarantine_tables",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", {key} AS id, broken_rules, count(*) AS row_count
            FROM (SELECT *, {_rules_sql(t)} AS broken_rules FROM {t} f) WHERE broken_rules <> '' GROUP BY ALL"""
        for t, key in _SET_APART.items()
    ),
)
def dq_quarantine_tables(inputs: Inputs) -> DataFrame:
    """Rows of two facts that break any declared rule, keys and references included."""
    parts = []
    for (name, key), fact in zip(_SET_APART.items(), inputs.stored_facts(*_SET_APART)):
        table = FACTS[name]
        references = [(column, inputs.dim(dim), dim_column) for column, dim, dim_column in table.references]
        apart = quality.quarantine_table(fact, rules_of(table), key_counts_of(fact, table), table.unique, references)
        rules = F.array_join("broken_rules", "; ").alias("broken_rules")
        parts.append(apart.groupBy(F.lit(name).alias("table"), F.col(key).alias("id"), rules).agg(F.count("*").alias("row_count")))
    return _together(parts)
