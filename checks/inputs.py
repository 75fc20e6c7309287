"""The given tables in the shape of raw extracts: text cells, mixed formats, repeated rows.

Each extract is one SQL text which Spark and the oracle engine both run, so both sides start
from equal rows. Only the month list is written differently (``{months}``). Every extract is
made of whole tables; ``resent`` rows are repeated on top of them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators import quality
from lakestrata.operators.calendar import calendar
from lakestrata.operators.dedupe import FILE_ORDER, ROW_HASHES, first_by_key, with_row_hashes
from lakestrata.plans import gold
from lakestrata.plans.silver import SPECS, business_columns, clean_cell, cleanse, silver
from lakestrata.schemas import DATASETS, FACTS
from lakestrata.session import in_parallel, materialise, tune

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations")

# Snapshots are taken at the start of every month from that of the first order to that of the last.
SPARK_MONTHS = "explode((SELECT sequence(CAST(date_trunc('MONTH', min(o_orderdate)) AS DATE), CAST(date_trunc('MONTH', max(o_orderdate)) AS DATE), INTERVAL 1 MONTH) FROM orders))"
ORACLE_MONTHS = "CAST(unnest((SELECT generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH) FROM orders)) AS DATE)"


# Rows of a table which a task repeats for each month.
ROWS_OF_TASK = 4096


def text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def padded(x: str, n: int) -> str:
    return f"lpad({text(x)}, {n}, '0')"


def iso(d: str) -> str:
    return text(f"CAST({d} AS DATE)")


def month_first(d: str) -> str:
    return f"({text(f'month({d})')} || '/' || {text(f'day({d})')} || '/' || {text(f'year({d})')})"


def month_first_padded(d: str) -> str:
    return f"({padded(f'month({d})', 2)} || '/' || {padded(f'day({d})', 2)} || '/' || {text(f'year({d})')})"


def digits(d: str) -> str:
    return f"({text(f'year({d})')} || {padded(f'month({d})', 2)} || {padded(f'day({d})', 2)})"


def mixed(d: str, key: str) -> str:
    return (
        f"CASE {key} % 5 WHEN 0 THEN {month_first(d)} WHEN 1 THEN {month_first_padded(d)} "
        f"WHEN 2 THEN '  ' || {iso(d)} || chr(9) ELSE {iso(d)} END"
    )


def mixed_lenient(d: str, key: str) -> str:
    return (
        f"CASE {key} % 7 WHEN 0 THEN {month_first(d)} WHEN 1 THEN {digits(d)} "
        f"WHEN 2 THEN {iso(d)} || ' 10:30' WHEN 3 THEN ' ' || {iso(d)} ELSE {iso(d)} END"
    )


def community(x: str, n: int = 14) -> str:
    return f"('C' || {padded(f'({x}) % {n} + 1', 3)})"


def resident(x: str) -> str:
    return f"('R' || {padded(x, 7)})"


def monthly_file(dataset: str, d: str) -> str:
    return f"('{dataset}_' || {text(f'year({d})')} || '_' || {padded(f'month({d})', 2)} || '.csv')"


_RATES = """replace('{"CNA": 18.5, "RN": 42, "Cook": 16.25}', '"', chr(39))"""
_ONE_RATE = """replace('{"CNA": 18.5}', '"', chr(39))"""
_SHIP = "CAST(l_shipdate AS DATE)"
_ORDERED = "CAST(o_orderdate AS DATE)"
_REVIEWED = "(DATE '2024-01-01' + CAST(doc_id % 180 AS INT))"
_RECORD = "l_orderkey * 10 + l_linenumber"

@dataclass(frozen=True)
class Snapshots:
    """An extract which has every row of a table once a month: its cells by name, the months in the
    column ``snap``, and the same rows without their months, with the columns ``keys`` that cells
    with ``snap`` read besides."""

    table: str
    cells: dict[str, str]
    monthly: str
    rows: str
    keys: tuple[str, ...]

    def sql(self) -> str:
        return "\n        SELECT " + ",\n               ".join(f"{c} AS {name}" for name, c in self.cells.items()) + self.monthly

    def lasting_sql(self) -> str:
        """The cells that are the same in every month, one row for each row of the table."""
        lasting = [f"{c} AS {name}" for name, c in self.cells.items() if "snap" not in c]
        return f"SELECT {', '.join([*lasting, *self.keys])} {self.rows}"

    def laid_out_sql(self, lasting: str) -> str:
        """All cells, from a view of the lasting ones."""
        cells = [f"{c} AS {name}" if "snap" in c else name for name, c in self.cells.items()]
        return f"SELECT {', '.join(cells)} FROM (SELECT *, {{months}} AS snap FROM {lasting}) l"


SNAPSHOTS = {
    "pcc_residents": Snapshots(
        "customer",
        {
            "resident_id": f"""{resident('c_custkey')}""",
            "community_id": f"""{community('c_custkey')}""",
            "first_name": f"""c_mktsegment || ' '""",
            "last_name": f"""c_name""",
            "dob": f"""{mixed("(DATE '1930-01-01' + CAST(c_custkey % 9000 AS INT))", 'c_custkey')}""",
            "gender": f"""CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'None' END""",
            "admit_date": f"""{mixed('first_order', 'c_custkey')}""",
            "discharge_date": f"""CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'NULL' ELSE {mixed('last_order', 'c_custkey')} END""",
            "care_level": f"""CASE (c_custkey + month(snap)) % 7 WHEN 0 THEN 'AL' WHEN 1 THEN 'assisted ' WHEN 2 THEN ' IL' WHEN 3 THEN 'Independent Living' WHEN 4 THEN 'mc' WHEN 5 THEN 'MEMORY' ELSE 'Respite' END""",
            "acuity_score": f"""{text('CAST(c_acctbal AS DECIMAL(8,2))')}""",
            "mobility_status": f"""CASE c_custkey % 4 WHEN 0 THEN 'Walker' WHEN 1 THEN ' Cane' || chr(9) WHEN 2 THEN 'N/A' ELSE 'Wheelchair' END""",
            "source_file": f"""{monthly_file('pcc_residents', 'snap')}""",
            "row_ordinal": f"""c_custkey""",
        },
        """
        FROM (SELECT c_custkey, c_name, c_mktsegment, c_acctbal, {months} AS snap FROM customer) c
        LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_order, max(CAST(o_orderdate AS DATE)) AS last_order
                   FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""",
        """FROM customer c
           LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_order, max(CAST(o_orderdate AS DATE)) AS last_order
                      FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""",
        ("c_custkey",),
    ),
    "yardi_units": Snapshots(
        "part",
        {
            "unit_id": f"""'U' || {padded('p_partkey', 7)}""",
            "community_id": f"""{community('p_partkey', 16)}""",
            "unit_type": f"""CASE p_type WHEN 'STANDARD' THEN 'AL' WHEN 'SMALL' THEN 'IL' WHEN 'LARGE' THEN 'MC' WHEN 'ECONOMY' THEN 'Memory Care' WHEN 'MEDIUM' THEN ' Assisted' ELSE p_type END""",
            "monthly_rent": f"""{text('CAST(p_retailprice AS DECIMAL(12,2))')}""",
            "snapshot_date": f"""{mixed('snap', 'p_partkey')}""",
            "source_file": f"""{monthly_file('yardi_units', 'snap')}""",
            "row_ordinal": f"""p_partkey""",
        },
        """
        FROM (SELECT p_partkey, p_type, p_retailprice, {months} AS snap FROM part) p""",
        "FROM part",
        ("p_partkey",),
    ),
}

RAW = {
    "adp_shifts": f"""
        SELECT 'S' || {text(_RECORD)} AS shift_id,
               CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE 'E' || {padded('l_suppkey', 6)} END AS employee_id,
               {community('l_suppkey')} AS community_id,
               CASE l_returnflag WHEN 'A' THEN 'CNA' WHEN 'N' THEN 'RN  ' ELSE 'Cook' END AS role,
               {mixed_lenient(_SHIP, 'l_orderkey')} AS shift_date,
               CASE WHEN l_orderkey % 23 = 0 THEN '' ELSE {text('CAST(l_quantity AS DECIMAL(8,2))')} END AS hours_worked,
               CASE l_orderkey % 17 WHEN 0 THEN '' WHEN 1 THEN 'junk' WHEN 2 THEN {_ONE_RATE} ELSE {_RATES} END AS hourly_rate,
               {monthly_file('adp_shifts', _SHIP)} AS source_file,
               {_RECORD} AS row_ordinal
        FROM lineitem""",
    "gbp_reviews": f"""
        SELECT 'GR' || {text('doc_id')} AS review_id,
               {community('doc_id')} AS community_id,
               {mixed_lenient(_REVIEWED, 'doc_id')} AS review_date,
               {text('n_chars % 7')} AS rating,
               '  ' || text AS review_text,
               CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN ' NaN' WHEN 2 THEN NULL WHEN 3 THEN 'n/a' ELSE 'Thanks, ' || source END AS response_text,
               CASE WHEN doc_id % 5 = 4 THEN {iso(f"({_REVIEWED} + CAST(doc_id % 20 AS INT) - 3)")} ELSE '' END AS responded_at,
               {monthly_file('gbp_reviews', _REVIEWED)} AS source_file,
               doc_id AS row_ordinal
        FROM documents""",
    "hubspot_leads": f"""
        SELECT 'HL' || {padded('CASE WHEN o_orderkey % 50 = 1 THEN o_orderkey - 1 ELSE o_orderkey END', 8)} AS lead_id,
               {community('o_custkey')} AS community_id,
               substr(o_orderpriority, 3) AS lead_source,
               {mixed_lenient(_ORDERED, 'o_orderkey')} AS created_date,
               CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE {mixed(f"({_ORDERED} + 5)", 'o_orderkey')} END AS tour_date,
               CASE WHEN o_orderstatus = 'F' THEN {mixed(f"({_ORDERED} + 10)", 'o_orderkey')} ELSE 'N/A' END AS deposit_date,
               CASE WHEN o_orderstatus = 'F' THEN {mixed(f"({_ORDERED} + CAST(6 + o_orderkey % 9 AS INT))", 'o_orderkey')} ELSE NULL END AS move_in_date,
               CASE o_orderstatus WHEN 'F' THEN 'Won ' WHEN 'O' THEN 'Open' ELSE 'Lost' END AS status,
               CASE WHEN o_orderstatus <> 'P' THEN '' WHEN o_orderkey % 4 = 0 THEN 'Price' WHEN o_orderkey % 4 = 1 THEN ' nan' WHEN o_orderkey % 4 = 2 THEN NULL ELSE 'Moved' END AS lost_reason,
               {monthly_file('hubspot_leads', _ORDERED)} AS source_file,
               o_orderkey AS row_ordinal
        FROM orders""",
    "pcc_care_history": f"""
        SELECT {resident('user_id')} AS resident_id,
               {mixed_lenient('CAST(ts AS DATE)', 'event_id')} AS change_date,
               CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'AL' WHEN 2 THEN 'al' WHEN 3 THEN ' IL ' WHEN 4 THEN 'Memory' ELSE 'weird' END AS previous_level,
               CASE event_type WHEN 'click' THEN 'AL' WHEN 'purchase' THEN 'Assisted' WHEN 'error' THEN 'MC' WHEN 'signup' THEN 'IL' ELSE 'Independent Living' END AS new_level,
               event_type AS reason,
               {monthly_file('pcc_care_history', 'CAST(ts AS DATE)')} AS source_file,
               event_id AS row_ordinal
        FROM events""",
    "pcc_incidents": f"""
        SELECT 'I' || {text('o_orderkey')} AS incident_id,
               CASE WHEN o_orderkey % 101 = 0 THEN 'N/A' ELSE {resident('o_custkey')} END AS resident_id,
               {community('o_custkey')} AS community_id,
               CASE o_orderkey % 41 WHEN 0 THEN '2025-02-30' WHEN 1 THEN 'none' ELSE {mixed(_ORDERED, 'o_orderkey')} END AS incident_date,
               CASE o_orderkey % 31 WHEN 0 THEN ' NULL' ELSE '  ' || o_orderpriority || ' ' END AS incident_type,
               {text('o_orderkey % 6 + 1')} AS severity,
               'E' || {text('o_custkey % 500')} AS reported_by,
               {monthly_file('pcc_incidents', _ORDERED)} AS source_file,
               o_orderkey AS row_ordinal
        FROM orders""",
    "pcc_residents": SNAPSHOTS["pcc_residents"].sql(),
    "yardi_leases": f"""
        SELECT 'L' || {text(_RECORD)} AS lease_id,
               {resident('o_custkey')} AS resident_id,
               'U' || {padded('l_partkey', 7)} AS unit_id,
               {community('CASE WHEN l_orderkey % 11 = 0 THEN l_partkey + 1 ELSE l_partkey END', 16)} AS community_id,
               {mixed_lenient(f'least({_ORDERED}, {_SHIP})', 'l_orderkey')} AS move_in_date,
               CASE WHEN l_linestatus = 'O' AND l_orderkey % 2 = 0 THEN '' ELSE {mixed(f'greatest({_ORDERED}, {_SHIP})', 'l_orderkey')} END AS move_out_date,
               CASE WHEN l_linestatus = 'O' AND l_orderkey % 2 = 0 THEN '' WHEN l_orderkey % 13 = 0 THEN 'N/A' ELSE substr(o_orderpriority, 3) || ' ' END AS move_out_reason,
               {text('CAST(l_extendedprice AS DECIMAL(12,2))')} AS monthly_rate,
               {monthly_file('yardi_leases', f'least({_ORDERED}, {_SHIP})')} AS source_file,
               {_RECORD} AS row_ordinal
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "yardi_units": SNAPSHOTS["yardi_units"].sql(),
}

RESIDENT_ATTRIBUTES = ("resident_id", "first_name", "last_name", "dob", "gender")

# Rows which arrive a second time in a later file.
RESENT = {
    "yardi_leases": "row_ordinal % 10 = 3",
    "pcc_incidents": "row_ordinal % 10 = 3",
    "gbp_reviews": "row_ordinal % 10 = 7",
}


def raw_sql(dataset: str, months: str) -> str:
    rows = RAW[dataset].replace("{months}", months)
    if dataset not in RESENT:
        return rows
    columns = ", ".join(DATASETS[dataset])
    return (
        f"SELECT * FROM ({rows}) sent UNION ALL "
        f"SELECT {columns}, 'z_' || source_file AS source_file, row_ordinal FROM ({rows}) again WHERE {RESENT[dataset]}"
    )


class Inputs:
    """The layers built from the tables of one folder; each is built at most once per query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._built: dict[str, DataFrame] = {}
        self._locks: dict[str, Lock] = {}
        self._guard = Lock()
        tune(spark)

    def table(self, name: str) -> DataFrame:
        return self._once(name, lambda: self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def _once(self, name: str, build) -> DataFrame:
        with self._guard:
            lock = self._locks.setdefault(name, Lock())
        with lock:
            if name not in self._built:
                self._built[name] = build()
            return self._built[name]

    def raw(self, dataset: str) -> DataFrame:
        build = self._snapshots if dataset in SNAPSHOTS else lambda d: self._select(raw_sql(d, SPARK_MONTHS))
        return self._once(f"raw {dataset}", lambda: build(dataset))

    def _snapshots(self, dataset: str) -> DataFrame:
        """The rows of ``raw_sql``. The table is far smaller than its snapshots and would be read by
        a task or two: its rows are dealt out to as many tasks as their snapshots need, joined and
        put into text before they are repeated for each month."""
        spec, view = SNAPSHOTS[dataset], f"lasting_{dataset}"
        tasks = -(-self.table(spec.table).count() // ROWS_OF_TASK)
        self._select(spec.lasting_sql()).repartition(max(tasks, 1)).createOrReplaceTempView(view)
        return self._select(spec.laid_out_sql(view).replace("{months}", SPARK_MONTHS))

    def _select(self, sql: str) -> DataFrame:
        for table in TABLES:
            if re.search(rf"\b{table}\b", sql):
                self.table(table).createOrReplaceTempView(table)
        return self.spark.sql(sql)

    def clean(self, dataset: str, *columns: str) -> DataFrame:
        """Cleansed rows, all columns or the given raw ones."""
        raw = self.raw(dataset)
        return cleanse(raw.select(*columns) if columns else raw, SPECS[dataset])

    def silver(self, dataset: str, *columns: str) -> DataFrame:
        """Deduplicated rows, all columns or the given ones."""
        return silver(self.raw(dataset), SPECS[dataset], columns)

    def stored_silver(self, *datasets: str) -> list[DataFrame]:
        def store(dataset: str) -> DataFrame:
            return self._once(f"silver {dataset}", lambda: materialise(self.silver(dataset), dataset))

        return in_parallel(*[partial(store, d) for d in datasets])

    def dim(self, name: str) -> DataFrame:
        """Dimensions take the first row of each id, which duplicates cannot change, so they
        read the cleansed rows and not the deduplicated ones."""
        build = {
            "dim_community": lambda: gold.dim_community(
                [self.clean(d, "community_id") for d in RAW if "community_id" in DATASETS[d]]
            ),
            "dim_employee": lambda: gold.dim_employee(self._first_rows("adp_shifts", "employee_id", "role")),
            "dim_residents": lambda: gold.dim_residents(self._first_rows("pcc_residents", *RESIDENT_ATTRIBUTES)),
            "dim_unit": lambda: gold.dim_unit(self._first_rows("yardi_units", "unit_id", "unit_type")),
            "dim_date": self._dim_date,
            "dim_care_level": lambda: self.clean("pcc_residents", "care_level").distinct(),
        }
        return self._once(name, build[name])

    def _first_rows(self, dataset: str, key: str, *attributes: str) -> DataFrame:
        """The cleansed first row of each id. Which row is the first depends on no other cell than
        the id: the others are cleansed once for each id, not in every row."""
        spec = SPECS[dataset]
        rows = self.raw(dataset).select(clean_cell(key, spec).alias(key), *attributes, *FILE_ORDER)
        first = first_by_key(rows, [key], [*attributes, *FILE_ORDER])
        return first.withColumns({c: clean_cell(c, spec) for c in attributes})

    def _dim_date(self) -> DataFrame:
        """From the month of the first order to that of the last order or shipment."""
        orders = self.table("orders").select(F.col("o_orderdate").cast("date").alias("day"))
        shipped = self.table("lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
        bounds = orders.unionByName(shipped).agg(
            F.min(F.trunc("day", "MM")).alias("first"), F.max(F.last_day("day")).alias("last")
        )
        return calendar(bounds, "first", "last")

    def fact(self, name: str, *columns: str) -> DataFrame:
        """A fact straight from its raw rows, for one reader: no layer is written on the way. Of
        ``columns``, or all, only the dimensions of their keys are built."""
        return self._fact(name, columns)

    def distinct_fact(self, name: str, *columns: str) -> DataFrame:
        """``fact`` for a reader to which rows that are equal in ``columns`` are one: of rows with
        equal source columns there is one."""
        return self._fact(name, columns, once=True)

    def _fact(self, name: str, columns: Sequence[str], once: bool = False) -> DataFrame:
        dataset, lookups = gold.FACT_SOURCES[name]
        names = [dim for dim, _, key in lookups if not columns or key in columns]
        dims = in_parallel(*[partial(self.dim, dim) for dim in names])
        rows = silver(self.raw(dataset), SPECS[dataset], gold.source_columns(name, columns), once)
        return gold.fact(name, rows, dict(zip(names, dims)), columns=columns)

    def violations(self, name: str, broken: Mapping[str, Column]) -> DataFrame:
        """How many rows of a fact break each rule, of rules which look at no key."""
        dataset = gold.FACT_SOURCES[name][0]
        clean = self.clean(dataset)
        hashed = with_row_hashes(clean, business_columns(clean, SPECS[dataset]))
        rows = gold.fact(name, hashed, {}, ROW_HASHES)
        return quality.count_distinct_violations(rows, ROW_HASHES, name, broken)

    def stored_facts(self, *names: str, columns: Sequence[str] = ()) -> list[DataFrame]:
        """Written facts, for more than one reader, as analysis finds them; of ``columns`` those the
        facts have, or all."""

        def store(name: str) -> DataFrame:
            wanted = [c for c in FACTS[name].columns if not columns or c in columns]
            return self._once(f"{name} {wanted}", lambda: materialise(self.fact(name, *wanted), name))

        return in_parallel(*[partial(store, name) for name in names])

    def stored_fact(self, name: str, *columns: str) -> DataFrame:
        return self.stored_facts(name, columns=columns)[0]
