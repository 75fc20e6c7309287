"""The registered rule of foreign keys looks at every declared reference."""

from __future__ import annotations

import __spark_entry__ as entry
from lakestrata.schemas import FACTS

TABLES = {
    "customer": "SELECT 1L AS c_custkey, 'n' AS c_name, 'm' AS c_mktsegment, 1.0D AS c_acctbal",
    "part": "SELECT 1L AS p_partkey, 'LARGE' AS p_type, 9.0D AS p_retailprice",
    # The calendar ends with January, the tour five days after the second order does not.
    "orders": """SELECT o_orderkey, 1L AS o_custkey, 'O' AS o_orderstatus, o_orderdate, '1-URGENT' AS o_orderpriority
                 FROM VALUES (2L, TIMESTAMP '2024-01-05'), (4L, TIMESTAMP '2024-01-31') AS t(o_orderkey, o_orderdate)""",
    "lineitem": """SELECT 2L AS l_orderkey, 1L AS l_partkey, 1L AS l_suppkey, 1 AS l_linenumber, 1.0D AS l_quantity, 5.0D AS l_extendedprice,
                          'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP '2024-01-20' AS l_shipdate""",
    "events": "SELECT 1L AS event_id, TIMESTAMP '2023-12-31' AS ts, 1L AS user_id, 'click' AS event_type",
    "documents": "SELECT 1L AS doc_id, 'text' AS text, 'web' AS source, 4 AS n_chars",
}


def test_every_declared_reference_is_checked(spark, tmp_path):
    for name, sql in TABLES.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = entry.queries()["dq_foreign_key"](spark, str(tmp_path)).collect()
    found = {(r.table, r.rule): r.violations for r in rows}
    assert len(found) == len(rows)
    assert {(t, f"{c} in dimension") for t, table in FACTS.items() for c, _, _ in table.references} <= set(found)
    assert ("fact_care_history", "previous_level in dimension") in found
    # Left out before: a tour and a change of care outside of the calendar.
    broken = {key for key, n in found.items() if n}
    assert {("fact_hubspot_leads", "tour_date in dimension"), ("fact_care_history", "change_date in dimension")} <= broken
    assert found["fact_hubspot_leads", "tour_date in dimension"] == 1
    assert found["fact_hubspot_leads", "created_date in dimension"] == 0
