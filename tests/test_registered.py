"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from checks.compare import difference
from checks.registry import QUERIES

FOLDER = entry.SMOKE_FOLDER


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert difference(spark, name, FOLDER) is None


JOINING = (
    "star_key_lookup", "interval_join", "month_aligned_join", "share_of_total", "occupancy_by_community",
    "top_moveout_reasons", "incident_rate", "m_occupancy", "m_incident_rate", "m_moveout_rate", "dq_foreign_key",
    *(name for name in QUERIES if name.startswith("fact_")),
)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", JOINING)
def test_joining_query_equals_sql_when_every_partition_is_cut(spark, cut_partitions, name):
    """Nothing is broadcast, and adaptive execution cuts shuffled partitions as it does hot keys."""
    assert difference(spark, name, FOLDER) is None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_entry(spark):
    assert entry.entry(spark).columns[0] == "community_id"
