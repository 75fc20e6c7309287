from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakestrata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Every join is a shuffled join, as with sides beyond the broadcast threshold."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def cut_partitions(spark, no_broadcast):
    """Adaptive execution cuts every shuffled partition it can, as a hot key's would be."""
    tiny = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256b",
    }
    before = {name: spark.conf.get(name, None) for name in tiny}
    for name, value in tiny.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
