"""The registered queries by name, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import Inputs
from checks.oracle import on_layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def presented(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as doubles, the same in both engines."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, oracle: str | None = None):
    """Register a function of the inputs under ``name``."""

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return presented(build(Inputs(spark, folder)))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = on_layers(oracle)
        return build

    return register


def day(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c.split('.')[-1]}" for c in columns)


def real(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)
