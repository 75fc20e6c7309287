"""Gold: dimensions with surrogate keys and facts by key lookup.

A dimension takes its stored version as ``known``: ids in it keep their keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.calendar import calendar
from lakestrata.operators.dedupe import first_by_key
from lakestrata.operators.joins import lookup_key
from lakestrata.operators.keys import kept_keys, union_distinct
from lakestrata.schemas import CALENDAR, FACTS

# The standard care levels.
CARE_LEVEL_MEMBERS = ("Independent Living", "Assisted Living", "Memory Care")

# Each fact's source and the dimensions it looks keys up in: (dimension, id, key).
COMMUNITY = ("dim_community", "community_id", "community_key")
EMPLOYEE = ("dim_employee", "employee_id", "employee_key")
RESIDENT = ("dim_residents", "resident_id", "resident_key")
UNIT = ("dim_unit", "unit_id", "unit_key")
FACT_SOURCES = {
    "fact_adp_shifts": ("adp_shifts", (EMPLOYEE, COMMUNITY)),
    "fact_care_history": ("pcc_care_history", (RESIDENT,)),
    "fact_gbp_reviews": ("gbp_reviews", (COMMUNITY,)),
    "fact_hubspot_leads": ("hubspot_leads", (COMMUNITY,)),
    "fact_incidents": ("pcc_incidents", (COMMUNITY, RESIDENT)),
    "fact_leases": ("yardi_leases", (RESIDENT, COMMUNITY, UNIT)),
    "fact_residents": ("pcc_residents", (RESIDENT, COMMUNITY)),
    "fact_units": ("yardi_units", (UNIT, COMMUNITY)),
}


def dim_community(silver_tables: Iterable[DataFrame], known: DataFrame | None = None) -> DataFrame:
    with_id = [df for df in silver_tables if "community_id" in df.columns]
    members = union_distinct(with_id, "community_id")
    return kept_keys(members, "community_id", "community_key", known)


def dim_employee(shifts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    members = first_by_key(shifts, ["employee_id"], ["role"])
    return kept_keys(members, "employee_id", "employee_key", known)


def dim_residents(residents: DataFrame, known: DataFrame | None = None) -> DataFrame:
    attributes = ["first_name", "last_name", "dob", "gender"]
    members = first_by_key(residents, ["resident_id"], attributes)
    return kept_keys(members, "resident_id", "resident_key", known)


def dim_unit(units: DataFrame, known: DataFrame | None = None) -> DataFrame:
    members = first_by_key(units, ["unit_id"], ["unit_type"])
    return kept_keys(members, "unit_id", "unit_key", known)


def dim_date(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return calendar(bounds, "first", "last")


def dim_care_level(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(level,) for level in CARE_LEVEL_MEMBERS], "care_level string")


def typed_columns(fact: str) -> dict[str, str]:
    """The fact's columns whose declared type is not a text."""
    return {c: t for c, t in FACTS[fact].columns.items() if t != "string" and not t.startswith("varchar")}


def source_columns(fact: str, columns: Sequence[str] = ()) -> list[str]:
    """The columns of the source which a fact's columns, all or those given, are made of."""
    _, lookups = FACT_SOURCES[fact]
    made = {key: id_column for _, id_column, key in lookups} | {"discharged_resident_count": "discharge_date"}
    return list(dict.fromkeys(made.get(c, c) for c in columns or FACTS[fact].columns))


def with_declared_types(
    df: DataFrame, fact: str, besides: Sequence[str] = (), columns: Sequence[str] = ()
) -> DataFrame:
    """The fact's columns, all or those given, in their declared types, and the columns ``besides`` as they are.

    A text which does not fit becomes NULL; ``quality.typed`` on the silver table counts these,
    and the whole run does so for every fact.
    """
    casts = typed_columns(fact)
    present = dict(df.dtypes)
    return df.select(
        *[F.col(c).try_cast(casts[c]).alias(c) if c in casts and present[c] != casts[c] else F.col(c) for c in columns or FACTS[fact].columns],
        *besides,
    )


def fact(
    name: str,
    source: DataFrame,
    dims: dict[str, DataFrame],
    besides: Sequence[str] = (),
    columns: Sequence[str] = (),
) -> DataFrame:
    """One row per source row, all columns or those given: ids replaced by the keys of their dimensions.

    Where a dimension does not exist (its extracts were not delivered) the key is NULL. The columns
    ``besides`` of the source stay at the end.
    """
    _, lookups = FACT_SOURCES[name]
    wanted = columns or list(FACTS[name].columns)
    lookups = [lookup for lookup in lookups if lookup[2] in wanted]
    ids = [id_column for _, id_column, _ in lookups]
    needed = [c for c in source_columns(name, wanted) if c in source.columns and c not in ids]
    out = source.select(*ids, *needed, *besides)
    for dim, id_column, key_column in lookups:
        if dim in dims:
            out = lookup_key(out, dims[dim], id_column, key_column)
        else:
            out = out.withColumn(key_column, F.lit(None).cast("long"))
    if "discharged_resident_count" in wanted:
        out = out.withColumn("discharged_resident_count", F.col("discharge_date").isNotNull().cast("int"))
    return with_declared_types(out, name, besides, wanted)
