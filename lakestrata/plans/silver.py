"""Silver: one declared plan per dataset, cleansing first and duplicates last."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions import dates, numbers, text
from lakestrata.operators.dedupe import keep_first
from lakestrata.schemas import METADATA, ROW_ORDINAL


@dataclass(frozen=True)
class SilverSpec:
    """What to do with one dataset.

    ``null_tokens`` turns the null tokens of every text into NULL; without it a text is trimmed
    only. ``defaults`` get "N/A" for blanks, ``blanks`` get NULL for "". ``labels`` are mapped in
    exact case, ``labels_any_case`` ignoring case. ``strict`` and ``lenient`` are date columns.
    """

    null_tokens: bool = False
    defaults: tuple[str, ...] = ()
    blanks: tuple[str, ...] = ()
    labels: tuple[str, ...] = ()
    labels_any_case: tuple[str, ...] = ()
    strict: tuple[str, ...] = ()
    lenient: tuple[str, ...] = ()
    monthly_snapshot: bool = False
    labor_cost: bool = False
    never_text: tuple[str, ...] = field(default=(*METADATA, ROW_ORDINAL, "_corrupt_record"))


SPECS = {
    "adp_shifts": SilverSpec(lenient=("shift_date",), labor_cost=True),
    "gbp_reviews": SilverSpec(defaults=("response_text",), lenient=("review_date", "responded_at")),
    "hubspot_leads": SilverSpec(
        defaults=("lost_reason",),
        lenient=("created_date", "tour_date", "deposit_date", "move_in_date"),
    ),
    "pcc_care_history": SilverSpec(
        blanks=("previous_level",), labels=("previous_level", "new_level"), lenient=("change_date",)
    ),
    "pcc_incidents": SilverSpec(null_tokens=True, strict=("incident_date",)),
    "pcc_residents": SilverSpec(
        null_tokens=True,
        labels_any_case=("care_level",),
        strict=("dob", "admit_date", "discharge_date"),
        monthly_snapshot=True,
    ),
    "yardi_leases": SilverSpec(blanks=("move_out_reason",), lenient=("move_in_date", "move_out_date")),
    "yardi_units": SilverSpec(labels=("unit_type",), lenient=("snapshot_date",)),
}


def clean_cell(column: str, spec: SilverSpec) -> Column:
    """A cell after the steps which look at no other one."""
    raw = F.col(column)
    c = text.null_tokens_to_null(raw) if spec.null_tokens else text.strip(raw)
    if column in spec.defaults:
        c = text.blank_to_default(c)
    if column in spec.blanks:
        c = text.empty_to_null(c)
    if column in spec.labels:
        c = text.label_exact(c)
    if column in spec.labels_any_case:
        c = text.label_any_case(c)
    if column in spec.strict:
        c = dates.mixed_date(raw)
    if column in spec.lenient:
        c = dates.mixed_date_lenient(raw)
    return c


def cleanse(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """All per-row steps; of a part of the columns, the steps which apply to them."""
    out = df.withColumns({c: clean_cell(c, spec) for c in df.columns if c not in spec.never_text})
    if spec.labor_cost and "hourly_rate" in df.columns:
        out = out.withColumn("standard_hourly_rate", numbers.rate_for(F.col("role"), F.col("hourly_rate")))
        cost = numbers.product(F.col("hours_worked"), F.col("standard_hourly_rate"))
        out = out.withColumn("total_labor_cost", cost).drop("hourly_rate")
    if spec.monthly_snapshot and "admit_date" in df.columns:
        out = out.withColumn("last_date", dates.month_end_of_file(F.col("source_file")))
        status = dates.snapshot_status(F.col("admit_date"), F.col("discharge_date"), F.col("last_date"))
        out = out.withColumn("status", status)
    return out


def business_columns(df: DataFrame, spec: SilverSpec) -> list[str]:
    return [c for c in df.columns if c not in spec.never_text]


def silver(df: DataFrame, spec: SilverSpec, wanted: Sequence[str] = (), once: bool = False) -> DataFrame:
    clean = cleanse(df, spec)
    order = ("source_file", ROW_ORDINAL)
    return keep_first(clean, business_columns(clean, spec), order, wanted, once)


def cleansing_counters(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """One row of counters over the uncleansed rows: trimmed cells, labels and date outcomes."""
    texts = [c for c in df.columns if c not in spec.never_text]
    trimmed = [text.was_trimmed(F.col(c)).cast("long") for c in texts]
    facts = {"trimmed": sum(trimmed[1:], trimmed[0])}
    counters = {"rows_read": F.count(F.lit(1)), "trimmed_cells": F.sum("trimmed")}
    for c in (*spec.labels, *spec.labels_any_case):
        mapped = text.label_exact(F.col(c)) if c in spec.labels else text.label_any_case(F.col(c))
        known = mapped.isin(*sorted(set(text.CARE_LEVELS.values())))
        kind = F.when(known, "standardised").when(~text.is_blank(F.col(c)), "unknown")
        facts[f"{c}_kind"] = kind
        for name in ("standardised", "unknown"):
            counters[f"{c}_{name}"] = F.count_if(F.col(f"{c}_kind") == name)
    for c in (*spec.strict, *spec.lenient):
        parse = dates.mixed_date if c in spec.strict else dates.mixed_date_lenient
        facts[f"{c}_kind"] = dates.date_outcome(F.col(c), parse(F.col(c)))
        for name in ("ok", "blank", "invalid"):
            counters[f"{c}_{name}"] = F.count_if(F.col(f"{c}_kind") == name)
    for c in spec.defaults:
        counters[f"{c}_defaulted"] = F.count_if(text.is_blank(F.col(c)))
    if spec.labor_cost:
        facts["rate"] = numbers.rate_for(text.strip(F.col("role")), F.col("hourly_rate"))
        counters["rate_found"] = F.count("rate")
        counters["cost_found"] = F.count(numbers.product(F.col("hours_worked"), F.col("rate")))
    with_facts = df.select(*texts, *[c.alias(name) for name, c in facts.items()])
    return with_facts.agg(*[c.cast("long").alias(name) for name, c in counters.items()])
