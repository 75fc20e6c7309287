"""The whole run: extracts to bronze, silver and gold, with reports on the way.

    python -m lakestrata.plans.run RAW_FOLDER OUT_FOLDER [FIRST_DAY LAST_DAY]
"""

from __future__ import annotations

import sys
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.dates import dataset_of_file
from lakestrata.operators import quality
from lakestrata.plans import gold, months
from lakestrata.plans.silver import SPECS, cleansing_counters, silver
from lakestrata.schemas import DIMENSIONS, FACTS, METADATA, ROW_ORDINAL, Table
from lakestrata.session import in_parallel, materialise, scratch, tune
from lakestrata.sources import drops, ledger, records
from lakestrata.sources.layers import read_if_written, read_layer, write_layer

#: Of the rows of a dataset, which were read well (0) and which have too many cells (1).
QUARANTINED = "quarantined"
#: Bronze has a partition for each extract.
EXTRACT = "extract"


def run_bronze(spark: SparkSession, raw: str, out: str, multiline: bool = False) -> DataFrame:
    """Take in the extracts which the ledger does not know as they are: each is parsed once, as text
    with lineage, and replaces its own partition of its dataset; those of vanished extracts go. Rows
    with too many cells are kept apart.

    Returns the reconciliation of extracts and bronze; a FAIL stops nothing. The rows of an extract
    are its lines, or with ``multiline`` its records, which are counted without the parser.
    """
    known = read_if_written(spark, f"{out}/ledger")
    listed = materialise(ledger.changes(ledger.listing(spark, raw), known), "listed_extracts")
    batch_id, now = drops.new_batch()
    parsed: dict[str, drops.Extract] = {}
    touched = listed.filter(F.col("status") != ledger.SAME).select("dataset", "extract", "path").collect()
    for dataset in sorted({row.dataset for row in touched}):
        paths = {row.path: row.extract for row in touched if row.dataset == dataset and row.path}
        names = {row.extract for row in touched if row.dataset == dataset}
        layer = f"{out}/bronze/{dataset}"
        if paths:
            files = sorted(paths)
            states = records.block_states(spark, files) if multiline else None
            extracts = drops.read_headers(spark, files, states)
            parsed |= {paths[path]: extract for path, extract in extracts.items()}
            rows = drops.read_dataset(spark, dataset, files, raw, batch_id, now, multiline, extracts, states)
            rows = rows.withColumns({EXTRACT: F.col("source_file"), QUARANTINED: F.col(drops.CORRUPT).isNotNull().cast("int")})
        else:
            rows = read_layer(spark, layer).limit(0)
        write_layer(rows, layer, [EXTRACT, QUARANTINED], replace=lambda values, own=names: values[EXTRACT] in own)
    write_layer(ledger.renewed(listed, known, parsed), f"{out}/ledger")
    return reconciliation(spark, out)


def reconciliation(spark: SparkSession, out: str) -> DataFrame:
    """Rows and columns of the extracts, by the ledger, against those bronze has."""
    taken = read_layer(spark, f"{out}/ledger")
    stored = [row.dataset for row in taken.select("dataset").distinct().orderBy("dataset").collect()]
    if not stored:
        raise FileNotFoundError("no extracts were found")
    layers = [read_layer(spark, f"{out}/bronze/{d}") for d in stored]
    kept = [df.groupBy(dataset_of_file(F.col("source_file")).alias("dataset")).agg(F.count("*").alias("stored_rows")) for df in layers]
    kept_rows = reduce(DataFrame.unionByName, kept).groupBy("dataset").agg(F.sum("stored_rows").alias("stored_rows"))
    own = {*METADATA, ROW_ORDINAL, EXTRACT, QUARANTINED}
    kept_columns = [(d, c) for d, df in zip(stored, layers) for c in df.columns if c not in own]
    rows_report = quality.reconcile_counts(taken.groupBy("dataset").agg(F.sum("row_count").alias("raw_rows")), kept_rows)
    columns_report = quality.reconcile_columns(
        taken.select("dataset", F.explode("header").alias("column")),
        spark.createDataFrame(kept_columns, "dataset string, column string"),
    )
    return rows_report.join(columns_report, "dataset", "left")


def audit_bronze(spark: SparkSession, raw: str, out: str, multiline: bool = False) -> DataFrame:
    """The extracts, parsed again, against bronze by content: a changed, lost or doubled row on
    either side is a FAIL of ``content_check``, whatever the ledger says."""
    sides: tuple[list[DataFrame], list[DataFrame]] = ([], [])
    for dataset, paths in drops.discover(spark, raw).items():
        stored = read_if_written(spark, f"{out}/bronze/{dataset}")
        rows = drops.read_dataset(spark, dataset, paths, raw, "", "", multiline)
        own = {*METADATA, ROW_ORDINAL, drops.CORRUPT, EXTRACT, QUARANTINED}
        columns = sorted({*rows.columns, *(stored.columns if stored else ())} - own) + [drops.CORRUPT]
        for side, df in zip(sides, (rows, stored)):
            if df is not None:
                side.append(df.agg(F.lit(dataset).alias("dataset"), *quality.fingerprint(df, columns)))
    return quality.reconcile_content(*[reduce(DataFrame.unionByName, side) for side in sides])


def bronze(spark: SparkSession, out: str, dataset: str) -> DataFrame | None:
    """The good rows of a dataset, if it was delivered."""
    rows = read_if_written(spark, f"{out}/bronze/{dataset}")
    if rows is None:
        return None
    return rows.filter(F.col(QUARANTINED) == 0).drop(drops.CORRUPT, EXTRACT, QUARANTINED)


def run_silver(spark: SparkSession, out: str) -> DataFrame:
    """Cleanse and deduplicate every known dataset, and report counters.

    The counters are one aggregate over bronze of their own: counters gathered while writing
    would count the rows of a lost and repeated task twice.
    """

    def one(dataset: str) -> list[tuple[str, str, int]]:
        rows = bronze(spark, out, dataset)
        if rows is None:
            return []
        write_layer(silver(rows, SPECS[dataset]), f"{out}/silver/{dataset}")
        measured = cleansing_counters(rows, SPECS[dataset]).first().asDict()
        measured["rows_written"] = read_layer(spark, f"{out}/silver/{dataset}").count()
        measured["duplicates_removed"] = measured["rows_read"] - measured["rows_written"]
        return [(dataset, name, int(value or 0)) for name, value in measured.items()]

    rows = sum(in_parallel(*[partial(one, dataset) for dataset in SPECS]), [])
    return spark.createDataFrame(rows, "dataset string, counter string, value long")


def run_gold(
    spark: SparkSession, out: str, first: str = gold.CALENDAR[0], last: str = gold.CALENDAR[1]
) -> None:
    """Write the dimensions whose source exists, then the facts. The calendar has the days from
    ``first`` to ``last``; dates of facts beyond it are reported by the rules. Ids which an earlier
    run has numbered keep their keys."""
    found = {dataset: read_if_written(spark, f"{out}/silver/{dataset}") for dataset in SPECS}
    tables = {dataset: df for dataset, df in found.items() if df is not None}

    def known(name: str) -> DataFrame | None:
        return read_if_written(spark, f"{out}/gold/dim/{name}")

    builds = {
        "dim_community": lambda: gold.dim_community(tables.values(), known("dim_community")),
        "dim_date": lambda: gold.dim_date(spark, first, last),
        "dim_care_level": lambda: gold.dim_care_level(spark),
    }
    if "adp_shifts" in tables:
        builds["dim_employee"] = lambda: gold.dim_employee(tables["adp_shifts"], known("dim_employee"))
    if "pcc_residents" in tables:
        builds["dim_residents"] = lambda: gold.dim_residents(tables["pcc_residents"], known("dim_residents"))
    if "yardi_units" in tables:
        builds["dim_unit"] = lambda: gold.dim_unit(tables["yardi_units"], known("dim_unit"))

    def write_dim(name: str) -> DataFrame:
        write_layer(builds[name](), f"{out}/gold/dim/{name}")
        return read_layer(spark, f"{out}/gold/dim/{name}")

    dims = dict(zip(builds, in_parallel(*[partial(write_dim, name) for name in builds])))

    def write_fact(name: str) -> None:
        rows = gold.fact(name, tables[gold.FACT_SOURCES[name][0]], dims)
        months.write_fact(rows, name, f"{out}/gold/fact/{name}")

    wanted = [name for name, (dataset, _) in gold.FACT_SOURCES.items() if dataset in tables]
    in_parallel(*[partial(write_fact, name) for name in wanted])


def rules_of(table: Table) -> dict:
    """All single-row rules of a table."""
    broken = quality.not_null(table.required)
    for column, least in table.at_least:
        broken |= quality.in_range(column, least)
    for column, low, high in table.between:
        broken |= quality.in_range(column, low, high)
    for column, allowed in table.one_of:
        broken |= quality.in_set(column, allowed)
    broken |= quality.ordered_dates(table.date_order)
    return broken


def table_rules(spark: SparkSession, df: DataFrame, name: str, table: Table, out: str) -> list[DataFrame]:
    """Every declared rule of one table: one aggregate for the rows, one for all its keys. The rows
    which break any of them are written to ``quarantine``, with the names of the rules."""
    counts = key_counts_of(df, table)
    references = [
        (column, members, dim_column)
        for column, dim, dim_column in table.references
        if (members := read_if_written(spark, f"{out}/gold/dim/{dim}")) is not None
    ]
    reports = [quality.count_violations(df, name, rules_of(table))]
    reports += [quality.unique_report(counts, name, key).drop("extra_rows") for key in table.unique]
    reports += [quality.foreign_report(counts, name, *reference) for reference in references]
    apart = quality.quarantine_table(df, rules_of(table), counts, table.unique, references)
    write_layer(apart, f"{out}/quarantine/{name}")
    return reports


def key_counts_of(df: DataFrame, table: Table) -> DataFrame:
    """Rows per value of every unique and foreign key of a table, written."""
    keys = {", ".join(key): list(key) for key in table.unique}
    keys |= {column: [column] for column, _, _ in table.references}
    return materialise(quality.key_counts(df, keys), "keys")


def validate_gold(spark: SparkSession, out: str) -> DataFrame:
    """Every declared rule on every dimension and fact which was written, and of every source
    the texts which did not fit the type their fact declares."""
    reports = []
    for kind, tables in (("dim", DIMENSIONS), ("fact", FACTS)):
        for name, table in tables.items():
            stored = read_if_written(spark, f"{out}/gold/{kind}/{name}")
            if stored is not None:
                stored = stored.drop(months.MONTH) if kind == "fact" else stored
                reports += table_rules(spark, stored, name, table, out)
    for name, (dataset, _) in gold.FACT_SOURCES.items():
        source = read_if_written(spark, f"{out}/silver/{dataset}")
        if source is not None:
            texts = {c for c, t in source.dtypes if t == "string"}
            types = {c: t for c, t in gold.typed_columns(name).items() if c in texts}
            if types:
                reports.append(quality.count_violations(source, dataset, quality.typed(types)))
    return reduce(DataFrame.unionByName, reports)


def run(
    spark: SparkSession,
    raw: str,
    out: str,
    multiline: bool = False,
    first: str = gold.CALENDAR[0],
    last: str = gold.CALENDAR[1],
) -> dict[str, DataFrame]:
    """All stages in order; an error ends the run. Reports are written below ``out/reports``."""
    tune(spark)
    reports = {}

    def store(name: str, report: DataFrame) -> None:
        write_layer(report, f"{out}/reports/{name}")
        reports[name] = read_layer(spark, f"{out}/reports/{name}")

    with scratch(spark):
        store("reconciliation", run_bronze(spark, raw, out, multiline))
        store("counters", run_silver(spark, out))
        run_gold(spark, out, first, last)
        store("rules", validate_gold(spark, out))
    return reports


if __name__ == "__main__":
    session = SparkSession.builder.appName("lakestrata").getOrCreate()
    raw_folder, out_folder, *bounds = sys.argv[1:]
    for title, report in run(session, raw_folder, out_folder, False, *bounds).items():
        print(f"{title}: {report.count()} rows in {out_folder}/reports/{title}")
