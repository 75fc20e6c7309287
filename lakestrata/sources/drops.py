"""Monthly CSV extracts: listing, header groups, the text-only scan and lineage columns."""

from __future__ import annotations

import csv
import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.dates import DATASET_OF_STEM
from lakestrata.schemas import METADATA, ROW_ORDINAL
from lakestrata.sources import records

CORRUPT = "_corrupt_record"


def dataset_of(path: str) -> str:
    stem = re.sub(r"(?i)\.csv$", "", path.rsplit("/", 1)[-1])
    match = re.match(DATASET_OF_STEM, stem)
    return match.group(1) if match else stem


def check_name(path: str) -> None:
    """Refuse names which Spark's readers would skip without a word or take as a pattern."""
    parts = path.split("/")
    if any(part.startswith(("_", ".")) for part in parts if part):
        raise ValueError(f"Spark skips files and folders whose names begin with _ or a dot: {path}")
    if re.search(r"[*?\[\]{}\\]", path):
        raise ValueError(f"a name with pattern characters can't be read: {path}")


def root_of(spark: SparkSession, folder: str) -> str:
    """The folder as the file system names it, so that its files' names begin with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def discover(spark: SparkSession, folder: str, suffix: str = ".csv") -> dict[str, list[str]]:
    """All ``*.csv`` (or ``*.csv.gz``, by ``suffix``) below ``folder``, grouped by dataset, datasets and files sorted.

    What reaches the driver is one path per file, which it needs to plan the scans. Names Spark
    would not read are an error, since their rows would be missing without one.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root_of(spark, folder))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = system.listFiles(path, True)
    root = path.toString().rstrip("/")
    groups: dict[str, list[str]] = defaultdict(list)
    while listed.hasNext():
        found = listed.next().getPath().toString()
        if found.endswith(suffix):
            check_name(found.removeprefix(root))
            groups[dataset_of(f"{found.removesuffix(suffix)}.csv")].append(found)
    return {dataset: sorted(groups[dataset]) for dataset in sorted(groups)}


def survey(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, header, lines``: first line and number of non-blank lines of every file.

    One scan of the files as plain text, by Spark's tasks: the driver opens no file, and the line
    counts are what the parsed rows are held against later.
    """
    lines = spark.read.schema("value string").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("place"),
        "value",
    )
    return lines.groupBy("path").agg(
        F.min_by("value", "place").alias("header"), F.count_if(F.trim("value") != "").alias("lines")
    )


class Extract(NamedTuple):
    """Column names of one file, and its rows: lines, or records where cells have line breaks."""

    header: tuple[str, ...]
    rows: int


def read_headers(spark: SparkSession, paths: Sequence[str], states: DataFrame | None = None) -> dict[str, Extract]:
    """What the survey found of each file; the driver holds a line per file.

    With the ``states`` of their blocks (``records.block_states``) rows are records, which line
    breaks inside cells do not end.
    """
    counted = survey(spark, paths) if states is None else records.record_counts(states)
    found = {unescaped(row.path): row for row in counted.collect()}
    extracts = {}
    for path in paths:
        row = found.get(plain(path))
        names = next(csv.reader([(row.header if row else "").removeprefix("\ufeff")]), [])
        if not names:
            raise ValueError(f"no header row in {path}")
        extracts[path] = Extract(tuple(names), row.lines - 1)
    return extracts


def unescaped(url: str) -> str:
    """A path as Spark's metadata has it, without percent signs; a plus sign is itself."""
    return plain(unquote(url))


def plain(path: str) -> str:
    """A path without the variants of the local file system's prefix."""
    return re.sub(r"^file:/*", "/", path)


def scan_text(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str], multiline: bool = False, states: DataFrame | None = None
) -> DataFrame:
    """All columns as text; an empty or missing cell is ``""``.

    Rows with too many cells land whole in ``_corrupt_record``. ``multiline`` allows line breaks
    inside quotes; files are read in blocks by many tasks either way.
    """
    options = {
        "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": str(multiline).lower(),
    }
    names = [*columns, CORRUPT]
    if multiline:
        found = records.records(spark, paths, states)
        # The first record of a file is its header.
        body = found.filter((F.col("block") > 0) | (F.col("row") > 0))
        layout = ", ".join(f"`{c}` string" for c in names)
        cells = F.from_csv("text", layout, options).alias("cells")
        scanned = body.select(cells, F.col("path").alias("_path"), F.struct("block", "row").alias(ROW_ORDINAL))
        cell = {c: F.col("cells").getField(c) for c in names}
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        scanned = spark.read.schema(schema).option("header", "true").options(**options).csv(list(paths)).select(
            *[f"`{c}`" for c in names],
            F.col("_metadata.file_path").alias("_path"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias(ROW_ORDINAL),
        )
        cell = {c: F.col(f"`{c}`") for c in names}
    # A short row is marked corrupt as well, but it is a good row with empty last cells.
    corrupt = cell[CORRUPT]
    unquoted = F.regexp_replace(corrupt, '"[^"]*"', "")
    too_long = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","))) >= len(columns)
    return scanned.select(
        *[F.coalesce(cell[c], F.lit("")).alias(c) for c in columns],
        F.when(too_long, corrupt).alias(CORRUPT),
        "_path",
        ROW_ORDINAL,
    )


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the row as compact JSON ``[[name, value], ...]`` in column order."""
    pairs = [F.array(F.lit(c), F.col(f"`{c}`")) for c in columns]
    return F.sha2(F.to_json(F.array(*pairs)), 256)


def source_system(dataset: Column) -> Column:
    return F.split(dataset, "_", 2)[0]


def with_lineage(
    df: DataFrame, dataset: str, root: str, batch_id: str, ingestion_timestamp: str
) -> DataFrame:
    """Lineage columns; ``source_file`` is the path below ``root``, a folder as the file system
    names it (``root_of``)."""
    prefix = rf"^{re.escape(plain(root).rstrip('/'))}/"
    # url_decode takes a plus sign for a blank, which it is not in a path.
    decoded = F.url_decode(F.replace(F.col("_path"), F.lit("+"), F.lit("%2B")))
    local = F.regexp_replace(decoded, "^file:/*", "/")
    return df.withColumns(
        {
            "ingestion_timestamp": F.lit(ingestion_timestamp),
            "source_file": F.regexp_replace(local, prefix, ""),
            "source_system": source_system(F.lit(dataset)),
            "batch_id": F.lit(batch_id),
        }
    ).drop("_path")


def new_batch() -> tuple[str, str]:
    """Batch id and ingestion time, shared by all rows of one run."""
    return str(uuid.uuid4()), datetime.now(timezone.utc).isoformat(timespec="microseconds")


def check_columns(columns: Iterable[str]) -> None:
    taken = sorted({*METADATA, ROW_ORDINAL, CORRUPT}.intersection(columns))
    if taken:
        raise ValueError(f"source columns collide with metadata columns: {taken}")


def read_dataset(
    spark: SparkSession,
    dataset: str,
    paths: Sequence[str],
    root: str,
    batch_id: str,
    ingestion_timestamp: str,
    multiline: bool = False,
    extracts: Mapping[str, Extract] | None = None,
    states: DataFrame | None = None,
) -> DataFrame:
    """All files of a dataset by column name: raw columns first seen first, then metadata.

    Files are scanned together per distinct header. One scan over differing headers would take
    columns by position and put values under the wrong names.
    """
    if multiline and states is None:
        states = records.block_states(spark, paths)
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, extract in (extracts or read_headers(spark, paths, states)).items():
        by_header[extract.header].append(path)
    raw_columns = list(dict.fromkeys(c for header in by_header for c in header))
    check_columns(raw_columns)

    parts = [
        scan_text(spark, files, header, multiline, states).withColumn("row_hash", row_hash(header))
        for header, files in by_header.items()
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    traced = with_lineage(union, dataset, root_of(spark, root), batch_id, ingestion_timestamp)
    return traced.select(*[f"`{c}`" for c in raw_columns], *METADATA, ROW_ORDINAL, CORRUPT)
