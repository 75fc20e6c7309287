"""The ledger of extracts: what was taken in, so that a run parses only what is new or changed.

An extract is known by its path below the folder, its size and the time it was changed. The ledger
is a layer with a row for each, and with what parsing it found: its header and its rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.dates import dataset_of_file
from lakestrata.session import file_system
from lakestrata.sources.drops import Extract, check_name, discover, plain, root_of

NEW, CHANGED, SAME, VANISHED = "new", "changed", "same", "vanished"

def listing(spark: SparkSession, folder: str) -> DataFrame:
    """``extract, path, dataset, size, modified`` of all ``*.csv`` below ``folder``.

    The files are listed by Spark's index, by tasks where there are many folders, and their content
    is not read. Names which Spark would skip or take as a pattern are an error: the driver looks
    at the names one by one only if Spark lists fewer files than the folder has.
    """
    root = root_of(spark, folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )
    target, system = file_system(spark, root)
    odd = files.filter(F.col("path").rlike(r"[*?\[\]{}\\][^/]*\.csv$")).first()
    if odd:
        check_name(odd.path)
    if files.count() < system.getContentSummary(target).getFileCount():
        discover(spark, folder)
    files = files.filter(F.col("path").endswith(".csv"))
    prefix = rf"^{re.escape(plain(root).rstrip('/'))}/"
    listed = files.withColumn("path", F.regexp_replace("path", "^file:/*", "/"))
    listed = listed.withColumn("extract", F.regexp_replace("path", prefix, ""))
    return listed.select("extract", "path", dataset_of_file(F.col("extract")).alias("dataset"), "size", "modified")


def changes(found: DataFrame, known: DataFrame | None) -> DataFrame:
    """The listing with ``status`` against the ledger, and a row for each extract that vanished."""
    if known is None:
        return found.withColumn("status", F.lit(NEW))
    old = known.select("extract", F.col("dataset").alias("__dataset"), F.col("size").alias("__size"), F.col("modified").alias("__modified"))
    same = (F.col("size") == F.col("__size")) & (F.col("modified") == F.col("__modified"))
    status = (
        F.when(F.col("path").isNull(), VANISHED).when(F.col("__size").isNull(), NEW).when(same, SAME).otherwise(CHANGED)
    )
    return found.join(old, "extract", "full").select(
        "extract", "path", F.coalesce("dataset", "__dataset").alias("dataset"), "size", "modified", status.alias("status")
    )


def renewed(listed: DataFrame, known: DataFrame | None, parsed: Mapping[str, Extract]) -> DataFrame:
    """The ledger after a run: extracts which stayed as they were, and those it ``parsed`` (by name)."""
    spark = listed.sparkSession
    rows = [(name, list(extract.header), extract.rows) for name, extract in parsed.items()]
    fresh = spark.createDataFrame(rows, "extract string, header array<string>, row_count long")
    taken = listed.filter(F.col("status").isin(NEW, CHANGED)).join(fresh, "extract")
    columns = ["extract", "dataset", "size", "modified", "header", "row_count"]
    if known is None:
        return taken.select(columns)
    stayed = listed.filter(F.col("status") == SAME).select("extract")
    return known.join(stayed, "extract", "left_semi").select(columns).unionByName(taken.select(columns))

