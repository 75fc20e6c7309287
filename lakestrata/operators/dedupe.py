"""Duplicates: keep the first row of every group, in a declared order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Which of several equal rows counts as the first: file name, then position in the file.
FILE_ORDER = ("source_file", "row_ordinal")


ROW_HASHES = ("_h1", "_h2")


def with_row_hashes(df: DataFrame, business: Sequence[str], names: Sequence[str] = ROW_HASHES) -> DataFrame:
    """Two hashes of 64 bits which stand for the business columns of a row. A hash passes over null
    cells, so which cells are null is hashed as well."""
    cells = [*business, *[F.col(c).isNull() for c in business]]
    first, second = names
    return df.select("*", F.xxhash64(*cells).alias(first), F.xxhash64(F.lit(1), *cells).alias(second))


def keep_first(
    df: DataFrame, business: Sequence[str], order: Sequence[str] = FILE_ORDER, wanted: Sequence[str] = (), once: bool = False
) -> DataFrame:
    """One row per combination of the business columns, NULL equal to NULL: all columns or those ``wanted``.

    The other columns come from the first row in ``order``. Rows are shuffled and sorted by two
    hashes of 64 bits and the order, never by the business columns themselves; a rank limit of 1
    below the shuffle lets one of any number of copies out of a task.

    Where only business columns are wanted the copies are equal in them, and none needs to be the
    first: the hashes and the wanted columns are made distinct, nothing is sorted. With ``once`` also
    other rows that are equal in the wanted columns are one: these are made distinct without hashes.
    """
    columns = list(wanted) or df.columns
    if once and set(columns) <= set(business):
        return df.select(*columns).distinct()
    if set(business) == set(df.columns):
        return df.distinct().select(*columns)
    hashed = with_row_hashes(df, business)
    if set(columns) <= set(business):
        return hashed.select(*ROW_HASHES, *columns).distinct().select(*columns)
    first = F.row_number().over(Window.partitionBy(*ROW_HASHES).orderBy(*order))
    return hashed.withColumn("_nth", first).filter("_nth = 1").select(*columns)


def first_by_key(
    df: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    order: Sequence[str] = FILE_ORDER,
) -> DataFrame:
    """One row per key with the attributes of its first row."""
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.select(*key, *[c for c in attributes if c not in set(key)], *[c for c in order if c not in {*key, *attributes}]).withColumn(
        "_nth", first
    ).filter("_nth = 1").select(*key, *attributes)
