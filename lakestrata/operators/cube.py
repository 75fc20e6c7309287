"""Distinct counts that can be added up: bitmaps of dense keys per group and day.

A count of distinct keys of two months is not the sum of the counts of each, a bitmap of two months
is the union of both. One scan of a fact leaves a cube of bitmaps per group, day and bucket of
32,768 keys; every period, coarser group and trailing window is answered from the cube by unions,
and no row of the fact meets another again.

Keys must be dense numbers (surrogate keys; ``lakestrata.operators.keys`` numbers others): a bitmap takes 4 KB
for each bucket in which a group has a key on a day, however few. Rows without a key or a day are
not counted. A group without a value is a group like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.joins import null_safe_join
from lakestrata.operators.windows import ROLLING_DAYS, on_reports


def distinct_cube(df: DataFrame, key: str, day: str, by: Sequence[str]) -> DataFrame:
    """``by, day, bucket, members``: bitmaps of the keys seen, built below the shuffle."""
    seen = df.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
    return seen.groupBy(*by, F.col(day).alias("day"), F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("members")
    )


def distinct_per(cube: DataFrame, by: Sequence[str | Column], name: str) -> DataFrame:
    """Distinct keys of each combination of ``by``, columns of the cube or made from its day."""
    plain = [F.col(c) if isinstance(c, str) else c for c in by]
    named = cube.select(*plain, "bucket", "members")
    columns = [c for c in named.columns if c not in ("bucket", "members")]
    unions = named.groupBy(*columns, "bucket").agg(F.bitmap_or_agg("members").alias("members"))
    return unions.groupBy(*columns).agg(F.sum(F.bitmap_count("members")).alias(name))


def distinct_trailing(
    cube: DataFrame, by: Sequence[str], reports: DataFrame, name: str, days: int = ROLLING_DAYS
) -> DataFrame:
    """Distinct keys of the ``days`` days up to each report date, for every group of the cube.

    A bitmap is taken along once for each report that looks back on its day: three or four with
    monthly reports. For daily ones ``rolling_distinct`` costs less.
    """
    dates = reports.agg(F.sort_array(F.collect_set("report_date")).alias("dates")).scalar()
    looking = F.filter("__dates", lambda r: (r >= F.col("day")) & (r < F.date_add("day", days)))
    spread = cube.withColumn("__dates", dates).withColumn("report_date", F.explode(looking)).drop("day", "__dates")
    counted = distinct_per(spread, [*by, "report_date"], "__n")
    groups = cube.select(*by).distinct() if by else cube.sparkSession.range(1).select()
    found = null_safe_join(on_reports(groups, reports), counted, [*by, "report_date"], "left")
    return found.select(*by, "report_date", F.coalesce("__n", F.lit(0).cast("long")).alias(name))
