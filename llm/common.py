"""What the operators share: tables, written intermediates, shipping of the code, column names."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import session

_shipped: set[str] = set()

#: Bytes of an Arrow batch, where the session has Spark's default of 64 MB: a worker holds a batch,
#: its result and work arrays for a part of it.
BATCH_BYTES = "8m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULT = "67108864b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application, and keep Arrow
    batches small.

    The first is the same as ``spark-submit --py-files``; the driver's copy may lie anywhere.
    """
    if spark.conf.get(_BATCH_SETTING) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), "llm_modules.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for package in (root, root.parent / "lakestrata"):
            for module in sorted(package.rglob("*.py")):
                out.write(module, module.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage is cut and no task computes it twice.

    The table survives the loss of executors and is removed when the application ends.
    """
    return session.materialise(df, label)


def drop(df: DataFrame) -> None:
    """Remove the files of a ``written`` table which nothing will read again."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        session.remove(df.sparkSession, folder)


def per_batch(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply ``function`` to every Arrow batch of ``df``; a batch is all a task holds at a time."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(run, schema)


def streamed(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply ``function`` to the stream of batches of each partition of ``df``."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def set_aside(df: DataFrame, *prefixes: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns of these prefixes under names it does not have, and their own names."""
    taken = {}
    for name in df.columns:
        if name.startswith(prefixes):
            other = f"__own_{name}"
            while other in df.columns or other.startswith(prefixes):
                other = f"_{other}"
            taken[other] = name
            df = df.withColumnRenamed(name, other)
    return df, taken


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of arrays or numpy arrays in the order of ``schema``."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def total(df: DataFrame, column: str = "*") -> int:
    """One number for the driver: rows, or the sum of a column."""
    value = df.agg(F.count("*") if column == "*" else F.sum(column)).first()[0]
    return int(value or 0)


def hashed_sample(df: DataFrame, rank: str, most: int, *ties: str) -> DataFrame:
    """At most ``most`` rows, those with the smallest ``rank``, a 64 bit hash.

    Of many rows, tasks first leave out all but about three times as many by the hash alone, so
    what meets in one task is bounded however many tasks there are.
    """
    n = total(df)
    if n > 3 * most:
        df = df.filter(F.col(rank) < F.lit(-(1 << 63) + (1 << 64) * 3 * most // n))
    return df.orderBy(rank, *ties).limit(most)


def pieces(amount: int, per_piece: int) -> int:
    """How many pieces of about ``per_piece`` a measured amount makes."""
    return max(1, -(-amount // per_piece))
