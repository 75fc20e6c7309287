"""Parquet layers which are replaced whole or by partition in one step, and JSON extracts.

A layer is a folder of versions. A write puts its files into folders of their own
(``month=2025-01-01/layer_version=<id>``) and then adds a manifest which names the folders that make
up the layer. A reader resolves the newest manifest once and reads the folders it names: before the
new manifest appears it sees the old layer whole, afterwards the new one. A write that dies leaves
folders which no manifest names.

Manifests are numbered and appear by a rename that fails if the number is taken, so of two writers
of one layer the second gets an error instead of undoing the first. This is as atomic as the file
system's rename: on HDFS entirely; object stores need a committer or a catalogue for that. The
newest manifests are kept, so readers of the last version go on while the next one appears.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.session import file_system

# Which table each audience may read.
AUDIENCES = {
    "staff": ("fact_incidents",),
    "admin": ("fact_incidents", "fact_care_history"),
}

#: Spark does not read folders whose names begin with an underscore.
MANIFESTS = "_manifests"
VERSION = "layer_version"
#: Manifests that stay, and with them the versions they name.
KEPT = 2
_NULL = "__HIVE_DEFAULT_PARTITION__"


class Version(NamedTuple):
    """What a manifest says: the folder of each partition (of ``""`` if there are none)."""

    number: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    folders: Mapping[str, str]

    def text(self) -> str:
        return json.dumps({
            "number": self.number, "schema": self.schema.jsonValue(), "partition_by": self.partition_by, "folders": self.folders,
        })


def _manifest(path: str, number: int) -> str:
    return f"{path}/{MANIFESTS}/{number:012d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    folder, system = file_system(spark, f"{path}/{MANIFESTS}")
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(name.removesuffix(".json")) for name in names if name[:12].isdigit())


def _read_manifest(spark: SparkSession, path: str, number: int) -> Version:
    target, system = file_system(spark, _manifest(path, number))
    stream = system.open(target)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    schema = T.StructType.fromJson(found["schema"])
    return Version(found["number"], schema, tuple(found["partition_by"]), found["folders"])


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version of a layer, None if it was never written."""
    numbers = _numbers(spark, path)
    return _read_manifest(spark, path, numbers[-1]) if numbers else None


def _publish(spark: SparkSession, path: str, version: Version) -> None:
    """Show a version, if no other writer has taken its number."""
    jvm = spark.sparkContext._jvm
    written, system = file_system(spark, f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}")
    stream = system.create(written, False)
    stream.write(version.text().encode())
    stream.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.valueOf("NONE")
    target, _ = file_system(spark, _manifest(path, version.number))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(written.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(written, target, how)


def partition_values(partition: str) -> dict[str, str | None]:
    """``month=2025-01-01`` as a dictionary; the null partition's value is None."""
    pairs = [part.split("=", 1) for part in partition.split("/") if part]
    return {name: None if value == _NULL else unquote(value) for name, value in pairs}


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    gather: bool = False,
    replace: Callable[[dict[str, str | None]], bool] | None = None,
    compression: str = "snappy",
) -> Version:
    """Replace the layer, or of a partitioned one the partitions for which ``replace`` is true.

    ``df`` then holds the rows of those partitions; one of them which gets no row is gone. Rows for
    other partitions are an error. ``gather`` brings the rows of a partition together first, a
    large one in several files, a small one in one.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    before = current(spark, path)
    if gather and partition_by:
        df = df.hint("rebalance", *partition_by)
    written = df.withColumn(VERSION, F.lit(name)) if partition_by else df
    writer = written.write.mode("append").option("compression", compression)
    if partition_by:
        writer.partitionBy(*partition_by, VERSION).parquet(path)
        new = _partitions(spark, path, len(partition_by), name)
    else:
        writer.parquet(f"{path}/{VERSION}={name}")
        new = {"": f"{VERSION}={name}"}
    kept = {}
    if replace and before:
        if before.partition_by != tuple(partition_by):
            raise ValueError(f"{path} is partitioned by {before.partition_by}, not by {tuple(partition_by)}")
        kept = {p: folder for p, folder in before.folders.items() if not replace(partition_values(p))}
        strange = sorted(p for p in new if not replace(partition_values(p)))
        if strange:
            raise ValueError(f"rows of partitions which are not to be replaced: {strange}")
    number = before.number + 1 if before else 0
    schema = _merged(before.schema, df.schema) if kept else df.schema
    version = Version(number, schema, tuple(partition_by), {**kept, **new})
    _publish(spark, path, version)
    forget(spark, path)
    return version


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both; files without a column read it as NULL."""
    for field in old.fields:
        if field.name in new.names and new[field.name].dataType != field.dataType:
            raise ValueError(f"{field.name} was {field.dataType.simpleString()} in the partitions that stay")
    return T.StructType(old.fields + [f for f in new.fields if f.name not in old.names])


def _partitions(spark: SparkSession, path: str, depth: int, name: str) -> dict[str, str]:
    """Folders of one version by partition; the driver holds a name per partition."""
    pattern, system = file_system(spark, "/".join([path, *["*=*"] * depth, f"{VERSION}={name}"]))
    found = {}
    for status in system.globStatus(pattern) or []:
        parts = status.getPath().toString().split("/")[-depth - 1 :]
        found["/".join(parts[:-1])] = "/".join(parts)
    return found


def forget(spark: SparkSession, path: str, keep: int = KEPT) -> None:
    """Remove all but the newest manifests, and folders which only those named."""
    numbers = _numbers(spark, path)
    old, new = numbers[:-keep], numbers[-keep:]
    named = {folder for n in new for folder in _read_manifest(spark, path, n).folders.values()}
    for n in old:
        for folder in set(_read_manifest(spark, path, n).folders.values()) - named:
            target, system = file_system(spark, f"{path}/{folder}")
            system.delete(target, True)
        target, system = file_system(spark, _manifest(path, n))
        system.delete(target, False)


def read_layer(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    keep: Callable[[dict[str, str | None]], bool] | None = None,
) -> DataFrame:
    """The newest version of a layer; of a partitioned one, the partitions for which ``keep`` is
    true. The folders of others are not even listed."""
    version = current(spark, path)
    if version is None:
        raise FileNotFoundError(f"no layer at {path}")
    folders = [f for p, f in version.folders.items() if not keep or keep(partition_values(p))]
    stored = schema or version.schema
    if not folders:
        return spark.createDataFrame([], stored)
    reader = spark.read.schema(stored).option("basePath", path)
    columns = T.StructType.fromDDL(schema).names if schema else version.schema.names
    return reader.parquet(*[f"{path}/{f}" for f in folders]).select(*[f"`{c}`" for c in columns])


def read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    return read_layer(spark, path) if current(spark, path) else None


def as_records(df: DataFrame) -> DataFrame:
    """One compact JSON object per row, NULLs included."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record"))


def publish(df: DataFrame, table: str, audience: str, path: str) -> None:
    """Write a table as JSON records for an audience which may read it."""
    if table not in AUDIENCES.get(audience, ()):
        raise PermissionError(f"{audience} may not read {table}")
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
