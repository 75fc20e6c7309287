"""Session settings and the shared folder which holds intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def local_session(cores: str = "8", app: str = "lakestrata") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster spark-submit makes the session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", local_folder(app))
        .getOrCreate()
    )
    tune(spark)
    return spark


def tune(spark: SparkSession) -> None:
    """Settings the cleansing plans want, unless the session already has its own.

    A cleansing projection can generate a method of more than 8000 bytes of bytecode, which the
    JVM interprets instead of compiling it. Below the limit Spark splits it into small methods.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, "8000")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``, or what was given to
    ``SparkContext.setCheckpointDir`` where that setting is absent.

    There is no default: a machine-local folder would not be seen by other machines and would
    not survive the loss of its own. ``local_session`` names a folder for its single machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    return configured.rstrip("/")


def local_folder(app: str) -> str:
    """A folder for the only machine of a local session."""
    return os.path.join(tempfile.gettempdir(), f"{app}-shared-{os.getpid()}")


def name_shared_folder(spark: SparkSession, folder: str) -> None:
    """Let a local session without a shared folder use ``folder``; a setting stays as it is."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and re.fullmatch(r"local(\[.*\])?", context.master):
        context.setCheckpointDir(folder)


def new_shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/lakestrata/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Needed where a value depends on the physical layout (positions inside a partition): the
    written table fixes it, so that later recomputation cannot change it. Reading Parquet back
    also gives Catalyst a real size to choose join strategies by. The table belongs to the
    application, whose end removes it; ``scratch`` removes it sooner.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, label)
    _own(spark, path)
    df.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_scopes: list[list[str]] = []


def file_system(spark: SparkSession, path: str):
    """The Hadoop path of ``path`` and the file system it lies in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _own(spark: SparkSession, path: str) -> None:
    # Made before it is written, so that it is also removed if the write fails half way.
    target, system = file_system(spark, path)
    system.mkdirs(target)
    system.deleteOnExit(target)
    for scope in _scopes[-1:]:
        scope.append(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table made by ``materialise`` which nothing will read again."""
    target, system = file_system(spark, path)
    system.delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside the block are removed at its end.

    For runs which write their results before they leave the block.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.pop()
        for path in paths:
            remove(spark, path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session inside the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def in_parallel(*builds: Callable[[], T], at_once: int = 4) -> list[T]:
    """Results of independent builds; their Spark jobs share the executors.

    A build which writes a small table mostly waits, so a few at a time fill the gaps.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return [future.result() for future in [pool.submit(build) for build in builds]]
