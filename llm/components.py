"""Connected components of an edge table, without collecting links or labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import drop, streamed, written

#: Edges a task contracts at a time.
_AT_ONCE = 1 << 20

_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])
EDGE = "a long, b long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node but the smallest of its component, and that smallest one."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    while not np.array_equal(label, label[label]):
        label = label[label]
    away = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[away], nodes[label[away]]


def contracted(edges: DataFrame) -> DataFrame:
    """Edges of the same components, each partition's part as stars around its smallest nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def stars() -> Iterator[pa.RecordBatch]:
            a, b = forest(*(np.concatenate(c) for c in zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=_EDGE)

        for rows in batches:
            held.append((rows.column(0).to_numpy(), rows.column(1).to_numpy()))
            size += rows.num_rows
            if size >= _AT_ONCE:
                yield from stars()
                held, size = [], 0
        if held:
            yield from stars()

    return streamed(edges.select("a", "b"), run, EDGE)


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: of every node of an edge, the smallest node it reaches, if smaller.

    Partitions first contract their edges to stars. Then alternating steps (large star, small
    star) until nothing moves: each node's neighbours are linked to the smallest of them, which
    at least halves distances in two steps. A hub's neighbours only meet its smallest one, which
    partial aggregation finds, and the join back to it is one that AQE splits; every round is
    written to the shared folder and the round before it removed.
    """
    edge = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    current = written(contracted(edge).distinct(), "edges")
    state = _state(current)
    while True:
        following = written(_small_star(_large_star(current)), "edges")
        now = _state(following)
        drop(current)
        current = following
        if now == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now


def _state(edges: DataFrame) -> tuple:
    """What no longer changes when the components are found."""
    return tuple(edges.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest neighbour or itself; repeated
    links go with the small star."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
