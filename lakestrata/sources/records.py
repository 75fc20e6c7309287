"""Records of delimited text whose quoted cells may hold line breaks, read by many tasks a file.

Where a record begins depends on all quotes before it, so such files are commonly read by one task
each. But a block of lines only turns one of two states (outside or inside a quoted cell) into one
of two, so it is described by what it does to either:

1. one scan of the lines gives each block's outcome for both states, and its records;
2. the outcomes are run through per file, a row per block, which gives the state in which each
   block really begins;
3. a second scan joins lines to records. A record which crosses blocks leaves fragments, at most
   two a block, which are put together by the record they belong to.

A quote opens a cell only as its first character; a doubled quote stays inside; what follows a
closing quote up to the next comma belongs to the cell. Records end with a line feed, with or
without a carriage return before it. Blank records are left out. A record that is still open at the
end of its file ends there. An empty file has no records.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.session import materialise

# The functions below go to the tasks by value, wherever this package lies on the driver.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Blocks which begin inside a cell are broadcast up to this number (about 100 bytes each).
MOST_BROADCAST = 100_000

#: What a row of ``pieces`` is: a whole record, the begin of one, its middle, or its end.
WHOLE, BEGIN, MIDDLE, END = 0, 1, 2, 3

BLOCKS = "path string, block long, header string, out_ends_in boolean, in_ends_in boolean, out_records long, in_records long"
PIECES = "path string, block long, row long, kind int, text string"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open at the line's end, if one is at its begin or not."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            quote = line.find('"', at)
            if quote < 0:
                return True
            if line.startswith('"', quote + 1):
                at = quote + 2
                continue
            comma = line.find(",", quote + 1)
            if comma < 0:
                return False
            inside, at = False, comma + 1
        elif line.startswith('"', at):
            inside, at = True, at + 1
        else:
            comma = line.find(',"', at)
            if comma < 0:
                return False
            at = comma + 1


class Run(NamedTuple):
    """Consecutive lines of one block in one batch."""

    place: tuple[str, int]
    lines: pa.Array
    starts_inside: bool
    quoted: list[tuple[int, str]]  # lines with a quote, the only ones that can change the state

    def after(self, inside: bool) -> np.ndarray:
        """Whether a cell is open after each line, if one is before the first or not."""
        state = np.empty(len(self.lines), dtype=bool)
        at = 0
        for i, line in self.quoted:
            state[at:i] = inside
            inside = ends_inside(line, inside)
            state[i] = inside
            at = i + 1
        state[at:] = inside
        return state


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    """The blocks of a stream of path, block, line and state; a long block comes in several runs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block, lines, state = batch.columns
        codes = path.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        numbers = block.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(numbers) != 0)) + 1
        has_quote = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            own = lines.slice(low, high - low)
            at = np.flatnonzero(has_quote[low:high])
            quoted = list(zip(at.tolist(), own.take(pa.array(at)).to_pylist()))
            yield Run((path[low].as_py(), int(numbers[low])), own, state[low].as_py() is not None, quoted)


def rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def before(after: np.ndarray, inside: bool) -> np.ndarray:
    return np.concatenate([[inside], after[:-1]])


def outcomes(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block makes of either state; the lines of a block come one after the other."""
    place, header, ends, records = None, None, [False, True], [0, 0]
    for run in runs(batches):
        if run.place != place:
            if place:
                yield rows([(*place, header, *ends, *records)], schema)
            place, ends, records = run.place, [False, True], [0, 0]
            header = run.lines[0].as_py() if place[1] == 0 else None
        filled = pc.not_equal(pc.utf8_trim_whitespace(run.lines), "").to_numpy(zero_copy_only=False)
        for state in (0, 1):
            after = run.after(ends[state])
            records[state] += int((filled & ~before(after, ends[state])).sum())
            ends[state] = bool(after[-1])
    if place:
        yield rows([(*place, header, *ends, *records)], schema)


def pieces(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block, and fragments of those which cross its bounds.

    A record has the number of its first line among those at which records of its block begin; what
    an earlier block began has -1.
    """
    place, inside, row, held = None, False, -1, []

    def fragment(still_open: bool) -> tuple:
        kind = (BEGIN if still_open else WHOLE) if row >= 0 else (MIDDLE if still_open else END)
        return (*place, row, kind, "\n".join(held))

    for run in runs(batches):
        out = []
        if run.place != place:
            if held:
                out.append(fragment(True))
            place, inside, row, held = run.place, run.starts_inside, -1, []
        after = run.after(inside)
        begins = ~before(after, inside)
        inside = bool(after[-1])
        number = row + np.cumsum(begins)
        single = begins & ~after
        n = int(single.sum())
        if n:
            columns = [[place[0]] * n, [place[1]] * n, number[single], [WHOLE] * n, run.lines.filter(pa.array(single))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        # Records of several lines, the first of which may have begun in the run before.
        several = np.flatnonzero(~single)
        texts = run.lines.take(pa.array(several)).to_pylist()
        at = 0
        for close in np.flatnonzero(~after[several]).tolist():
            row = int(number[several[close]])
            held += texts[at : close + 1]
            out.append(fragment(False))
            held, at = [], close + 1
        held += texts[at:]
        row = int(number[-1])
        yield rows(out, schema)
    if held:
        yield rows([fragment(True)], schema)


def _arrow(layout: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(layout))


def lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, block, line, place``: the lines of each block in order."""
    return spark.read.schema("value string").option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
        F.monotonically_increasing_id().alias("place"),
    )


def block_states(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The blocks with ``begins_inside``: a row per block, written."""
    found = lines(spark, paths).mapInArrow(partial(outcomes, _arrow(BLOCKS)), BLOCKS)
    blocks = materialise(found, "csv_blocks")
    # A block either sets the state, turns it over or leaves it.
    sets = F.col("out_ends_in") == F.col("in_ends_in")
    turns = (F.col("out_ends_in") & ~F.col("in_ends_in")).cast("int")
    order = Window.partitionBy("path").orderBy("block")
    turned = F.sum(turns).over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = blocks.withColumns({"__turned": turned})
    marked = marked.withColumn("__set", F.when(sets, F.struct(F.col("out_ends_in").alias("to"), F.col("__turned").alias("at"))))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    marked = marked.withColumns({
        "__last": F.last("__set", ignorenulls=True).over(earlier),
        "__before": F.coalesce(F.lag("__turned").over(order), F.lit(0)),
    })
    since = (F.col("__before") - F.coalesce("__last.at", F.lit(0))) % 2 == 1
    begins = F.coalesce("__last.to", F.lit(False)) != since
    return materialise(marked.withColumn("begins_inside", begins).drop("__turned", "__set", "__last", "__before"), "csv_states")


def record_counts(states: DataFrame) -> DataFrame:
    """``path, header, lines``: first line of every file, and its records that are not blank."""
    n = F.when(F.col("begins_inside"), F.col("in_records")).otherwise(F.col("out_records"))
    return states.groupBy("path").agg(F.max("header").alias("header"), F.sum(n).alias("lines"))


def _begun(scanned: DataFrame, inside: DataFrame, broadcastable: bool) -> DataFrame:
    """Pieces of the scanned lines, given the blocks that begin inside a cell."""
    side = inside.select("path", "block", F.lit(1).cast("long").alias("starts_inside"))
    if broadcastable:
        # The lines stay where and as they are read.
        joined = scanned.join(F.broadcast(side), ["path", "block"], "left")
    else:
        joined = scanned.join(side, ["path", "block"], "left").sortWithinPartitions("path", "block", "place")
    return joined.select("path", "block", "line", "starts_inside").mapInArrow(partial(pieces, _arrow(PIECES)), PIECES)


def records(spark: SparkSession, paths: Sequence[str], states: DataFrame | None = None) -> DataFrame:
    """``path, block, row, text`` of all records but blank ones, each file's first among them.

    ``block`` and ``row`` order the records of a file.
    """
    states = block_states(spark, paths) if states is None else states
    inside = states.filter("begins_inside").select("path", "block")
    ends = F.when(F.col("begins_inside"), F.col("in_ends_in")).otherwise(F.col("out_ends_in"))
    crossing = states.filter(F.col("begins_inside") | ends).count()
    few = crossing <= MOST_BROADCAST
    scanned = lines(spark, paths)
    whole = _begun(scanned, inside, few).filter(F.col("kind") == WHOLE)
    if not crossing:
        return _filled(whole)

    # Fragments lie in blocks that begin or end inside a cell.
    near = materialise(
        states.filter(F.col("begins_inside") | ends).select("path", "block"),
        "csv_crossed",
    )
    side = F.broadcast(near) if near.count() <= MOST_BROADCAST else near
    parts = _begun(scanned.join(side, ["path", "block"], "left_semi"), inside, few).filter(F.col("kind") != WHOLE)
    # Within a block an end or middle comes before a begin, as their rows do.
    owner = F.count_if(F.col("kind") == BEGIN).over(Window.partitionBy("path").orderBy("block", "row"))
    fragment = F.struct("block", "row", "text")
    joined = parts.withColumn("__owner", owner).groupBy("path", "__owner").agg(
        F.array_sort(F.collect_list(fragment)).alias("__parts")
    )
    crossed = joined.select(
        "path", F.col("__parts")[0]["block"].alias("block"), F.col("__parts")[0]["row"].alias("row"),
        F.array_join(F.transform("__parts", lambda p: p["text"]), "\n").alias("text"),
    )
    return _filled(whole.drop("kind").unionByName(crossed))


def _filled(found: DataFrame) -> DataFrame:
    text: Column = F.regexp_replace("text", "\r$", "")
    return found.select("path", "block", "row", text.alias("text")).filter(F.trim("text") != "")
