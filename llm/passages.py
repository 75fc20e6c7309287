"""Which windows of a fixed length occur again: the distributed part of both window operators.

Documents are sequences of units (words or bytes). Of each window of ``length`` units the run of
``anchor`` units with the smallest hash is its anchor; equal windows have equal anchors. A
maximal run of windows with the same anchor is a passage (about half of ``length`` windows), so
passages are few, and two windows can only be equal if their passages share the anchor.

1. ``candidates``: one row per passage (anchor, hash of its content, place) is shuffled by
   anchor. Tasks first collapse equal passages of a batch, so a passage which a third of all
   documents share reaches its partition once per batch. Sorted rows are read as a stream: a
   passage with an equal earlier one is covered whole; a first passage whose anchor has other
   contents too must be compared with those.
2. ``compared``: these passages are cut out of their documents again and meet by anchor, where
   the operator's own method finds the equal windows inside. An anchor with more contents than
   ``GROUP`` is split further, into a block for each of its windows: they leave their documents
   one by one, equal ones of a run once, and a block is read as a stream.
3. ``spans``: all covered ranges of a document, brought back to its text.

The text is shuffled once; both joins read the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import hashing
from llm.common import per_batch, streamed, written

#: Contents of one anchor which are compared in one task; of bytes, a passage has under 800.
GROUP = 4096
#: Bytes of payload which are compared at a time; whole anchors.
AT_ONCE = 3 << 19
#: Single windows of crowded anchors that are cut out at a time.
SINGLE_AT_ONCE = 1 << 15
#: Windows of a chunk whose anchors are found at a time; work arrays take about 60 times as much.
WINDOWS_AT_ONCE = 1 << 18


class Kind(NamedTuple):
    """What windows are made of, how long they are, and which copies are covered."""

    length: int
    anchor: int
    by_words: bool
    first_too: bool  # cover the first copy as well

    def units(self, chunk: hashing.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Words' hashes or bytes, and ``n + 1`` offsets of the documents in them."""
        if self.by_words:
            words = hashing.words(chunk, hashing.PLAIN)
            return words.hashes, words.offsets
        return chunk.data, chunk.offsets

    def values(self, units: np.ndarray) -> np.ndarray:
        """What is hashed of them, 64 bits each."""
        return units if self.by_words else hashing.PLAIN.values(units)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span < width:
        step = min(span, width - span)
        values = np.minimum(values[:-step], values[step:])
        span += step
    return values


class Found(NamedTuple):
    """Passages of a chunk: anchor, hash of the content, first unit, number of windows."""

    anchor: np.ndarray
    content: np.ndarray
    start: np.ndarray
    windows: np.ndarray


def passages(units: np.ndarray, offsets: np.ndarray, kind: Kind, at_once: int = WINDOWS_AT_ONCE) -> Iterator[Found]:
    """Passages of the documents in ``units``, for about ``at_once`` windows at a time.

    Where a long document is cut a passage may be cut, which is as good as any other end: equal
    windows still have equal anchors.
    """
    total = len(units) - kind.length + 1
    inside = hashing.inside_mask(offsets, kind.length) if total > 0 else None
    for low in range(0, max(total, 0), at_once):
        high = min(low + at_once, total)
        place = np.flatnonzero(inside[low:high])
        if not len(place):
            continue
        sums = hashing.prefix_sums(kind.values(units[low : high + kind.length - 1]))
        at = np.arange(len(sums) - kind.anchor)
        hashed = hashing.range_hash(sums, at, at + kind.anchor, 4)
        anchor = sliding_minimum(hashed, kind.length - kind.anchor + 1)[place]
        # A passage ends where its anchor's first occurrence leaves the window, even if an equal
        # one follows: so all windows of a passage differ, however a text repeats itself.
        fresh = np.ones(len(place), dtype=bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1) | (hashed[place[:-1]] == anchor[:-1])
        run = np.flatnonzero(fresh)
        windows = np.diff(np.append(run, len(place)))
        start = place[run]
        content = hashing.range_hash(sums, start, start + windows + kind.length - 1, 6)
        yield Found(anchor[run], content, start + low, windows)


_PASSAGE = pa.schema([
    ("anchor", pa.int64()), ("content", pa.int64()), ("key", pa.int64()),
    ("start", pa.int32()), ("windows", pa.int32()), ("copies", pa.int32()),
])
_PLACE = pa.schema([("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("anchor", pa.int64())])
_CUT = pa.schema([
    ("anchor", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("payload", pa.binary()),
    ("copies", pa.int32()),
])
PASSAGE = "anchor long, content long, key long, start int, windows int, copies int"
PLACE = "key long, start int, windows int, anchor long"
# Copies are 0 for a passage, and for a window the number of equal ones in its chunk; a covered run has no payload.
CUT = "anchor long, key long, start int, windows int, payload binary, copies int"


def packed(schema: pa.Schema, *columns: np.ndarray) -> pa.RecordBatch:
    """Numbers of any width as the types of ``schema``; unsigned hashes keep their bits."""
    arrays = [
        pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(f.type.to_pandas_dtype()))
        for c, f in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by ``keys`` (the first two decide what is equal), and where a new value begins."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    a, b = keys[0][order], keys[1][order]
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, new


def passage_rows(documents: DataFrame, kind: Kind) -> DataFrame:
    """Passages of ``key, text``. Copies inside a batch are marked by 0 copies and dealt out at
    random; the first of them carries their number."""

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = rows.column(0).to_numpy()
        found: list[tuple[np.ndarray, ...]] = []
        for chunk in hashing.chunks(rows.column(1)):
            units, offsets = kind.units(chunk)
            for part in passages(units, offsets, kind):
                document = np.searchsorted(offsets, part.start, side="right") - 1
                found.append((part.anchor, part.content, keys[chunk.first + document], part.start - offsets[document], part.windows))
        if not found:
            return
        anchor, content, key, start, windows = (np.concatenate(c) for c in zip(*found))
        order, new = firsts(anchor, content, key, start)
        copies = np.zeros(len(order), dtype=np.int64)
        copies[new] = np.diff(np.append(np.flatnonzero(new), len(order)))
        anchor, content, key, start, windows = (c[order] for c in (anchor, content, key, start, windows))
        anchor = np.where(new, anchor, hashing.mix(key.view(np.uint64) + start.astype(np.uint64), 9))
        for low in range(0, len(order), 1 << 16):
            part = slice(low, low + (1 << 16))
            yield packed(_PASSAGE, anchor[part], content[part], key[part], start[part], windows[part], copies[part])

    return per_batch(documents.select("key", "text"), run, PASSAGE)


def candidates(documents: DataFrame, kind: Kind) -> DataFrame:
    """``key, start, windows, anchor``: covered passages (no anchor), and those to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the first row of the last content, its copies so far
        earlier = False  # whether its anchor had another content before
        for rows in batches:
            columns = [c.to_numpy() for c in rows.columns]
            covered = columns[5] == 0
            yield from places(columns, covered)
            columns = [c[~covered] for c in columns]
            if held is not None:
                columns = [np.concatenate([[h], c]) for h, c in zip(held, columns)]
            if not len(columns[0]):
                continue
            yield from finished(columns, earlier, last=False)
            held, earlier = rest(columns, earlier)
        if held is not None:
            yield from finished([np.array([h]) for h in held], earlier, last=True)

    def starts(columns: list[np.ndarray]) -> np.ndarray:
        new = np.ones(len(columns[0]), dtype=bool)
        new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        return np.flatnonzero(new)

    def rest(columns: list[np.ndarray], earlier: bool) -> tuple[list, bool]:
        run_ = starts(columns)
        row = [c[run_[-1]] for c in columns]
        row[5] = columns[5][run_[-1] :].sum()
        if len(run_) > 1:
            earlier = bool(columns[0][run_[-2]] == columns[0][run_[-1]])
        return row, earlier

    def finished(columns: list[np.ndarray], earlier: bool, last: bool) -> Iterator[pa.RecordBatch]:
        run_ = starts(columns)
        leads = np.zeros(len(columns[0]), dtype=bool)
        leads[run_] = True
        yield from places(columns, ~leads)
        anchor = columns[0][run_]
        same = anchor[1:] == anchor[:-1]
        several = np.zeros(len(run_), dtype=bool)
        several[1:] |= same
        several[:-1] |= same
        several[0] |= earlier
        done = np.ones(len(run_), dtype=bool)
        done[-1] = last
        repeated = kind.first_too & (np.add.reduceat(columns[5], run_) > 1)
        head = [c[run_] for c in columns]
        yield from places(head, done & repeated)
        yield from places(head, done & several, compare=True)

    def places(columns: list[np.ndarray], mask: np.ndarray, compare: bool = False) -> Iterator[pa.RecordBatch]:
        if mask.any():
            key, start, windows, anchor = (columns[i][mask] for i in (2, 3, 4, 0))
            nulls = pa.nulls(len(key), pa.int64())
            numbers = packed(_PLACE, key, start, windows, anchor)
            yield numbers if compare else numbers.set_column(3, _PLACE.field(3), nulls)

    dealt = passage_rows(documents, kind).repartition("anchor").sortWithinPartitions("anchor", "content", "key", "start")
    return streamed(dealt, run, PLACE)


Method = Callable[[list[np.ndarray], list[bytes]], np.ndarray]


def cuts(documents: DataFrame, wanted: DataFrame, payload: Callable, kinds: str) -> DataFrame:
    """What ``payload`` makes of the wanted passages of each document."""
    lists = wanted.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "windows", "anchor", "split"))).alias("wanted")
    )
    joined = documents.join(lists.hint("shuffle_merge"), "key")

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, texts, wanted = (rows.column(rows.schema.get_field_index(c)) for c in ("key", "text", "wanted"))
        flat = wanted.flatten()
        first = np.concatenate([[0], np.cumsum(wanted.value_lengths().to_numpy())])
        start, windows, anchor, split = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        key = keys.to_numpy()
        for chunk in hashing.chunks(texts):
            part = slice(first[chunk.first], first[chunk.first + chunk.size])
            document = np.repeat(np.arange(chunk.size), np.diff(first[chunk.first : chunk.first + chunk.size + 1]))
            numbers = start[part].astype(np.int64), windows[part].astype(np.int64), anchor[part], split[part].astype(bool)
            yield from payload(chunk, key[chunk.first + document], document, *numbers)

    return per_batch(joined.select("key", "doc_id", "text", "wanted"), run, kinds)


def compared(documents: DataFrame, found: DataFrame, kind: Kind, method: Method, group: int = GROUP) -> DataFrame:
    """``key, start, windows`` of the windows inside the passages to compare which occur again.

    ``method`` gets passages sorted by anchor and place (arrays anchor, key, start, windows, and
    the payloads: units' hashes or bytes) and says of every window whether it is covered.
    """
    wanted = found.filter("anchor IS NOT NULL")
    crowded = wanted.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > group)
    marks = written(crowded.select("anchor", F.lit(True).alias("split")), "crowded")
    wanted = wanted.join(marks, "anchor", "left").withColumn("split", F.coalesce("split", F.lit(False)))

    def cut(chunk, key, document, start, windows, anchor, split) -> Iterator[pa.RecordBatch]:
        units, offsets = kind.units(chunk)
        low = offsets[document] + start
        high = low + windows + kind.length - 1
        whole = np.flatnonzero(~split)
        payload = [units[a:b].tobytes() for a, b in zip(low[whole].tolist(), high[whole].tolist())]
        yield cut_rows(anchor[whole], key[whole], start[whole], windows[whole], payload, np.zeros(len(whole)))
        rest = np.flatnonzero(split)
        reached = np.cumsum(windows[rest]) // SINGLE_AT_ONCE
        for n in np.unique(reached):
            own = rest[reached == n]
            yield from single_windows(units, low[own], key[own], start[own], windows[own], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        block = Block(kind.first_too)
        for rows in batches:
            copies, payload = rows.column(5).to_numpy(), rows.column(4)
            done = payload.is_null().to_numpy(zero_copy_only=False)
            if done.any():
                yield packed(_PLACE, *[rows.column(i).to_numpy()[done] for i in (1, 2, 3, 0)])
            yield from block.take(rows.filter(pa.array(copies > 0)))
            rows = rows.filter(pa.array((copies == 0) & ~done))
            if not rows.num_rows:
                continue
            held.append(rows)
            size += rows.nbytes
            if size >= AT_ONCE:
                whole = pa.Table.from_batches(held).combine_chunks()
                anchor = whole.column(0).to_numpy()
                last = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on
                yield from judged(whole.slice(0, last))
                held, size = whole.slice(last).to_batches(), 0
        if held:
            yield from judged(pa.Table.from_batches(held))

    def judged(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        whole = whole.combine_chunks()
        anchors = whole.column(0).to_numpy() if whole.num_rows else np.zeros(0, dtype=np.int64)
        low = 0
        lengths = whole.column(3).to_numpy() + kind.length if whole.num_rows else anchors
        total = np.cumsum(lengths * (8 if kind.by_words else 1))
        while low < len(anchors):
            reached = int(np.searchsorted(total, (total[low - 1] if low else 0) + AT_ONCE))
            high = int(np.searchsorted(anchors, anchors[min(reached, len(anchors) - 1)], side="right"))
            part = whole.slice(low, high - low)
            numbers = [part.column(i).to_numpy() for i in range(4)]
            covered = method(numbers, part.column(4).to_pylist())
            yield from runs(numbers[1], numbers[2], numbers[3], covered)
            low = high

    cut_out = cuts(documents, wanted, cut, CUT)
    dealt = cut_out.repartition("anchor").sortWithinPartitions("anchor", "key", "start")
    return streamed(dealt, run, PLACE).drop("anchor")


def cut_rows(anchor, key, start, windows, payload: list[bytes | None], copies) -> pa.RecordBatch:
    numbers = [pa.array(np.asarray(c).astype(f.type.to_pandas_dtype())) for c, f in zip((anchor, key, start, windows), _CUT)]
    return pa.RecordBatch.from_arrays([*numbers, pa.array(payload, pa.binary()), pa.array(copies.astype(np.int32))], schema=_CUT)


def single_windows(units, low, key, start, windows, kind: Kind) -> Iterator[pa.RecordBatch]:
    """The windows of passages, each with its own content. Equal ones of the chunk leave it as one
    with their number, the later ones as covered; documents come in the order of their keys."""
    owner = np.repeat(np.arange(len(key)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at, begin, of = low[owner] + inside, start[owner] + inside, key[owner]
    number: dict[bytes, int] = {}
    leads: list[int] = []
    which = np.empty(len(at), dtype=np.int64)
    for i, a in enumerate(at.tolist()):
        content = units[a : a + kind.length].tobytes()
        n = number.setdefault(content, len(leads))
        if n == len(leads):
            leads.append(i)
        which[i] = n
    lead = np.array(leads, dtype=np.int64)
    copies = np.bincount(which, minlength=len(leads))
    low_, high_ = int(at.min()), int(at.max()) + kind.length
    sums = hashing.prefix_sums(kind.values(units[low_:high_]))
    hashed = hashing.range_hash(sums, at[lead] - low_, at[lead] - low_ + kind.length, 8).view(np.int64)
    yield cut_rows(hashed, of[lead], begin[lead], np.ones(len(lead)), list(number), copies)
    later = np.ones(len(at), dtype=bool)
    later[lead] = False
    for run in runs(key, start, windows, later):
        of_run, first, n = (run.column(i).to_numpy() for i in range(3))
        dealt = hashing.mix(of_run.view(np.uint64) + first.astype(np.uint64), 9).view(np.int64)
        yield cut_rows(dealt, of_run, first, n, [None] * len(n), np.zeros(len(n)))


class Block:
    """A stream of single windows in the order of hash and place. Of equal ones the first covers the
    others, and with ``first_too`` is covered by them; what is held is one window per content of a
    hash."""

    def __init__(self, first_too: bool):
        self.first_too, self.hash, self.first = first_too, None, {}

    def take(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        covered: list[tuple[int, int]] = []
        for hashed, key, start, content, copies in zip(*[rows.column(i).to_pylist() for i in (0, 1, 2, 4, 5)]):
            if hashed != self.hash:
                self.hash, self.first = hashed, {}
            place = self.first.get(content)
            if content in self.first:
                covered.append((key, start))
            if self.first_too and (place is not None or (content not in self.first and copies > 1)):
                covered.append(place or (key, start))
                self.first[content] = None  # the first one is covered, and counted once
            elif content not in self.first:
                self.first[content] = (key, start)
        if covered:
            keys, starts = np.array(covered, dtype=np.int64).T
            yield packed(_PLACE, keys, starts, np.ones(len(keys)), np.zeros(len(keys)))


def runs(key: np.ndarray, start: np.ndarray, windows: np.ndarray, covered: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Maximal runs of covered windows within each passage."""
    owner = np.repeat(np.arange(len(key)), windows)
    before = np.zeros(len(covered), dtype=bool)
    before[1:] = covered[:-1] & (owner[1:] == owner[:-1])
    after = np.zeros(len(covered), dtype=bool)
    after[:-1] = covered[1:] & (owner[1:] == owner[:-1])
    first, last = np.flatnonzero(covered & ~before), np.flatnonzero(covered & ~after)
    if len(first):
        passage = owner[first]
        inside = first - (np.cumsum(windows) - windows)[passage]
        numbers = packed(_PLACE, key[passage], start[passage] + inside, last - first + 1, np.zeros(len(first)))
        yield numbers


KEY = "__key"


def numbered(documents: DataFrame, id_: str = "doc_id", content: str = "text") -> DataFrame:
    """The documents with a unique number ``__key`` in the order of the ids.

    It is the id itself where ids are unique, as they should be. Otherwise rows are numbered in
    the order of id (null first) and content, fixed by a written table.
    """
    rows, ids = documents.agg(F.count("*"), F.count_distinct(id_)).first()
    if rows == ids:
        return documents.withColumn(KEY, F.col(id_).cast("long")).filter(F.col(KEY).isNotNull())
    order = [F.col(id_).asc_nulls_first(), F.col(content).asc_nulls_first()]
    sorted_ = documents.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(sorted_.withColumn(KEY, F.monotonically_increasing_id()), "documents").filter(F.col(KEY).isNotNull())


def keyed(documents: DataFrame) -> DataFrame:
    """``key, doc_id, text`` of all documents."""
    wanted = documents.select(F.col("doc_id").cast("long"), "text")
    return numbered(wanted).select(F.col(KEY).alias("key"), "doc_id", "text")


def spans(documents: DataFrame, kind: Kind, method: Method, group: int = GROUP) -> DataFrame:
    """``key, doc_id, text`` with ``places``: start and number of windows of each covered run of
    windows, not yet merged; null where nothing is covered."""
    found = written(candidates(documents, kind), "candidates")
    whole = found.filter("anchor IS NULL").select("key", "start", "windows")
    every = whole.unionByName(compared(documents, found, kind, method, group))
    lists = every.groupBy("key").agg(F.collect_list(F.struct("start", "windows")).alias("places"))
    return documents.join(lists, "key", "left")


def covered_units(places: pa.ListArray, row: int, n_units: int, kind: Kind) -> np.ndarray:
    """Which units of one document lie in a covered window."""
    edge = np.zeros(n_units + 1, dtype=np.int64)
    values = places[row].values
    if values is not None and len(values):
        start = values.field(0).to_numpy().astype(np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + values.field(1).to_numpy() + kind.length - 1, -1)
    return np.cumsum(edge[:-1]) > 0
