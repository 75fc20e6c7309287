"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The patterns are the windows of 13 consecutive words of the benchmark's items; an item of fewer
words is one pattern of its own length, and every length has its own tables. A table of shifts
over the hash of the last two words of a position says how far the search may move on because no
pattern can end before; where it says 0, the bucket of that hash lists the patterns which end so,
and these are compared word by word. All documents of a batch move at once.

Defined results: null and empty texts have no words and no hits; items without words are no
patterns; equal items are found together; equal documents give equal rows; further columns are
ignored; without documents there are no rows, without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import hashing
from llm.common import per_batch, set_aside, table

#: Words of a window.
WINDOW = 13
#: Patterns in one broadcast block: at most 13 hashes of 8 bytes each, about 10 MB with tables.
BLOCK_PATTERNS = 65_536
#: A document is contaminated if one word in so many is hit.
ONE_IN = 20

_SHIFT_BITS = 16
_SEGMENT = 256


class Tables(NamedTuple):
    """Search tables of the patterns of one length, sorted by the hash of their last block."""

    length: int
    words: np.ndarray  # patterns x length word hashes
    owner: np.ndarray  # index of each pattern's item
    suffix: np.ndarray  # hash of the last block, ascending
    shift: np.ndarray

    @classmethod
    def build(cls, patterns: np.ndarray, owner: np.ndarray) -> Tables:
        length = patterns.shape[1]
        last = length - 1
        block = min(2, length)
        shift = np.full(1 << _SHIFT_BITS, length - block + 1, dtype=np.int64)
        for end in range(block - 1, length):
            slots = block_hash(patterns[:, end - block + 1], patterns[:, end]) >> np.uint64(64 - _SHIFT_BITS)
            np.minimum.at(shift, slots.astype(np.int64), last - end)
        suffix = block_hash(patterns[:, last - block + 1], patterns[:, last])
        order = np.argsort(suffix, kind="stable")
        return cls(length, patterns[order], owner[order], suffix[order], shift)

    def search(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word of every occurrence, and the item found there."""
        last, back = self.length - 1, min(2, self.length) - 1
        at, stop = segments(offsets, last)
        ends: list[np.ndarray] = []
        while len(at):
            found = block_hash(words[at - back], words[at])
            step = self.shift[(found >> np.uint64(64 - _SHIFT_BITS)).astype(np.int64)]
            ends.append(at[step == 0])
            at = at + np.maximum(step, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        end = np.concatenate(ends) if ends else np.zeros(0, dtype=np.int64)
        hashed = block_hash(words[end - back], words[end])
        low = np.searchsorted(self.suffix, hashed, side="left")
        n = np.searchsorted(self.suffix, hashed, side="right") - low
        return self.confirmed(words, np.repeat(end, n), np.repeat(low, n) + ranks(n))

    def confirmed(self, words: np.ndarray, end: np.ndarray, pattern: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Compare word by word, from the last; those which differ are left out at once."""
        for back in range(self.length):
            same = words[end - back] == self.words[pattern, self.length - 1 - back]
            end, pattern = end[same], pattern[same]
        return end - self.length + 1, self.owner[pattern]


def block_hash(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return hashing.mix(first * np.uint64(0x9FB21C651E98DF25) + last, salt=5)


def ranks(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given lengths."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def segments(offsets: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last end position of pieces of all documents."""
    first, stop = offsets[:-1] + last, offsets[1:]
    keep = first < stop
    first, stop = first[keep], stop[keep]
    n = -(-(stop - first) // _SEGMENT)
    starts = np.repeat(first, n) + ranks(n) * _SEGMENT
    return starts, np.minimum(starts + _SEGMENT, np.repeat(stop, n))


class Block(NamedTuple):
    """Patterns of some items, by length."""

    items: list[str]
    tables: list[Tables]


def blocks(items: DataFrame, window: int = WINDOW, most: int = BLOCK_PATTERNS) -> Iterator[Block]:
    """Search tables for ``items`` (``item_id, text``), at most ``most`` patterns at a time.

    The driver holds one block; an item of more windows is spread over several.
    """
    ids: list[str] = []
    parts: list[tuple[int, np.ndarray]] = []
    held = 0

    def packed() -> Block:
        by_length: dict[int, list] = {}
        for item, patterns in parts:
            by_length.setdefault(patterns.shape[1], []).append((patterns, np.full(len(patterns), item)))
        return Block(ids, [Tables.build(*map(np.concatenate, zip(*group))) for group in by_length.values()])

    for row in items.select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        if row.item_id is None:
            continue
        chunk = next(hashing.chunks(pa.array([row.text], pa.string())))
        words = hashing.words(chunk, hashing.LETTERS_DIGITS).hashes
        if not len(words):
            continue
        length = min(window, len(words))
        patterns = np.unique(np.lib.stride_tricks.sliding_window_view(words, length), axis=0)
        while len(patterns):
            ids.append(row.item_id)
            parts.append((len(ids) - 1, patterns[: most - held]))
            patterns, held = patterns[most - held :], held + len(parts[-1][1])
            if held >= most:
                yield packed()
                ids, parts, held = [], [], 0
    if parts:
        yield packed()


class Hits(NamedTuple):
    """Per document of a batch: words, covered ranges of words, and the items found."""

    n_words: list[int]
    ranges: list[list[int]]  # start, end, start, end, ...
    items: list[list[str]]


def search(texts: pa.Array, block: Block | None) -> Hits:
    """Occurrences of the block's patterns in every text."""
    out = Hits([], [], [])
    for chunk in hashing.chunks(texts):
        words = hashing.words(chunk, hashing.LETTERS_DIGITS)
        out.n_words.extend(words.counts().tolist())
        ranges: list[list[int]] = [[] for _ in range(chunk.size)]
        items: list[list[str]] = [[] for _ in range(chunk.size)]
        edge = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        pairs = [np.zeros((0, 2), dtype=np.int64)]
        for tables in block.tables if block else ():
            start, item = tables.search(words.hashes, words.offsets)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + tables.length, -1)
            document = np.searchsorted(words.offsets, start, side="right") - 1
            pairs.append(np.unique(np.stack([document, item], axis=1), axis=0))
        covered = np.cumsum(edge[:-1]) > 0
        for document in np.unique(np.concatenate(pairs)[:, 0]):
            low, high = words.offsets[document], words.offsets[document + 1]
            inside = np.diff(np.concatenate([[False], covered[low:high], [False]]).astype(np.int8))
            ranges[document] = np.stack([np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)], 1).ravel().tolist()
        for document, item in np.concatenate(pairs).tolist():
            items[document].append(block.items[item])
        out.ranges.extend(ranges)
        out.items.extend(items)
    return out


def joined(old: list[int], new: list[int]) -> list[int]:
    """The union of two lists of ranges."""
    out: list[int] = []
    for start, end in sorted(zip([*old[::2], *new[::2]], [*old[1::2], *new[1::2]])):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def occurrences(documents: DataFrame, items: DataFrame, window: int = WINDOW, most: int = BLOCK_PATTERNS) -> DataFrame:
    """All rows and columns of ``documents`` (``text`` among them) with ``__hit_n_words``,
    ``__hit_ranges`` (words inside an occurrence: start, end, start, end, ...) and ``__hit_items`` (ids found, sorted).

    One pass per block of patterns; nothing is shuffled.
    """
    context = documents.sparkSession.sparkContext
    out = documents.withColumns({
        "__hit_n_words": F.lit(0).cast("long"),
        "__hit_ranges": F.array().cast("array<bigint>"),
        "__hit_items": F.array().cast("array<string>"),
    })

    def one_block(frame: DataFrame, shared) -> DataFrame:
        def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            at = [rows.schema.get_field_index(name) for name in ("text", "__hit_n_words", "__hit_ranges", "__hit_items")]
            hits = search(rows.column(at[0]), shared.value)
            ranges = [joined(a, b) if a else b for a, b in zip(rows.column(at[2]).to_pylist(), hits.ranges)]
            found = [sorted({*a, *b}) for a, b in zip(rows.column(at[3]).to_pylist(), hits.items)]
            for i, values in zip(at[1:], (hits.n_words, ranges, found)):
                rows = rows.set_column(i, rows.schema.field(i), pa.array(values, rows.schema.field(i).type))
            yield rows

        return per_batch(frame, run, frame.schema)

    none = True
    for block in blocks(items, window, most):
        out, none = one_block(out, context.broadcast(block)), False
    return one_block(out, context.broadcast(None)) if none else out


def figures(one_in: int = ONE_IN) -> dict[str, Column]:
    """The figures of a document as expressions over the columns of ``occurrences``."""
    ranges, n_words = F.col("__hit_ranges"), F.col("__hit_n_words")
    n_hit = F.aggregate(
        F.transform(ranges, lambda end, i: F.when(i % 2 == 1, end).otherwise(-end)),
        F.lit(0).cast("long"),
        lambda total, bound: total + bound,
    )
    return {
        "n_words": n_words,
        "n_hit": n_hit,
        "n_items": F.size("__hit_items").cast("long"),
        "items_sha256": F.sha2(F.array_join("__hit_items", ","), 256),
        "contaminated": (n_hit > 0) & (one_in * n_hit >= n_words),
    }


def clean(documents: DataFrame, items: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """The documents which are not contaminated, with their columns."""
    own, names = set_aside(documents, "__hit_")
    found = occurrences(own, items)
    kept = found.filter(~figures(one_in)["contaminated"]).select(*own.columns)
    return kept.withColumnsRenamed(names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: hits of all items in all documents."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = occurrences(documents, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *(figure.alias(name) for name, figure in figures().items()))


SQL = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
    FROM documents
), item AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
    FROM benchmark
), sized AS (
    SELECT item_id, w, least(13, len(w)) AS n FROM item WHERE len(w) > 0
), pattern AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS p
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), length AS (
    SELECT DISTINCT n FROM pattern
), hit AS (
    SELECT doc_id, i, n, item_id
    FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS p
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, length WHERE len(w) >= n)) AS place
    JOIN pattern USING (n, p)
), covered AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
