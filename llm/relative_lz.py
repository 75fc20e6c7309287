"""Substring dedup by relative Lempel-Ziv parsing: greedy factors against indexed reference blocks.

The reference is the corpus itself, cut into passages. Passages that share an anchor form a block:
one indexed by its windows, which a passage is sent to if it can share a window with it. The
passages of a block are parsed in the order of the documents against those before them (and against
their own words before): at a place whose window the index knows, the factor is extended word by
word as far as its reference goes on. A factor of at least a window is a duplicate span. Where it
ends, each window that reaches over the boundary is looked up by itself, so a span that goes on in
another part of the reference is found as well. Windows are found by hashes and compared by words'
64 bit hashes.

Words are runs without ASCII white space. Defined results: a null text has no words and an empty
remainder; a text shorter than a window keeps all its words; rows with equal ids are documents of
their own in the order of their texts; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import hashing, passages
from llm.common import per_batch, table

WINDOW = 20
ANCHOR = 6


def index(words: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Per window, of the places ``at`` in ascending order, the first place of an equal one."""
    hashed = hashing.range_hash(hashing.prefix_sums(words), at, at + window, 8)
    _, first, inverse = np.unique(hashed, return_index=True, return_inverse=True)
    first = at[first[inverse]]
    same = np.ones(len(at), dtype=bool)
    for i in range(window):
        same &= words[at + i] == words[first + i]
    for i in np.flatnonzero(~same):  # equal hashes of unequal windows
        mine = words[at[i] : at[i] + window]
        earlier = np.flatnonzero(hashed[: i + 1] == hashed[i])
        first[i] = next(at[j] for j in earlier if np.array_equal(words[at[j] : at[j] + window], mine))
    return first


def factors(words: np.ndarray, at: np.ndarray, ends: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """Place, reference and length of the greedy factors of at least a window.

    ``at`` are the places at which windows begin, ascending, and ``ends`` where the passage of each
    ends.
    """
    first = index(words, at, window)
    known = np.flatnonzero(first < at)
    found = []
    reached = 0  # windows that begin before are inside the last factor
    where, end_of = at[known].tolist(), dict(zip(at.tolist(), ends.tolist()))
    for n, (place, reference) in enumerate(zip(where, first[known].tolist())):
        if place < reached:
            continue
        most = min(end_of[place] - place, end_of[reference] - reference)
        length = window
        if n + 1 < len(where) and where[n + 1] == place + 1:
            differs = words[place + window : place + most] != words[reference + window : reference + most]
            length = window + int(differs.argmax()) if differs.any() else most
        found.append((place, reference, length))
        # The next window to look up is the first that reaches over the boundary.
        reached = place + length - window + 1
    return found


def parse(numbers: list[np.ndarray], payloads: list[bytes], window: int = WINDOW) -> np.ndarray:
    """Which windows of the passages lie in a factor; equal windows have the same anchor, so the
    reference of a passage is among the passages of its anchor before it."""
    words = np.frombuffer(b"".join(payloads), dtype=np.uint64)
    windows = numbers[3].astype(np.int64)
    ends = np.cumsum(windows + window - 1)
    owner = np.repeat(np.arange(len(windows)), windows)
    number = np.cumsum(windows) - windows
    inside = np.arange(len(owner)) - number[owner]
    at = (ends - windows - window + 1)[owner] + inside
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    for place, _, length in factors(words, at, ends[owner], window):
        covered[place] += 1
        covered[place + length - window + 1] -= 1
    return np.cumsum(covered)[at] > 0


def kind_of(window: int = WINDOW, anchor: int = ANCHOR) -> passages.Kind:
    return passages.Kind(window, min(anchor, window), by_words=True, first_too=False)


def deduplicated(documents: DataFrame, window: int = WINDOW, group: int = passages.GROUP) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, spans``: the words left, joined by a space, and the
    removed runs of words (start, end)."""
    kind = kind_of(window)
    method = lambda numbers, payloads: parse(numbers, payloads, window)
    found = passages.spans(passages.keyed(documents), kind, method, group)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()),
        ("spans", pa.list_(pa.int64())),
    ])

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, texts, places = (rows.column(rows.schema.get_field_index(c)) for c in ("doc_id", "text", "places"))
        out: list[tuple] = []
        held = 0
        first = 0
        for row, text in enumerate(texts.cast(pa.binary())):
            words = (text.as_py() or b"").split()
            removed: list[int] = []
            n_removed = 0
            kept = words
            if places[row].is_valid:
                covered = passages.covered_units(places, row, len(words), kind)
                n_removed = int(covered.sum())
                kept = [word for word, gone in zip(words, covered.tolist()) if not gone]
                change = np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8))
                removed = np.flatnonzero(change).tolist()
            out.append((len(words), n_removed, b" ".join(kept), removed))
            held += len(out[-1][2])
            if held > 8 << 20 or row + 1 == rows.num_rows:
                columns = [ids.slice(first, len(out)), *(pa.array(c, f.type) for c, f in zip(zip(*out), list(schema)[1:]))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                out, held, first = [], 0, row + 1

    kinds = "doc_id long, n_words long, n_removed long, kept binary, spans array<bigint>"
    return per_batch(found.select("doc_id", "text", "places"), run, kinds)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: all documents, windows of 20 words."""
    found = deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), place AS (
    SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS p
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM doc WHERE len(w) >= 20)
), later AS (
    SELECT doc_id, i FROM place QUALIFY row_number() OVER (PARTITION BY p ORDER BY doc_id, i) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later
), left_over AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM doc)
    ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN left_over USING (doc_id)
"""
