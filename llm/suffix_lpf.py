"""Window dedup by suffix arrays and longest-previous-factor arrays, over the bytes of the texts.

Passages which share an anchor are concatenated in the order of the documents, with a separator
between them. Their suffix array comes from ranks of prefixes whose length triples; only suffixes
which still share a rank are sorted again. Of the suffixes in that order the nearest with a smaller
place, before and after, are the two candidates for the longest previous factor; the ranks give the
length it shares with each. Where that reaches the window, the window at this place occurred before.
Later copies are removed, and with ``first_too`` the first one as well: the source of a factor that
reaches the window.

Defined results: a null text is empty; a text shorter than a window keeps all its bytes; rows with
equal ids are documents of their own in the order of their texts; matches never cross documents;
further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import passages
from llm.common import per_batch, table

WINDOW = 400
ANCHOR = 32


class Suffixes(NamedTuple):
    """Suffixes of passages in lexicographic order, and equality of prefixes by ranks."""

    order: np.ndarray
    symbols: np.ndarray  # bytes + 1, separators 0, padded
    levels: list[tuple[int, np.ndarray]]  # prefix length, and the rank of the prefix at each place

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``a`` and ``b``."""
        length = np.zeros(len(a), dtype=np.int64)
        top = self.levels[-1][0]
        for size, rank in reversed(self.levels):
            for _ in range(2 if size < top else 1):
                length += size * (rank[a + length] == rank[b + length])
        going = np.ones(len(a), dtype=bool)
        for _ in range(_FIRST - 1):
            going &= self.symbols[a + length] == self.symbols[b + length]
            length += going
        return length


#: Symbols of the shortest prefix; 9 bits each.
_FIRST = 7


def suffixes(payloads: list[bytes]) -> Suffixes:
    """Suffix array of the payloads, each followed by a separator, as far as they reach."""
    longest = max(map(len, payloads))
    n = sum(map(len, payloads)) + len(payloads)
    sizes = [_FIRST]
    while sizes[-1] <= longest:
        sizes.append(3 * sizes[-1])
    pad = 3 * sizes[-1]
    data = np.frombuffer(b"\0".join(payloads) + b"\0", dtype=np.uint8)
    symbols = np.zeros(n + pad, dtype=np.uint16)
    symbols[:n] = data + np.uint16(1)
    ends = np.cumsum([len(p) + 1 for p in payloads]) - 1
    symbols[ends] = 0

    key = np.zeros(n, dtype=np.uint64)
    for i in range(_FIRST):
        key = (key << np.uint64(9)) | symbols[i : i + n]
    order = np.argsort(key, kind="stable")
    slots = np.arange(n)
    rank = np.zeros(n + pad, dtype=np.uint32)
    key = key[order]
    levels = []
    bits = np.uint64(n.bit_length())
    for size in sizes:
        # A rank is the first slot of the group, so groups that part leave the others' ranks alone.
        fresh = np.ones(len(slots), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        heads = np.maximum.accumulate(np.where(fresh, slots, 0))
        rank[order[slots]] = heads + 1
        levels.append((size, rank.copy()))
        if size == sizes[-1]:
            break
        last = np.ones(len(slots), dtype=bool)
        last[:-1] = fresh[1:]
        slots = slots[~(fresh & last)]
        if not len(slots):
            break
        at = order[slots]
        parts = [rank[at + i * size].astype(np.uint64) for i in range(3)]
        if 3 * int(bits) <= 64:
            key = (((parts[0] << bits) | parts[1]) << bits) | parts[2]
        else:
            # Two numbers of a pair become one by their rank.
            _, tail = np.unique((parts[1] << np.uint64(32)) | parts[2], return_inverse=True)
            key = (parts[0] << np.uint64(32)) | tail.astype(np.uint64)
        by = np.argsort(key, kind="stable")
        order[slots], key = at[by], key[by]
    return Suffixes(order, symbols, levels)


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each one, -1 if there is none.

    What lies between an index and its candidate is larger than the value, so a candidate that is
    larger itself is passed over together with all that it has passed over: paths double.
    """
    found = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero((found >= 0) & (values[found] > values))
    while len(open_):
        found[open_] = found[found[open_]]
        to = found[open_]
        open_ = open_[(to >= 0) & (values[to] > values[open_])]
    return found


def longest_previous(found: Suffixes, place: np.ndarray, rest: np.ndarray, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Per ``place`` (ascending) the length of the longest factor that also begins at an earlier
    place, and that place (-1 and 0 if there is none). ``rest`` is what is left of each passage.

    With ``least``, factors that are shorter may count as 0.
    """
    index = np.full(len(found.symbols), -1, dtype=np.int64)
    index[place] = np.arange(len(place))
    ranked = index[found.order]
    ranked = ranked[ranked >= 0]  # the places, by number, in suffix order
    before = nearest_smaller(ranked)
    after = len(ranked) - 1 - nearest_smaller(ranked[::-1])[::-1]
    length, source = np.zeros(len(place), dtype=np.int64), np.full(len(place), -1, dtype=np.int64)
    sure = [(size, rank) for size, rank in found.levels if size <= least][-1:]
    for neighbour in (before, after):
        has = np.flatnonzero((neighbour >= 0) & (neighbour < len(ranked)))
        mine, other = ranked[has], ranked[neighbour[has]]
        for size, rank in sure:
            alike = rank[place[mine]] == rank[place[other]]
            mine, other = mine[alike], other[alike]
        common = np.minimum(found.common(place[mine], place[other]), np.minimum(rest[mine], rest[other]))
        better = common > length[mine]
        length[mine[better]], source[mine[better]] = common[better], other[better]
    return length, source


def compare(numbers: list[np.ndarray], payloads: list[bytes], window: int = WINDOW, first_too: bool = True) -> np.ndarray:
    """Which windows of the passages occur among them again."""
    windows = numbers[3].astype(np.int64)
    begin = np.cumsum(windows + window) - (windows + window)
    owner = np.repeat(np.arange(len(windows)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    rest = (windows + window - 1)[owner] - inside
    # Passages are sorted by anchor, so the order of places is that of documents where it matters.
    length, source = longest_previous(suffixes(payloads), begin[owner] + inside, rest, window)
    again = length >= window
    if first_too:
        again[source[again]] = True
    return again


def deduplicated(documents: DataFrame, window: int = WINDOW, first_too: bool = True, group: int = passages.GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, kept, spans``: the bytes left, and the maximal removed runs
    (start, end)."""
    kind = passages.Kind(window, min(ANCHOR, window), by_words=False, first_too=first_too)
    method = lambda numbers, payloads: compare(numbers, payloads, window, first_too)
    found = passages.spans(passages.keyed(documents), kind, method, group)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()),
        ("spans", pa.list_(pa.int64())),
    ])

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, texts, places = (rows.column(rows.schema.get_field_index(c)) for c in ("doc_id", "text", "places"))
        out: list[tuple] = []
        held = first = 0
        for row, text in enumerate(texts.cast(pa.binary())):
            data = text.as_py() or b""
            removed: list[int] = []
            kept = data
            if places[row].is_valid:
                covered = passages.covered_units(places, row, len(data), kind)
                kept = np.frombuffer(data, dtype=np.uint8)[~covered].tobytes()
                removed = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8))).tolist()
            out.append((len(data), len(data) - len(kept), kept, removed))
            held += len(kept)
            if held > 8 << 20 or row + 1 == rows.num_rows:
                columns = [ids.slice(first, len(out)), *(pa.array(c, f.type) for c, f in zip(zip(*out), list(schema)[1:]))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                out, held, first = [], 0, row + 1

    kinds = "doc_id long, n_bytes long, n_removed long, kept binary, spans array<bigint>"
    return per_batch(found.select("doc_id", "text", "places"), run, kinds)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: all documents, windows of 400 bytes, every copy removed."""
    found = deduplicated(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed",
        F.floor(F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# Bytes as pairs of hexadecimal digits.
SQL = """
WITH doc AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), place AS (
    SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 800)) AS p
    FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM doc WHERE length(h) >= 800)
), again AS (
    SELECT doc_id, i FROM place QUALIFY count(*) OVER (PARTITION BY p) > 1
), stretch AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS fresh FROM again
), run AS (
    SELECT doc_id, min(i) AS low, max(i) + 400 AS high
    FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM stretch) GROUP BY doc_id, run
), gap AS (
    SELECT doc_id, high AS low, lead(low) OVER (PARTITION BY doc_id ORDER BY low) AS high FROM run
    UNION ALL SELECT doc_id, 0, min(low) FROM run GROUP BY doc_id
), left_over AS (
    SELECT doc_id, string_agg(substr(h, 2 * low + 1, 2 * (coalesce(high, length(h) // 2) - low)), '' ORDER BY low) AS kept
    FROM gap JOIN doc USING (doc_id) GROUP BY doc_id
), total AS (
    SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM doc LEFT JOIN left_over USING (doc_id) LEFT JOIN total USING (doc_id)
"""
