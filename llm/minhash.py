"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two values of the signature, its smallest and its
largest, so half the hash evaluations make a signature of the same length, whose estimate is
unbiased and of lower variance. ``ROWS`` values make a band; documents which agree in a band meet.

1. Documents with equal shingle sets are one class; its smallest document stands for it.
2. In each band, the members of a bucket are linked to one centre, which the same hash order
   chooses in all bands. Pairs whose sketches (two bits per value) are too far apart fall away;
   the others are confirmed on the full sets. Connected components follow.
3. Where a bucket still holds several components, every pair of members from different ones is
   compared on the sets, in blocks of members, so no link is lost to the choice of centres and no
   pair is emitted but the linked ones.

Two documents with a similarity of just 0.75 miss each other in all bands with odds of one in a
million, and those of 0.8 with one in ten million. Defined results: a document with fewer than
five words is one shingle of them all; without words or text it is linked with nothing; rows with
equal ids are documents of their own in the order of their texts; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import hashing
from llm.common import per_batch, pieces, set_aside, streamed, table, total, written
from llm.components import components
from llm.passages import KEY, keyed, numbered

SHINGLE = 5
SIMILAR, OF = 75, 100  # link if OF * intersection >= SIMILAR * union
PERMUTATIONS = 128
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
#: Members of a bucket which are compared with each other in one cell.
MEMBERS = 512
#: Bytes of sets in one cell when pairs are confirmed.
CELL_BYTES = 16 << 20
#: Standard deviations by which a sketch may be off before a pair falls away.
DEVIATIONS = 5.5

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32)
_WORDS = 2 * PERMUTATIONS // 64  # 64 bit words of one bit of each value


def shingles(chunk: hashing.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, document by document and ascending, and ``n + 1`` offsets."""
    words = hashing.words(chunk, hashing.LOWERED)
    sums = hashing.prefix_sums(words.hashes)
    counts = words.counts()
    start = np.flatnonzero(hashing.inside_mask(words.offsets, SHINGLE))
    owner = np.searchsorted(words.offsets, start, side="right") - 1
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    value = np.concatenate([
        hashing.range_hash(sums, start, start + SHINGLE, 3),
        hashing.range_hash(sums, words.offsets[short], words.offsets[short + 1], 3),
    ])
    owner = np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(chunk.size + 1))


def signatures(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Minimum and maximum of each permutation, a row per document that has shingles."""
    counts = np.diff(offsets)
    begins = offsets[:-1][counts > 0]
    out = np.zeros((len(begins), 2 * PERMUTATIONS), dtype=np.uint32)
    if len(begins):
        base = (value >> np.uint64(32)).astype(np.uint32)
        for i in range(PERMUTATIONS):
            permuted = base * _FACTORS[i] + _SHIFTS[i]
            out[:, 2 * i] = np.minimum.reduceat(permuted, begins)
            out[:, 2 * i + 1] = np.maximum.reduceat(permuted, begins)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """One hash per band, which also says which band it is."""
    out = np.zeros((len(signature), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        value = np.full(len(signature), band, dtype=np.uint64)
        for row in range(ROWS):
            value = hashing.mix(value, 31) + signature[:, band * ROWS + row]
        out[:, band] = hashing.mix(value, 32)
    return out


def sketch(signature: np.ndarray) -> np.ndarray:
    """Two bits of every value, as two planes of 64 bit words."""
    mixed = hashing.mix(signature.astype(np.uint64), 33)
    planes = [np.packbits(((mixed >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8), axis=1) for bit in (60, 40)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view(np.int64).reshape(len(signature), 2 * _WORDS)


_PROFILE = pa.schema([
    ("key", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
    ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())),
])
PROFILE = "key long, n_shingles long, set_a long, set_b long, bands array<bigint>, sketch array<bigint>"


def profiles(documents: DataFrame) -> DataFrame:
    """Of ``key, text``: set size, two hashes of the set, bands and sketch (null without words)."""

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for chunk in hashing.chunks(rows.column(1)):
            value, offsets = shingles(chunk)
            counts = np.diff(offsets)
            some = counts > 0
            identity = []
            for salt in (41, 42):
                sums = np.concatenate([[np.uint64(0)], np.cumsum(hashing.mix(value, salt))])
                identity.append(pa.array((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64)))
            signature = signatures(value, offsets)

            def lists(numbers: np.ndarray) -> pa.Array:
                width = numbers.shape[1]
                ends = np.concatenate([[0], np.cumsum(np.where(some, width, 0))]).astype(np.int32)
                flat = pa.array(np.ascontiguousarray(numbers).view(np.int64).ravel())
                return pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~some, False)), flat)

            yield pa.RecordBatch.from_arrays(
                [rows.column(0).slice(chunk.first, chunk.size), pa.array(counts), *identity, lists(bands(signature)), lists(sketch(signature))],
                schema=_PROFILE,
            )

    return per_batch(documents.select("key", "text"), run, PROFILE)


def apart(left: str, right: str) -> Column:
    """Values of the signature whose two bits differ between two sketches."""
    total_ = F.lit(0)
    for i in range(_WORDS):
        first = F.get(left, F.lit(i)).bitwiseXOR(F.get(right, F.lit(i)))
        second = F.get(left, F.lit(i + _WORDS)).bitwiseXOR(F.get(right, F.lit(i + _WORDS)))
        total_ = total_ + F.bit_count(first.bitwiseOR(second))
    return total_


def most_apart() -> int:
    """Differing values a linked pair of the lowest similarity has at most, by the deviations."""
    n, odds = 2 * PERMUTATIONS, (1 - SIMILAR / OF) * 0.75
    return int(n * odds + DEVIATIONS * (n * odds * (1 - odds)) ** 0.5)


def sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, set``: the full sets, 64 bits per shingle, of the documents in ``wanted``."""
    schema = pa.schema([("key", pa.int64()), ("set", pa.binary())])

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for chunk in hashing.chunks(rows.column(1)):
            value, offsets = shingles(chunk)
            packed = [value[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([rows.column(0).slice(chunk.first, chunk.size), pa.array(packed, pa.binary())], schema=schema)

    return per_batch(documents.join(wanted, "key", "left_semi").select("key", "text"), run, "key long, set binary")


def linked(intersection: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return OF * intersection >= SIMILAR * (first + second - intersection)


def confirmed(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs ``a, b`` which are similar on their full sets.

    Documents are dealt into blocks by a hash; a pair belongs to the cell of its two blocks, and
    a set goes to the cells where it is needed, once each. There are as many blocks as the
    measured size of the sets asks for, so a cell's sets fit into a task.
    """
    size = full.agg(F.sum(F.octet_length("set"))).first()[0] or 0
    n = max(8, pieces(int(size), CELL_BYTES // 4))
    block = lambda c: F.pmod(F.xxhash64(c, F.lit(51)), F.lit(n))
    dealt = pairs.withColumn("cell", block(F.col("a")) * n + block(F.col("b")))
    needed = dealt.select("cell", F.explode(F.array("a", "b")).alias("key")).distinct()
    placed = needed.join(full, "key").select("cell", F.lit(0).alias("kind"), F.col("key").alias("a"), F.lit(0).cast("long").alias("b"), "set")
    rows = placed.unionByName(dealt.select("cell", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("binary").alias("set")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}
        for part in batches:
            found: list[tuple[int, int]] = []
            for where, kind, a, b, packed in zip(*(c.to_pylist() for c in part.columns)):
                if where != cell:
                    cell, held = where, {}
                if kind == 0:
                    held[a] = np.frombuffer(packed, dtype=np.uint64)
                else:
                    x, y = held[a], held[b]
                    if len(x) > len(y):
                        x, y = y, x
                    if OF * len(x) >= SIMILAR * len(y):
                        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                        if linked(int((y[at] == x).sum()), len(x), len(y)):
                            found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    ordered = rows.repartition("cell").sortWithinPartitions("cell", "kind", "a")
    return streamed(ordered, run, "a long, b long")


def with_components(frame: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """``frame`` with ``component`` of the node ``key``, itself where it has no link."""
    return frame.join(found.withColumnRenamed("node", key), key, "left").withColumn("component", F.coalesce("component", key))


def across(rows: DataFrame, full: DataFrame) -> DataFrame:
    """Pairs of members of a bucket, of different components, which may be similar.

    ``rows`` are ``bucket, key, component`` of buckets with several components, with the number
    of blocks ``n`` the bucket is cut into. Each two blocks of a bucket make a cell; a cell's
    intersections are a product of incidence matrices over the lower half of the hashes, which can
    only be too large, so what it finds is confirmed on the full sets.
    """
    own = F.pmod(F.xxhash64("key", F.lit(52)), F.col("n"))
    dealt = (
        rows.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("cell", F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")))
        .withColumn("side", F.when(F.col("block") <= F.col("other"), 0).otherwise(1))
        .select("cell", "side", "key", "component")
    )
    with_sets = dealt.join(full, "key").select("cell", "side", "key", "component", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for part in batches:
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if row[0] != cell and held:
                    yield from judged(held)
                    held = []
                cell = row[0]
                held.append((*row[1:4], (np.frombuffer(row[4], dtype=np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.uint32)))
        if held:
            yield from judged(held)

    def judged(members: list[tuple]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(m[3]) for m in members])
        key = np.array([m[1] for m in members])
        component = np.array([m[2] for m in members])
        side = np.array([m[0] for m in members])
        value = np.concatenate([m[3] for m in members])
        _, index, often = np.unique(value, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(often > 1)
        rank = np.full(len(often), -1)
        rank[shared] = np.arange(len(shared))
        column, row = rank[index], np.repeat(np.arange(len(members)), sizes)
        product = np.zeros((len(members), len(members)), dtype=np.float32)
        step = max(256, (1 << 24) // max(1, len(members)))
        for low in range(0, len(shared), step):
            inside = (column >= low) & (column < low + step)
            incidence = np.zeros((len(members), min(step, len(shared) - low)), dtype=np.float32)
            np.add.at(incidence, (row[inside], column[inside] - low), 1)
            product += incidence @ incidence.T
        wanted = linked(product, sizes[:, None], sizes[None, :]) & (component[:, None] != component[None, :])
        if len(np.unique(side)) > 1:  # a cell of two blocks; pairs within one have a cell of their own
            wanted &= side[:, None] != side[None, :]
        a, b = np.nonzero(np.triu(wanted, 1))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(key[a]), pa.array(key[b])], names=["a", "b"])

    ordered = with_sets.repartition("cell").sortWithinPartitions("cell")
    return streamed(ordered, run, "a long, b long")


def classes(documents: DataFrame) -> DataFrame:
    """``key, n_shingles, component`` of every document (``key, text``)."""
    profile = written(profiles(documents), "profiles")
    some = profile.filter("n_shingles > 0")
    identity = ["set_a", "set_b", "n_shingles"]
    leaders = written(some.groupBy(*identity).agg(F.min("key").alias("leader")), "leaders")
    leading = some.join(leaders.select(F.col("leader").alias("key")), "key", "left_semi")
    members = leading.select("key", F.explode("bands").alias("bucket"))

    # The centre of a bucket is its member with the smallest hash: mostly the same in all bands.
    order = F.struct(F.xxhash64("key", F.lit(53)).alias("rank"), F.col("key").alias("centre"))
    buckets = members.groupBy("bucket").agg(F.min(order).alias("first"), F.count("*").alias("size")).filter("size > 1")
    shared = written(
        members.join(buckets, "bucket").select("bucket", "key", F.col("first.centre").alias("centre"), "size"), "buckets"
    )
    sketches = leading.select("key", "sketch")
    near = (
        shared.filter("key <> centre").select(F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b")).distinct()
        .join(sketches.select(F.col("key").alias("a"), F.col("sketch").alias("left")), "a")
        .join(sketches.select(F.col("key").alias("b"), F.col("sketch").alias("right")), "b")
        .filter(apart("left", "right") <= most_apart())
        .select("a", "b")
    )
    near = written(near, "pairs")
    several = shared.filter("size > 2").select("key")
    wanted = near.select(F.explode(F.array("a", "b")).alias("key")).unionByName(several).distinct()
    full = written(sets(documents, wanted), "sets")
    edges = written(confirmed(near, full), "links")
    first_found = components(edges)

    labelled = written(with_components(shared.filter("size > 2").select("bucket", "key", "size"), "key", first_found), "members")
    open_ = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).filter("low < high")
    rows = labelled.select("bucket", "key", "component").join(
        open_.select("bucket", F.ceil(F.col("size") / MEMBERS).cast("long").alias("n")), "bucket"
    )
    more = across(rows, full).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = written(confirmed(more, full), "links")
    found = components(edges.unionByName(more)) if total(more) else first_found

    grouped = with_components(leaders, "leader", found)
    in_class = some.select("key", *identity).join(grouped, identity).select("key", "n_shingles", "component")
    alone = profile.filter("n_shingles = 0").select("key", "n_shingles", F.col("key").alias("component"))
    return in_class.unionByName(alone)


def verdicts(documents: DataFrame) -> DataFrame:
    """``key, doc_id, n_shingles, component_id, kept`` of documents with keys."""
    ids = documents.select("key", "doc_id")
    named = classes(documents).join(ids, "key").join(
        ids.select(F.col("key").alias("component"), F.col("doc_id").alias("component_id")), "component"
    )
    return named.select("key", "doc_id", "n_shingles", "component_id", (F.col("key") == F.col("component")).alias("kept"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """The documents with the smallest id of their group, with all their columns."""
    own, names = set_aside(documents, KEY)
    rows = numbered(own)
    found = classes(rows.select(F.col(KEY).alias("key"), "doc_id", "text"))
    first = found.filter("key = component").select(F.col("key").alias(KEY))
    return rows.join(first, KEY, "left_semi").select(*own.columns).withColumnsRenamed(names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: set size, component and verdict of every document."""
    found = verdicts(keyed(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL = r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM common c JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
    WHERE 100 * c.n >= 75 * (p.n + q.n - c.n)
), reach AS (
    SELECT doc_id AS node, doc_id AS other FROM doc
    UNION
    SELECT node, b FROM reach JOIN link ON other = a
), component AS (
    SELECT node, min(other) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM doc LEFT JOIN size USING (doc_id) JOIN component ON node = doc_id
"""
