"""Embedding near-duplicates by a robust-pruned flat graph.

1. Equal vectors are one node, with the number of its copies. Centres are fitted on a bounded
   sample, and every node belongs to the ``OVERLAP`` shards with the nearest centres. A shard of
   more than ``MOST`` nodes is cut into blocks, and each two blocks are a shard of their own.
2. In each shard nodes are linked to their nearest and to some random nodes, pruned robustly: a
   candidate goes if it is nearer to a chosen one, by the factor ``ALPHA``, than to the node.
   Adjacency lists of a node from all its shards are united.
3. In each shard all nodes are searched for: greedily with a beam from the shard's medoid and the
   query's own list, then by range expansion, which follows the lists of whatever is in range.
4. What is in range is verified in double precision. Pairs are counted in their first common
   shard only, so that only counts and spanning forests leave a task, never all pairs of a group;
   forests are of all pairs found. So a pair which only a later common shard finds joins its
   components, but is missing in ``n_links``; the audit sees it as missing.
5. An audit compares bounded samples, of all nodes and of those with links, with all others by
   brute force, and counts distinct pairs; while its recall is below ``RECALL``, all is repeated
   with more overlap and a wider beam. If every shard holds every node and the recall is still
   missed, blocks of nodes are compared exactly.

Defined results: vectors that are null, zero, or hold null or non-finite components link with
nothing; vectors of another length than most link with those of their own length only; rows with
equal ids are vectors of their own; further columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import hashed_sample, per_batch, pieces, streamed, table, total, written
from llm.components import components, forest
from llm.passages import KEY, numbered

SIMILAR = 0.9
#: Nodes whose nearest centre a shard holds, on average; and most nodes of a shard.
SHARD, MOST = 2_000, 16_384
#: Nodes on which centres are fitted, at most; at most an eighth as many centres.
SAMPLE = 20_000
OVERLAP = 3
NEAREST, RANDOM, DEGREE = 32, 12, 24
ALPHA = 1.2
BEAM = 16
#: Nodes of the audit, and the least recall.
AUDIT, RECALL = 256, 0.9
#: Queries which are searched for together.
_QUERIES = 512
#: Nodes a little out of range are followed too, so that range expansion does not stop early.
_SLACK = 0.1


class Settings(NamedTuple):
    overlap: int = OVERLAP
    beam: int = BEAM

    def wider(self) -> Settings:
        return Settings(self.overlap * 2, self.beam * 2)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at unit length; scaled first, so that large numbers do not overflow when squared."""
    rows = rows / np.abs(rows).max(axis=-1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=-1, keepdims=True)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the vectors which can link, as doubles."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (
        vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
        .filter("embedding IS NOT NULL")
        .filter(F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0))
    )


IDENTITY = ["h1", "h2", "width"]


def with_identity(vectors: DataFrame) -> DataFrame:
    """Two hashes and the length of each vector, which equal vectors share."""
    return vectors.withColumns({
        "h1": F.xxhash64("embedding"), "h2": F.xxhash64("embedding", F.lit(1)), "width": F.size("embedding")
    })


def nodes(vectors: DataFrame) -> DataFrame:
    """One row per distinct vector: ``node`` (its smallest id), ``copies`` and ``embedding``."""
    return with_identity(vectors).groupBy(*IDENTITY).agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding")
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def centres(sample: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    """Spherical k-means on the sample."""
    rng = np.random.default_rng(3)
    found = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        nearest = (sample @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        filled = np.linalg.norm(sums, axis=1) > 0
        found = found.copy()
        found[filled] = unit(sums[filled])
    return found


def fitted(found: DataFrame, n: int) -> np.ndarray:
    """Centres of the nodes of one width, on at most ``SAMPLE`` of them, chosen by a hash."""
    rows = hashed_sample(found, "h1", SAMPLE, "node").select("embedding").toArrow()
    sample = unit(matrix(rows.column(0).combine_chunks()))
    return centres(sample, min(pieces(n, SHARD), max(1, len(sample) // 8)))


def assigned(found: DataFrame, middle: np.ndarray, overlap: int) -> DataFrame:
    """``node, copies, embedding`` with ``shards``, those of the nearest centres, ascending."""
    shared = found.sparkSession.sparkContext.broadcast(middle)
    schema = pa.schema([("node", pa.int64()), ("copies", pa.int64()), ("embedding", pa.list_(pa.float64())), ("shards", pa.list_(pa.int64()))])

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        similar = unit(matrix(rows.column(2))) @ shared.value.T
        m = min(overlap, similar.shape[1])
        nearest = np.sort(np.argpartition(-similar, m - 1, axis=1)[:, :m], axis=1).astype(np.int64)
        lists = pa.ListArray.from_arrays(np.arange(0, m * len(nearest) + 1, m, dtype=np.int32), pa.array(nearest.ravel()))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2).cast(schema.field(2).type), lists], schema=schema)

    return per_batch(found.select("node", "copies", "embedding"), run, "node long, copies long, embedding array<double>, shards array<bigint>")


def members(nodes_: DataFrame) -> DataFrame:
    """A row per node and shard it is searched in: ``part`` (the shard, or two of its blocks),
    ``node, copies, embedding, shards, shard, own`` (its block) and whether the part has two."""
    each = nodes_.withColumn("shard", F.explode("shards"))
    sizes = each.groupBy("shard").agg(F.ceil(2 * F.count("*") / MOST).cast("long").alias("n"))
    # A shard that fits is one block; otherwise blocks are half as large, and two make a part.
    sizes = sizes.withColumn("n", F.when(F.col("n") <= 2, 1).otherwise(F.col("n")).cast("long"))
    blocks = each.join(sizes, "shard").withColumn("own", F.pmod(F.xxhash64("node", F.lit(5)), F.col("n")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    return (
        blocks.withColumn("other", other)
        .withColumn("part", F.struct("shard", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")))
        .withColumn("pair", F.expr("part.low < part.high"))
        .drop("other", "n")
    )


class Part(NamedTuple):
    """The nodes of one part, sorted by id."""

    node: np.ndarray
    copies: np.ndarray
    exact: np.ndarray  # unit vectors in double precision
    shards: np.ndarray
    shard: int
    own: np.ndarray
    pair: bool
    lists: list | None


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
    """Parts of a partition sorted by part, one at a time."""
    held: list[pa.RecordBatch] = []

    def whole() -> Part:
        rows = pa.Table.from_batches(held).combine_chunks()
        column = {name: rows.column(name).combine_chunks() for name in rows.column_names}
        order = np.argsort(column["node"].to_numpy(), kind="stable")
        lists = column["lists"].to_pylist() if "lists" in column else None
        return Part(
            column["node"].to_numpy()[order], column["copies"].to_numpy()[order], unit(matrix(column["embedding"]))[order],
            matrix(column["shards"])[order], column["shard"][0].as_py(), column["own"].to_numpy()[order],
            column["pair"][0].as_py(), [lists[i] for i in order] if lists is not None else None,
        )

    current = None
    for rows in batches:
        name = rows.column(rows.schema.get_field_index("name")).to_numpy()
        begins = [0, *(np.flatnonzero(name[1:] != name[:-1]) + 1).tolist()] if len(name) else []
        for low, high in zip(begins, [*begins[1:], len(name)]):
            if held and name[low] != current:
                yield whole()
                held.clear()
            current = name[low]
            held.append(rows.slice(low, high - low))
    if held:
        yield whole()


def dealt(member: DataFrame) -> DataFrame:
    """Members with the hash ``name`` of their part, together and in order."""
    named = member.withColumn("name", F.xxhash64("part")).drop("part")
    return named.repartition("name").sortWithinPartitions("name")


def pruned(vectors: np.ndarray, seed: int) -> np.ndarray:
    """Adjacency of every node: at most ``DEGREE`` others, padded by the node itself."""
    n = len(vectors)
    out = np.repeat(np.arange(n)[:, None], DEGREE, axis=1)
    if n < 2:
        return out
    rng = np.random.default_rng(seed)
    near = min(NEAREST, n - 1)
    for low in range(0, n, 256):
        rows = np.arange(low, min(low + 256, n))
        similar = vectors[rows] @ vectors.T
        similar[np.arange(len(rows)), rows] = -2
        candidates = np.argpartition(-similar, near - 1, axis=1)[:, :near]
        far = rng.integers(0, n, (len(rows), RANDOM))
        candidates = np.concatenate([candidates, far], axis=1)
        to_node = np.take_along_axis(similar, candidates, axis=1)
        order = np.argsort(-to_node, axis=1, kind="stable")
        candidates, to_node = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(to_node, order, axis=1)
        distance = np.sqrt(np.maximum(2 - 2 * to_node, 0))
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("nid,njd->nij", vectors[candidates], vectors[candidates]), 0))
        alive = candidates != rows[:, None]
        for slot in range(DEGREE):
            first = alive.argmax(axis=1)
            some = alive[np.arange(len(rows)), first]
            if not some.any():
                break
            out[rows[some], slot] = candidates[some, first[some]]
            near_first = between[np.arange(len(rows)), first]
            alive &= ~((ALPHA * near_first <= distance) & some[:, None])
            alive[np.arange(len(rows)), first] = False
    return out


def graph(member: DataFrame) -> DataFrame:
    """``node, lists``: the united adjacency lists of every node, by id."""
    schema = pa.schema([("node", pa.int64()), ("neighbours", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            links = part.node[pruned(part.exact.astype(np.float32), part.shard)]
            ends = np.arange(0, links.size + 1, links.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part.node), pa.ListArray.from_arrays(ends, pa.array(links.ravel()))], schema=schema)

    lists = streamed(dealt(member), run, "node long, neighbours array<bigint>")
    return lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("lists"))


def local(part: Part) -> tuple[np.ndarray, np.ndarray]:
    """The part's graph with the reverse of every edge: offsets and neighbours by position."""
    n = len(part.node)
    source = np.repeat(np.arange(n), [len(x or ()) for x in part.lists])
    target = np.array([y for x in part.lists for y in x or ()], dtype=np.int64)
    place = np.minimum(np.searchsorted(part.node, target), n - 1)
    inside = (part.node[place] == target) & (place != source)
    source, place = source[inside], place[inside]
    both = np.unique(np.concatenate([source * n + place, place * n + source]))
    return np.searchsorted(both, np.arange(n + 1) * n), both % n


def expanded(offsets: np.ndarray, neighbours: np.ndarray, query: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each query with all neighbours of its node."""
    counts = offsets[node + 1] - offsets[node]
    first = np.repeat(offsets[node] - (np.cumsum(counts) - counts), counts)
    return np.repeat(query, counts), neighbours[first + np.arange(counts.sum())]


def in_range(vectors: np.ndarray, offsets: np.ndarray, neighbours: np.ndarray, queries: np.ndarray, medoid: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) the search finds within range and slack."""
    n, m = len(vectors), len(queries)
    seen = np.zeros((m, n), dtype=bool)
    similar = np.full((m, n), -2, dtype=np.float32)
    done = np.zeros((m, n), dtype=bool)
    rows = np.arange(m)

    def visit(query: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code = np.unique(query * n + node)
        query, node = code // n, code % n
        new = ~seen[query, node]
        query, node = query[new], node[new]
        seen[query, node] = True
        for low in range(0, len(query), 1 << 18):
            part = slice(low, low + (1 << 18))
            similar[query[part], node[part]] = np.einsum("nd,nd->n", vectors[queries[query[part]]], vectors[node[part]])
        return query, node

    visit(np.concatenate([rows, rows]), np.concatenate([np.full(m, medoid), queries]))
    width = min(beam, n)
    active = rows
    while len(active):  # each step takes the best node of the beam that is not expanded yet
        best = np.argpartition(-similar[active], width - 1, axis=1)[:, :width]
        value = np.take_along_axis(similar[active], best, axis=1)
        value[np.take_along_axis(done[active], best, axis=1)] = -3
        pick = value.argmax(axis=1)
        going = value[np.arange(len(active)), pick] > -2
        active, node = active[going], best[np.arange(len(best)), pick][going]
        done[active, node] = True
        visit(*expanded(offsets, neighbours, active, node))
    limit = SIMILAR - _SLACK
    query, node = np.nonzero((similar >= limit) & ~done)
    while len(query):
        done[query, node] = True
        query, node = visit(*expanded(offsets, neighbours, query, node))
        near = similar[query, node] >= limit
        query, node = query[near], node[near]
        fresh = ~done[query, node]
        query, node = query[fresh], node[fresh]
    return np.nonzero(similar >= SIMILAR - 1e-3)


def verified(part: Part, beam: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs of positions in a part, and which of them are to be counted here. Without a
    ``beam`` all nodes are compared."""
    n = len(part.node)
    vectors = part.exact.astype(np.float32)
    if beam is not None:
        offsets, neighbours = local(part)
        medoid = int((vectors @ vectors.mean(axis=0)).argmax())
    found = [np.zeros(0, dtype=np.int64)]
    for low in range(0, n, _QUERIES):
        queries = np.arange(low, min(low + _QUERIES, n))
        if beam is None:
            query, node = np.nonzero(vectors[queries] @ vectors.T >= SIMILAR - 1e-3)
        else:
            query, node = in_range(vectors, offsets, neighbours, queries, medoid, beam)
        query = queries[query]
        other = query != node
        found.append(np.minimum(query, node)[other] * n + np.maximum(query, node)[other])
    code = np.unique(np.concatenate(found))
    a, b = code // n, code % n
    keep = np.ones(len(a), dtype=bool)
    for at in range(0, len(a), 1 << 17):
        part_ = slice(at, at + (1 << 17))
        keep[part_] = np.einsum("nd,nd->n", part.exact[a[part_]], part.exact[b[part_]]) >= SIMILAR
    a, b = a[keep], b[keep]
    common = part.shards[a][:, :, None] == part.shards[b][:, None, :]
    first = np.where(common.any(axis=2), part.shards[a], np.iinfo(np.int64).max).min(axis=1)
    here = first == part.shard
    if part.pair:
        here &= part.own[a] != part.own[b]
    return a, b, here


def searched(member: DataFrame, beam: int | None) -> DataFrame:
    """``a, b, n, pairs``: counts of links found, with copies and without (``b`` null, one row per
    node and part), and forests of the links (``n, pairs`` null)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("pairs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            a, b, here = verified(part, beam)
            if len(a):
                n = len(part.node)
                left, right = forest(part.node[a], part.node[b])
                a, b = a[here], b[here]
                weight = part.copies.astype(np.float64)
                links = np.bincount(a, weight[b], n) + np.bincount(b, weight[a], n)
                pairs = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
                some = np.flatnonzero(pairs)
                none = pa.nulls(len(left), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(part.node[some]), pa.nulls(len(some), pa.int64()), pa.array(links[some].astype(np.int64)), pa.array(pairs[some])], schema=schema)
                yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right), none, none], schema=schema)

    return streamed(dealt(member), run, "a long, b long, n long, pairs long")


def recall(found: DataFrame, counts: DataFrame, sample: int = AUDIT) -> float:
    """Distinct pairs found of those a brute-force comparison of nodes with all others finds.

    ``counts`` has ``node, pairs``. ``sample`` of all nodes, which may have no link, and as many of
    those with links are chosen by a hash and broadcast, and each task adds up what it sees.
    """
    linked = found.join(counts.select("node"), "node", "left_semi")
    either = [hashed_sample(df, "h2", sample, "node").select("node", "embedding") for df in (found, linked)]
    chosen = either[0].unionByName(either[1]).dropDuplicates(["node"]).toArrow()
    ids = chosen.column(0).to_numpy()
    queries = unit(matrix(chosen.column(1).combine_chunks()))
    shared = found.sparkSession.sparkContext.broadcast((ids, queries))

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids_, queries_ = shared.value
        near = (unit(matrix(rows.column(2))) @ queries_.T >= SIMILAR) & (rows.column(0).to_numpy()[:, None] != ids_[None, :])
        yield pa.RecordBatch.from_arrays([pa.array(ids_), pa.array(near.sum(axis=0))], names=["node", "n"])

    truth = per_batch(found.select("node", "copies", "embedding"), run, "node long, n long").groupBy("node").agg(F.sum("n").alias("truth"))
    true, seen = (
        truth.join(counts, "node", "left").agg(F.sum("truth"), F.sum(F.least("truth", F.coalesce("pairs", F.lit(0))))).first()
    )
    return 1.0 if not true else seen / true


class Links(NamedTuple):
    counts: DataFrame  # node, n, pairs
    forest: DataFrame  # a, b
    recall: float


def links(found: DataFrame, settings: Settings = Settings()) -> Links:
    """Links of the nodes of one width, with the recall of the audit; it is repeated with wider
    settings until that is reached. If every shard holds every node already, one shard is left,
    whose blocks are compared exactly."""
    n = total(found)
    middle = fitted(found, n)

    def result(found_links: DataFrame) -> Links:
        results = written(found_links, "links")
        counts = results.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"), F.sum("pairs").alias("pairs"))
        return Links(counts, results.filter("b IS NOT NULL").select("a", "b"), recall(found, counts))

    while True:
        member = written(members(assigned(found, middle, settings.overlap)), "members")
        reached = result(searched(member.join(graph(member), "node"), settings.beam))
        if reached.recall >= RECALL:
            return reached
        if settings.overlap >= len(middle):
            return result(searched(members(assigned(found, middle[:1], 1)), None))
        settings = settings.wider()


def near_duplicates(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    rows = numbered(vectors.select(F.col("vec_id").cast("long"), "embedding"), "vec_id", "embedding")
    ids = rows.select(F.col(KEY).alias("key"), "vec_id")
    good = usable(rows.select(F.col(KEY).alias("vec_id"), "embedding"))
    every = written(nodes(good), "nodes")
    widths = [row.width for row in every.select("width").distinct().collect()]
    found = [links(every.filter(F.col("width") == width), settings) for width in widths]
    if not found:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = reduce(DataFrame.unionByName, (x.counts for x in found))
    joined = components(reduce(DataFrame.unionByName, (x.forest for x in found)))
    per_node = every.join(counts.select("node", "n"), "node", "left").join(joined, "node", "left").select(
        *IDENTITY, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")
    )
    linked = with_identity(good).join(per_node, IDENTITY).select(F.col("vec_id").alias("key"), "n_links", "component")
    every_row = ids.join(linked, "key", "left").withColumn("component", F.coalesce("component", "key"))
    named = every_row.join(ids.select(F.col("key").alias("component"), F.col("vec_id").alias("component_id")), "component")
    return named.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: links and components of all vectors."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE vec AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vec x JOIN vec y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.9
), reach AS (
    SELECT vec_id AS node, vec_id AS other FROM embeddings
    UNION
    SELECT node, b FROM reach JOIN link ON other = a
), component AS (
    SELECT node, min(other) AS component_id FROM reach GROUP BY node
), degree AS (
    SELECT a, count(*) AS n FROM link GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component ON node = vec_id LEFT JOIN degree ON a = vec_id
"""
