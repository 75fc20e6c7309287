"""A Merkle manifest of a dataset: trees of SHA-256 digests, folded again for changed rows.

Every 8 consecutive nodes become their hash until one is left. Three levels, 512 nodes, are a
chunk: one row, hashed by one task. The roots of the chunks are the nodes of the next round, so
a tree of any size takes a round for every three levels, and a tree is never held by one task.

A parent keeps a copy of its hash state from before each child slot. A changed row is folded by
resuming the state of its slot with the new digest and the siblings to the right of it; what lies
to the left is never hashed again. Above its chunk, all rows of a chunk have the same siblings:
those come down round by round as one row per chunk, and their states are made once for it.

Defined results: rows of equal order are told apart by their digest, rows equal in all columns are
leaves of their own; a null key or order comes first; an empty table has no leaves and gives no
rows. A lone node is its own root. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.joins import null_safe_join
from llm.common import streamed, table, written
from llm.places import positions

FAN = 8
#: Levels of a tree that one task hashes, and the nodes below them.
LEVELS = 3
CHUNK = FAN**LEVELS

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(column: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


class Levels:
    """The levels above some nodes of a tree, each parent with the states of its slots.

    ``whole`` says that the nodes are all that the tree has in this round: then levels are added
    until one node is left; else there are always three.
    """

    def __init__(self, nodes: list[bytes], whole: bool):
        self.states, self.rights, self.others = [], [], []
        while len(nodes) > 1 if whole else len(self.states) < LEVELS:
            nodes = self._parents(nodes)
        (self.top,) = nodes

    def _parents(self, nodes: list[bytes]) -> list[bytes]:
        states, rights, others, parents = [], [], [], []
        for low in range(0, len(nodes), FAN):
            run = nodes[low : low + FAN]
            state = hashlib.sha256()
            for slot, node in enumerate(run):
                states.append(state.copy())
                state.update(node)
                rights.append(b"".join(run[slot + 1 :]))
                others.append((b"".join(run[:slot]), rights[-1]))
            parents.append(state.hexdigest().encode())
        self.states.append(states)
        self.rights.append(rights)
        self.others.append(others)
        return parents

    def fold(self, place: int, node: bytes) -> bytes:
        """The top with ``node`` at ``place``."""
        for states, rights in zip(self.states, self.rights):
            node = resumed(states[place], node, rights[place])
            place //= FAN
        return node

    def siblings(self, place: int) -> list[tuple[bytes, bytes]]:
        """Left and right siblings of a node and of the nodes above it, level by level."""
        found = []
        for others in self.others:
            found.append(others[place])
            place //= FAN
        return found


def resumed(state, node: bytes, right: bytes) -> bytes:
    state = state.copy()
    state.update(node)
    state.update(right)
    return state.hexdigest().encode()


def chunk_tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``tree, n, chunk, digest`` of every chunk."""
    for batch in batches:
        columns = batch.to_pydict()
        digests = [
            Levels([d.encode() for d in nodes], n <= CHUNK).top.decode()
            for nodes, n in zip(columns["digests"], columns["n"])
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("tree"), batch.column("n"), batch.column("chunk"), pa.array(digests, pa.string())],
            names=["tree", "n", "chunk", "digest"],
        )


def grown(nodes: DataFrame, carried: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of all trees, and ``tree, digest`` of their roots.

    ``nodes`` has ``tree, n, position, digest``, n being the nodes of its tree. A round has a row
    per chunk: ``tree, n, chunk, digests`` and, in the first, an array of each carried column.
    """
    rounds, roots = [], []
    while True:
        member = F.struct("position", "digest", *carried)
        chunk = F.expr(f"position div {CHUNK}").alias("chunk")
        grouped = nodes.groupBy("tree", "n", chunk).agg(F.sort_array(F.collect_list(member)).alias("members"))
        arrays = {"digest": "digests", **{c: c for c in carried}}
        taken = [F.col(f"members.{c}").alias(name) for c, name in arrays.items()]
        chunks = written(grouped.select("tree", "n", "chunk", *taken), "merkle_chunks")
        rounds.append(chunks)
        layout = "tree long, n long, chunk long, digest string"
        tops = written(streamed(chunks.select("tree", "n", "chunk", "digests"), chunk_tops, layout), "merkle_tops")
        roots.append(tops.filter(f"n <= {CHUNK}").select("tree", "digest"))
        nodes, carried = tops.filter(f"n > {CHUNK}").select(
            "tree", F.expr(f"(n + {CHUNK - 1}) div {CHUNK}").alias("n"), F.col("chunk").alias("position"), "digest"
        ), ()
        if nodes.isEmpty():
            break
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return rounds, found


PATH = "lefts array<string>, rights array<string>"


def node_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The siblings on the way from each node of a chunk to the root."""
    for batch in batches:
        out = {"tree": [], "chunk": [], "lefts": [], "rights": []}
        for row in batch.to_pylist():
            levels = Levels([d.encode() for d in row["digests"]], row["n"] <= CHUNK)
            for place in range(len(row["digests"])):
                own = levels.siblings(place)
                out["tree"].append(row["tree"])
                out["chunk"].append(row["chunk"] * CHUNK + place)
                out["lefts"].append([left.decode() for left, _ in own] + row["lefts"])
                out["rights"].append([right.decode() for _, right in own] + row["rights"])
        text = pa.list_(pa.string())
        types = {"tree": pa.int64(), "chunk": pa.int64(), "lefts": text, "rights": text}
        yield pa.RecordBatch.from_pydict({k: pa.array(v, types[k]) for k, v in out.items()})


def above(rounds: list[DataFrame], roots: DataFrame) -> DataFrame:
    """``tree, chunk, lefts, rights``: siblings on the way from the top of each chunk of the first
    round to the root. ``roots`` has ``tree, lefts, rights``, the way on from each tree's root."""
    below = None
    for r in reversed(range(len(rounds))):
        ending = rounds[r].filter(f"n <= {CHUNK}").select("tree", F.lit(0).cast("long").alias("chunk"))
        paths = ending.join(roots, "tree").select("tree", "chunk", "lefts", "rights")
        if below is not None:
            paths = paths.unionByName(below)
        if r:
            below = node_paths_of(rounds[r], paths)
    return paths


def node_paths_of(chunks: DataFrame, paths: DataFrame) -> DataFrame:
    joined = chunks.select("tree", "n", "chunk", "digests").join(paths, ["tree", "chunk"])
    return written(streamed(joined, node_paths, f"tree long, chunk long, {PATH}"), "merkle_paths")


def folded(schema: pa.Schema):
    """Rows of chunks with their siblings above, one row for each leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                leaves = [d.encode() for d in row["digests"]]
                levels = Levels(leaves, row["n"] <= CHUNK)
                way = []
                for left, right in zip(row["lefts"], row["rights"]):
                    state = hashlib.sha256(left.encode())
                    way.append((state, right.encode()))
                over = b"".join((left + right).encode() for left, right in zip(row["lefts"], row["rights"]))
                proofs, tops = [], []
                for place, (leaf, changed) in enumerate(zip(leaves, row["changed"])):
                    node = levels.fold(place, leaf if changed is None else changed.encode())
                    for state, right in way:
                        node = resumed(state, node, right)
                    tops.append(node.decode())
                    proof = hashlib.sha256(b"".join(left + right for left, right in levels.siblings(place)))
                    proof.update(over)
                    proofs.append(proof.hexdigest())
                n = len(leaves)
                values = [row["id"], row["digests"], [row["subroot"]] * n, [row["root"]] * n, proofs, tops]
                arrays = [pa.array(v, f.type) for v, f in zip(values, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def manifest(leaves: DataFrame) -> DataFrame:
    """One row per leaf: ``id, leaf, subroot, root, proof_sha256, folded_root``.

    ``leaves`` has ``id, key, leaf, changed``: a tree for each key, in it the leaves by id, and over
    the trees' roots, by key, one tree more. ``changed`` is the digest a leaf is folded with, null
    for its own. The proof is the hash of all siblings from the leaf to the root.
    """
    placed = positions(
        leaves.select("id", "key", "leaf", "changed"), ["key"],
        [F.col("key").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf")], "merkle_leaves",
    )
    keys = placed.groupBy("key").agg(F.count("*").alias("n"))
    trees = written(
        positions(keys, [], [F.col("key").asc_nulls_first()], "merkle_keys").withColumnRenamed("position", "tree"),
        "merkle_trees",
    )
    nodes = null_safe_join(placed, trees, ["key"]).select(
        "tree", "n", "position", F.col("leaf").alias("digest"), "id", "changed"
    )
    rounds, subroots = grown(nodes, ("id", "changed"))

    n = trees.agg(F.count("*").alias("n")).scalar()
    top_nodes = subroots.select(F.lit(0).cast("long").alias("tree"), n.alias("n"), F.col("tree").alias("position"), "digest")
    top_rounds, root = grown(top_nodes)
    none = F.array().cast("array<string>")
    ends = root.select("tree", none.alias("lefts"), none.alias("rights"))
    ways = node_paths_of(top_rounds[0], above(top_rounds, ends)).select(F.col("chunk").alias("tree"), "lefts", "rights")

    chunks = rounds[0].join(above(rounds, ways), ["tree", "chunk"]).join(
        subroots.withColumnRenamed("digest", "subroot"), "tree"
    )
    chunks = chunks.withColumn("root", root.select("digest").scalar())
    id_type = leaves.schema["id"].dataType.simpleString()
    layout = f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return streamed(chunks, folded(_arrow(layout)), layout)


def _arrow(layout: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(layout))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, a tree per language; of every third id the text is folded in
    lower case."""
    documents = table(spark, sf_dir, "documents")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", UPPER, UPPER.lower())
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = documents.select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("key"),
        leaf_digest(*columns, F.col("text")).alias("leaf"),
        F.when(tampered, leaf_digest(*columns, lowered)).alias("changed"),
    )
    return manifest(leaves).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: Levels of the twin; 8 to this power is the largest tree it hashes.
_SQL_LEVELS, _SQL_TOP_LEVELS = 10, 3


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a text of ASCII characters, a bit at a time."""
    step = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, _z: " + step.format("v") + ")"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {bits}), 4294967295)"


def _sql_levels(name: str, by: str, levels: int) -> str:
    """CTEs ``name0 .. name{levels}`` of (by, pos, n, h), and ``name_run{i}`` with each run's digests."""
    parts = []
    for i in range(levels):
        parts.append(
            f"{name}_run{i} AS (SELECT {by}, pos // 8 AS pos, max(n) AS n, list(h ORDER BY pos) AS hs FROM {name}{i} GROUP BY {by}, pos // 8)"
        )
        parts.append(
            f"{name}{i + 1} AS (SELECT {by}, pos, (n + 7) // 8 AS n, CASE WHEN n = 1 THEN hs[1] ELSE sha256(list_aggregate(hs, 'string_agg', '')) END AS h FROM {name}_run{i})"
        )
    return ", ".join(parts)


def _sql_folds(name: str, by: str, levels: int, before: str, last: str) -> str:
    """Folded digests and texts of siblings, a CTE for each level; ``before`` has (by, pos, f, p)."""
    parts = []
    left = "coalesce(list_aggregate(r.hs[1:x.pos % 8], 'string_agg', ''), '')"
    right = "coalesce(list_aggregate(r.hs[x.pos % 8 + 2:], 'string_agg', ''), '')"
    for i in range(levels):
        after = last if i == levels - 1 else f"{name}_fold{i + 1}"
        parts.append(
            f"{after} AS (SELECT x.* REPLACE (x.pos // 8 AS pos, CASE WHEN r.n = 1 THEN f ELSE sha256({left} || f || {right}) END AS f, "
            f"CASE WHEN r.n = 1 THEN p ELSE p || {left} || {right} END AS p) "
            f"FROM {before} x JOIN {name}_run{i} r ON r.{by} = x.{by} AND r.pos = x.pos // 8)"
        )
        before = after
    return ", ".join(parts)


def _sql_field(x: str) -> str:
    return f"coalesce(CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


SQL = f"""
WITH leaves AS (
  SELECT doc_id, lang, {_sql_leaf('text')} AS leaf,
         CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} ELSE {_sql_leaf('text')} END AS f
  FROM documents),
placed AS (
  SELECT doc_id, leaf, f, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
t0 AS (SELECT tree, pos, n, leaf AS h FROM placed),
{_sql_levels('t', 'tree', _SQL_LEVELS)},
s0 AS (SELECT 0 AS one, tree AS pos, count(*) OVER () AS n, h FROM t{_SQL_LEVELS}),
{_sql_levels('s', 'one', _SQL_TOP_LEVELS)},
x0 AS (SELECT doc_id, leaf, tree, pos, f, '' AS p FROM placed),
{_sql_folds('t', 'tree', _SQL_LEVELS, 'x0', 'x1')},
y0 AS (SELECT doc_id, leaf, x1.tree, 0 AS one, x1.tree AS pos, f, p FROM x1),
{_sql_folds('s', 'one', _SQL_TOP_LEVELS, 'y0', 'y1')}
SELECT doc_id, leaf, s0.h AS subroot, s.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = s.h AS verified
FROM y1 JOIN s0 ON s0.pos = y1.tree JOIN s{_SQL_TOP_LEVELS} s ON true
"""
