"""The prefix trie of conversations, found by digests of blocks of turns.

A node is a distinct sequence of first turns; its members are the conversations that begin with it.

1. Turns are cut into blocks of ``BLOCK``. Each block has a digest of its turns and its number; the
   digests up to a block, added up, name the sequence up to there, and conversations are grouped by
   that name at all block ends at once.
2. Between two block ends a group either stays together: then its turns are nodes of the whole
   group, taken from one member. Or it is one conversation: its turns are nodes of its own. Or it
   parts: only there the turns of the block are compared one by one.
3. A node is named by its smallest member and its depth. A conversation is the smallest member from
   some depth on to its end, so what the nodes of a subtree add up to is the sum over the node's
   members of what each one's own nodes add up to, less the smallest member's own nodes above.
   Members are added up as they were counted, without a step per level of the trie.

A conversation of any length is spread: its turns by ranges, its blocks by spans of ``SPAN`` blocks
whose sums are joined back. Groups of any size are counted with partial aggregation.

Sums of four 32 bit parts of SHA-256 digests name a sequence: two different sequences share a name
with odds of 2**-128.

Defined results: turns without a conversation id belong to none and are left out. Turns of equal
number are in the order of the digest of role and text; repeated rows are turns of their own. A null
number comes first, a null role or text is empty. A conversation without turns is a member of the
root alone. Without conversations there is no root. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import streamed, table, written
from llm.merkle import crc32_sql
from llm.places import positions

#: Turns of a block.
BLOCK = 8
#: Consecutive blocks (or nodes) of a conversation which one task adds up.
SPAN = 4096
#: Characters of joined ids which a row holds.
TEXT = 1 << 16

#: The query rebuilds conversations: the base is the one at the hundred, of which 0 to 5 turns are taken.
HUNDRED, HEADS = 100, 6

_LANES = ("lane0", "lane1", "lane2", "lane3")


class Trie(NamedTuple):
    """``nodes``: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens. ``ends``: conv_id, and node and depth of the node at which it ends."""

    nodes: DataFrame
    ends: DataFrame


def ordered(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, digest, size``: the turns of each conversation from 0 on."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", digest.alias("digest"), F.char_length(text).cast("long").alias("size")
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    return positions(turns, ["conv_id"], order, "turns").drop("turn")


def with_lengths(turns: DataFrame) -> DataFrame:
    """Turns of conversations as they are, ready for ``trie``."""
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    return turns.join(lengths, "conv_id")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the base of their hundred.

    Returns turns with ``n_turns``, and ``conv_id, n_turns`` of every conversation.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    turn = F.struct("position", "digest", "size")
    heads = (
        turns.filter(F.col("position") < HEADS - 1)
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(turn)).alias("head"))
    )
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    shape = own.withColumns({"h": taken, "base": F.col("conv_id") - F.col("conv_id") % HUNDRED}).join(heads, "base", "left")
    head = F.coalesce(F.slice("head", 1, F.col("h").cast("int")), F.slice(F.array(turn_of_nothing()), 1, 0))
    shape = shape.select("conv_id", "n", "h", head.alias("head")).withColumn("m", F.size("head").cast("long"))
    n_turns = F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    shape = written(shape.select("conv_id", "h", "m", "head", n_turns.alias("n_turns")), "heads")
    first = shape.select("conv_id", "n_turns", F.inline("head"))
    rest = (
        turns.join(shape.select("conv_id", "h", "m", "n_turns"), "conv_id")
        .filter(F.col("position") >= F.col("h"))
        .withColumn("position", F.col("position") - F.col("h") + F.col("m"))
    )
    columns = ["conv_id", "n_turns", "position", "digest", "size"]
    return first.select(columns).unionByName(rest.select(columns)), shape.select("conv_id", "n_turns")


def turn_of_nothing() -> Column:
    return F.struct(
        F.lit(0).cast("long").alias("position"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("size")
    )


def running(df: DataFrame, key: str, index: str, values: Sequence[str]) -> DataFrame:
    """``df`` with the sums of ``values`` before each row, by an index which is dense from 0 on.

    Spans of the index are added up apart, and the sums of whole spans before are joined back.
    """
    spanned = df.withColumn("__span", F.expr(f"{index} div {SPAN}"))
    spans = spanned.groupBy(key, "__span").agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(key).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(key, "__span", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"__{v}") for v in values])
    inside = Window.partitionBy(key, "__span").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    summed = spanned.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    joined = summed.join(offsets, [key, "__span"])
    return joined.withColumns({f"{v}_before": F.col(f"{v}_before") + F.col(f"__{v}") for v in values}).drop(
        "__span", *[f"__{v}" for v in values]
    )


def blocks_of(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, k, turns, before, after``: blocks with the names of the sequences up to
    them and through them."""
    grouped = turns.groupBy("conv_id", "n_turns", F.expr(f"position div {BLOCK}").alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("position", "digest", "size"))).alias("turns")
    )
    digest = F.sha2(F.concat_ws(":", F.col("k").cast("string"), F.transform("turns", lambda t: F.hex(t["digest"]))), 256)
    lanes = {lane: F.conv(F.substring("__digest", 1 + 8 * i, 8), 16, 10).cast("long") for i, lane in enumerate(_LANES)}
    summed = running(grouped.withColumn("__digest", digest).withColumns(lanes).drop("__digest"), "conv_id", "k", _LANES)
    return summed.select(
        "conv_id", "n_turns", "k", "turns",
        F.concat_ws(".", F.col("k"), *[F.col(f"{lane}_before") for lane in _LANES]).alias("before"),
        F.concat_ws(".", F.col("k") + 1, *[F.col(lane) + F.col(f"{lane}_before") for lane in _LANES]).alias("after"),
    )


_ROOT = ".".join(["0"] * (1 + len(_LANES)))


def grouped_blocks(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Blocks with size and smallest member of the groups they come from and lead to; a group of
    one conversation is null."""
    blocks = written(blocks_of(turns), "turn_blocks")
    group = [F.count("*").alias("n"), F.min("conv_id").alias("smallest")]
    root = conversations.agg(*group).select(F.lit(_ROOT).alias("name"), "n", "smallest")
    groups = blocks.groupBy(F.col("after").alias("name")).agg(*group).unionByName(root).filter("n > 1")
    groups = written(groups, "turn_groups")
    parent = groups.select(F.col("name").alias("before"), F.col("n").alias("n_from"), F.col("smallest").alias("from"))
    child = groups.select(F.col("name").alias("after"), F.col("n").alias("n_to"), F.col("smallest").alias("to"))
    return written(blocks.join(parent, "before", "left").join(child, "after", "left").drop("after"), "turn_members")


def turn_rows(blocks: DataFrame, *columns: str) -> DataFrame:
    """A row per turn of the blocks: ``t``, 1 for a block's first, and its size."""
    return blocks.select(*columns, "k", F.posexplode("turns").alias("__t", "turn")).select(
        *columns, "k", (F.col("__t") + 1).alias("t"), F.col("turn.size").alias("size")
    )


def compared(parting: DataFrame, *columns: str) -> DataFrame:
    """A row per turn of blocks in which groups part, with the digests of the block's turns up to
    it (``here``) and up to the one before."""
    digests = F.transform("turns", lambda t: F.hex(t["digest"]))
    here = F.transform(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: F.unhex(F.sha2(F.concat_ws("", F.slice(digests, 1, i)), 256)),
    )
    named = parting.withColumn("__here", here)
    rows = named.select("before", "k", *columns, "turns", "__here", F.posexplode("turns").alias("__t", "turn"))
    return rows.select(
        "before", "k", *columns, (F.col("__t") + 1).alias("t"), F.col("turn.size").alias("size"),
        F.col("__here")[F.col("__t")].alias("here"), F.when(F.col("__t") > 0, F.get("__here", F.col("__t") - 1)).alias("last"),
    )


def depth_of() -> Column:
    return F.col("k") * BLOCK + F.col("t")


def trie(turns: DataFrame, conversations: DataFrame) -> Trie:
    """The trie of ``conversations`` (conv_id, n_turns) with the given ``turns`` (conv_id, n_turns,
    position, digest, size)."""
    conversations = written(conversations, "conversations")
    members = grouped_blocks(turns, conversations)
    alone = members.filter("n_from IS NULL")
    straight = members.filter("n_from = n_to")
    parting = members.filter("n_from IS NOT NULL AND (n_to IS NULL OR n_to < n_from)")

    node = ["before", "k", "t", "last", "here"]
    parted = written(
        compared(parting, "conv_id", "n_turns", "from").groupBy(*node).agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("size").alias("size"),
            F.max("from").alias("from"), F.max("n_turns").alias("n_turns"),
        ),
        "parted_nodes",
    )
    above = parted.select("before", "k", (F.col("t") + 1).alias("t"), F.col("here").alias("last"), F.col("conv_id").alias("__above"))
    parted = parted.join(above, ["before", "k", "t", "last"], "left").withColumn("parent", F.coalesce("__above", "from"))
    kept = straight.filter(F.col("conv_id") == F.col("to"))
    together = turn_rows(kept.withColumnRenamed("n_to", "n_convs"), "conv_id", "n_convs")
    columns = ["conv_id", "k", F.col("t").alias("part"), depth_of().alias("depth"), "n_convs", "size", "parent"]
    found = written(
        parted.select(*columns, "n_turns").unionByName(
            together.withColumn("parent", F.col("conv_id")).select(*columns, F.lit(None).cast("long").alias("n_turns")).withColumn("part", F.lit(0))
        ),
        "trie_nodes",
    )
    shared = found.filter("n_convs > 1")
    children = written(
        found.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children")),
        "trie_children",
    )

    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    last = F.col("k") * BLOCK + F.size("turns") == F.col("n_turns")
    same = straight.filter(last).select("conv_id", F.col("to").alias("node"), F.col("n_turns").alias("depth"))
    stops = compared(parting.filter(last), "conv_id", "n_turns").filter(depth_of() == F.col("n_turns"))
    at = parted.filter("n_convs > 1").select(*node[:3], "here", F.col("conv_id").alias("node"))
    apart = stops.drop("last").join(at, [*node[:3], "here"]).select("conv_id", "node", F.col("n_turns").alias("depth"))
    turnless = conversations.filter("n_turns = 0").select(
        "conv_id", root.select("conv_id").scalar().alias("node"), F.lit(0).cast("long").alias("depth")
    )
    with_others = reduce(DataFrame.unionByName, [same, apart, turnless])
    ends = written(
        conversations.join(with_others, "conv_id", "left").select(
            "conv_id", F.coalesce("node", "conv_id").alias("node"), F.coalesce("depth", "n_turns").alias("depth"),
            F.col("node").isNotNull().alias("shared"),
        ),
        "trie_ends",
    )

    # What each conversation adds to the nodes it is a member of: a leaf, and its own nodes' savings.
    saved = ((F.col("n_convs") - 1) * F.col("size")).alias("saved")
    nothing = F.lit(0).cast("long")
    leaves = ends.select(F.col("node").alias("conv_id"), "depth").distinct().join(children, ["conv_id", "depth"], "left_anti")
    # A lone conversation's last node is a leaf though it is not among the nodes found to be shared or parted.
    leaf_rows = ends.filter("NOT shared").select("conv_id").unionByName(
        leaves.join(ends.filter("shared").select(F.col("node").alias("conv_id"), "depth").distinct(), ["conv_id", "depth"]).select("conv_id")
    )
    weights = written(
        leaf_rows.select("conv_id", F.lit(1).cast("long").alias("leaves"), nothing.alias("saved"))
        .unionByName(shared.select("conv_id", nothing.alias("leaves"), saved))
        .groupBy("conv_id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")),
        "trie_weights",
    )
    sums = [F.sum(F.coalesce(c, nothing)).alias(f"all_{c}") for c in ("leaves", "saved")]
    weighed = members.filter("n_from IS NOT NULL").join(weights, "conv_id", "left")
    in_straight = weighed.filter("n_from = n_to").groupBy(F.col("to").alias("conv_id"), "k").agg(*sums).withColumn("part", F.lit(0))
    in_parted = (
        compared(weighed.filter("n_to IS NULL OR n_to < n_from"), "conv_id", "leaves", "saved")
        .groupBy(*node).agg(*sums, F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).filter("n > 1")
        .select("conv_id", "k", "all_leaves", "all_saved", F.col("t").alias("part"))
    )
    totals = in_straight.unionByName(in_parted)
    # The smallest member's own nodes above are not in the subtree; its shared nodes have dense depths.
    starts = shared.groupBy("conv_id").agg(F.min("depth").alias("__from"))
    indexed = shared.withColumn("saved", saved).join(starts, "conv_id").withColumn("__i", F.col("depth") - F.col("__from"))
    own = running(indexed, "conv_id", "__i", ["saved"])
    many = (
        own.join(totals, ["conv_id", "k", "part"])
        .join(children, ["conv_id", "depth"], "left")
        .select(
            "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", nothing).alias("n_children"),
            F.col("all_leaves").alias("n_leaves"), (F.col("all_saved") - F.col("saved_before")).alias("saved_tokens"),
        )
    )
    goes_on = (F.col("depth") < F.col("n_turns")).cast("long")
    single = turn_rows(alone, "conv_id", "n_turns").withColumns({"depth": depth_of(), "parent": F.col("conv_id")})
    single = single.select("conv_id", "depth", "parent", "n_turns").unionByName(
        found.filter("n_convs = 1").select("conv_id", "depth", "parent", "n_turns")
    )
    one = F.lit(1).cast("long")
    few = single.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), one.alias("n_convs"), goes_on.alias("n_children"),
        one.alias("n_leaves"), nothing.alias("saved_tokens"),
    )
    at_root = children.filter("depth = 0").agg(F.coalesce(F.sum("n_children"), nothing)).scalar()
    alone_goes_on = conversations.agg(F.max((F.col("n_turns") > 0).cast("long"))).scalar()
    top = root.select(
        "conv_id", nothing.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.when(F.col("n_convs") == 1, alone_goes_on).otherwise(at_root).alias("n_children"),
        weights.agg(F.coalesce(F.sum("leaves"), nothing)).scalar().alias("n_leaves"),
        weights.agg(F.coalesce(F.sum("saved"), nothing)).scalar().alias("saved_tokens"),
    )
    return Trie(reduce(DataFrame.unionByName, [top, few, many]), ends.drop("shared"))


def joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node, which come in order, joined to texts of bounded length."""
    node, first, ids, size = None, None, [], 0
    out: list[tuple] = []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(3)]
        for key in zip(*columns):
            if node != key[:2] or size > TEXT:
                if ids:
                    out.append((*node, first, ",".join(ids)))
                node, first, ids, size = key[:2], key[2], [], 0
            ids.append(str(key[2]))
            size += len(ids[-1]) + 1
        yield _rows(out, ("node", "depth", "first", "text"))
        out = []
    if ids:
        yield _rows([(*node, first, ",".join(ids))], ("node", "depth", "first", "text"))


def digests_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's texts, which come in order; a text is all that is held."""
    node, state = None, None
    out: list[tuple] = []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in (0, 1, 3)]
        for *key, text in zip(*columns):
            if key == node:
                state.update(b"," + text.encode())
                continue
            if node is not None:
                out.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(text.encode())
        yield _rows(out, ("conv_id", "depth", "ends_sha256"))
        out = []
    if node is not None:
        yield _rows([(*node, state.hexdigest())], ("conv_id", "depth", "ends_sha256"))


def _rows(rows: list[tuple], names: Sequence[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    types = [pa.string() if n in ("text", "ends_sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))


def end_digests(ends: DataFrame) -> DataFrame:
    """``conv_id, depth, ends_sha256`` of nodes at which conversations end.

    A hash of a joined text can only be taken in order, so all texts of a node pass through one
    task, as a stream; the ids are joined before, by ranges.
    """
    ranged = ends.select("node", "depth", "conv_id").repartitionByRange("node", "depth", "conv_id")
    texts = streamed(
        ranged.sortWithinPartitions("node", "depth", "conv_id"), joined_ids, "node long, depth long, first long, text string"
    )
    by_node = texts.repartition("node", "depth").sortWithinPartitions("node", "depth", "first")
    return streamed(by_node, digests_of_ids, "conv_id long, depth long, ends_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of all conversations, rebuilt on the first turns of their base."""
    found = trie(*rebuilt(ordered(table(spark, sf_dir, "conversations"))))
    none = hashlib.sha256(b"").hexdigest()
    return found.nodes.join(end_digests(found.ends), ["conv_id", "depth"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(none))
    )


SQL = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) - 1 AS i, d, size
  FROM (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
               length(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, count(*) AS n, {crc32_sql('CAST(conv_id AS VARCHAR)')} % {HEADS} AS h, conv_id - conv_id % {HUNDRED} AS base
      FROM t GROUP BY conv_id),
s AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS m FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (SELECT s.conv_id, t.i AS pos, d, size FROM s JOIN t ON t.conv_id = s.base AND t.i < s.h
      UNION ALL SELECT s.conv_id, t.i - s.h + s.m, d, size FROM s JOIN t ON t.conv_id = s.conv_id AND t.i >= s.h),
p AS (SELECT conv_id, pos + 1 AS depth, size, sha256(string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS k FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM s),
l AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
v AS (SELECT p.depth, k, min(p.conv_id) AS conv_id, count(*) AS n, min(size) AS size,
             coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (l.depth = p.depth), '') AS ends
      FROM p JOIN l USING (conv_id) GROUP BY p.depth, k),
e AS (SELECT v.*, u.conv_id AS parent FROM v LEFT JOIN p ON p.conv_id = v.conv_id AND p.depth = v.depth - 1
      LEFT JOIN v u ON u.depth = p.depth AND u.k = p.k),
n AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM e WHERE parent IS NOT NULL GROUP BY ALL),
f AS (SELECT e.*, coalesce(n_children, 0) AS n_children FROM e LEFT JOIN n ON n.parent = e.conv_id AND n.depth = e.depth),
a AS (SELECT p.depth, p.k, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n - 1) * f.size) AS saved
      FROM f JOIN p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.depth, p.k)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, f.parent AS parent_conv_id, f.n AS n_convs, f.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM f JOIN a ON a.depth = f.depth AND a.k = f.k
"""
