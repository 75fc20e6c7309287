"""The prefix trie against one built turn by turn in memory."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm import prefix_trie

TURN = "conv_id long, turn long, role string, text string"


def digest(role, text) -> str:
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def rebuilt(rows) -> dict[int, list]:
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0, digest(role, text)), (role or "", text or "")))
    own = {conv: [t for _, t in sorted(found)] for conv, found in turns.items()}
    out = {}
    for conv, mine in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = int(conv - (abs(conv) % 100) * (1 if conv >= 0 else -1))
        out[conv] = own.get(base, [])[:h] + mine[h:]
    return out


def nodes_of(conversations: dict[int, list]) -> list[tuple]:
    members = defaultdict(list)
    for conv in sorted(conversations):
        for depth in range(len(conversations[conv]) + 1):
            members[tuple(conversations[conv][:depth])].append(conv)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children[prefix]
        leaves[prefix] = sum(leaves[b] for b in below) if below else 1
        own = (len(members[prefix]) - 1) * (len(prefix[-1][1]) if prefix else 0)
        saved[prefix] = own + sum(saved[b] for b in below)
    out = []
    for prefix, found in members.items():
        ends = ",".join(str(c) for c in found if len(conversations[c]) == len(prefix))
        parent = members[prefix[:-1]][0] if prefix else None
        out.append((
            found[0], len(prefix), parent, len(found), len(children[prefix]), leaves[prefix], saved[prefix],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def found(spark, tmp_path, df) -> list:
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted((tuple(r[n] for n in NAMES) for r in prefix_trie.query(spark, str(tmp_path)).collect()), key=str)


def check(spark, tmp_path, rows) -> None:
    df = spark.createDataFrame(rows, TURN).repartition(3)
    assert found(spark, tmp_path, df) == nodes_of(rebuilt(rows))


def conversation(draw, conv, n, words=2):
    return [(conv, i, draw.choice(["user", "tool"]), draw.choice("ab"[:words])) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations_that_share_much(spark, tmp_path, seed):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-150, 460), 160):
        rows += conversation(draw, conv, draw.choice([1, 2, 3, 5, 8, 9, 16, 17, 40]), words=draw.choice([1, 2]))
    check(spark, tmp_path, rows)


def test_copies_prefixes_and_partings_at_and_inside_blocks(spark, tmp_path):
    long = [("user", f"t{i}" * (i % 3)) for i in range(40)]
    rows = []
    for conv in range(1000, 1400, 100):  # their own bases
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(long)]
    for k, n in enumerate([7, 8, 9, 15, 16, 17, 24, 39]):
        rows += [(2000 + 100 * k, i, r, t) for i, (r, t) in enumerate(long[:n])]
        rows += [(5000 + 100 * k, i, r, t) for i, (r, t) in enumerate([*long[:n], ("user", "other"), *long])]
    check(spark, tmp_path, rows)


def test_nulls_ties_and_repeated_turns(spark, tmp_path):
    rows = [
        (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", "b"), (1, 0, "user", "b"), (2, 0, "user", None),
        (3, 5, None, "ü漢😀"), (None, 0, "user", "x"), (101, 0, "user", "a"), (100, 0, "user", "a"), (100, None, "", "\n"),
        *[(c, i, "user", "x" * 50_000) for c in (200, 201, 300) for i in range(3)],
    ]
    check(spark, tmp_path, rows)


def test_turnless_conversations(spark, tmp_path):
    # Fewer turns than are taken of a base which is not there.
    convs = [c for c in range(1001, 1100) if zlib.crc32(str(c).encode()) % 6 >= 2][:20]
    check(spark, tmp_path, [(c, 0, "user", "a") for c in convs])


def test_one_conversation(spark, tmp_path):
    check(spark, tmp_path, [(700, i, "user", f"t{i}") for i in range(11)])


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert found(spark, tmp_path / "none", spark.createDataFrame([], TURN)) == []
    rows = [(c, i, "user", f"t{i}") for c in (100, 101, 102) for i in range(9)]
    df = spark.createDataFrame(rows, TURN)
    for name in ("position", "digest", "size", "k", "t", "n", "h", "base", "head", "node", "__tie", "__place", "n_turns"):
        df = df.withColumn(name, F.lit("mine"))
    assert found(spark, tmp_path / "names", df) == nodes_of(rebuilt(rows))


def test_long_conversations_over_several_spans(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPAN", 3)
    turns = [(c, i, f"t{i}" if i != c else "other") for c in (60, 130, 170) for i in range(200)]
    rows = [(c, i, "user", t) for c, i, t in turns]
    ordered = prefix_trie.with_lengths(prefix_trie.ordered(spark.createDataFrame(rows, TURN)))
    found = prefix_trie.trie(ordered, ordered.select("conv_id", "n_turns").distinct())
    got = sorted((tuple(r[n] for n in NAMES[:-1]) for r in found.nodes.collect()), key=str)
    whole = {c: [("user", t) for cc, _, t in turns if cc == c] for c in (60, 130, 170)}
    assert got == sorted((row[:-1] for row in nodes_of(whole)), key=str)
    assert {(r.conv_id, r.depth) for r in found.ends.collect()} == {(60, 200), (130, 200), (170, 200)}


def test_many_conversations_ending_at_one_node(spark):
    ends = spark.range(30_000).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("node"), F.lit(2).cast("long").alias("depth"))
    (row,) = prefix_trie.end_digests(ends).collect()
    assert tuple(row) == (0, 2, hashlib.sha256(",".join(map(str, range(30_000))).encode()).hexdigest())
