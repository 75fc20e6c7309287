"""The Merkle manifest against trees built whole in memory."""

from __future__ import annotations

import hashlib
import random
import zlib

import brute
from pyspark.sql import functions as F

from llm import merkle


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def way(levels, place: int):
    """Left and right siblings, level by level."""
    for level in levels[:-1]:
        low = place // 8 * 8
        yield "".join(level[low:place]), "".join(level[place + 1 : low + 8])
        place //= 8


def expected(rows) -> list:
    """Rows of (doc_id, text, lang, source, n_chars)."""
    def leaf(row, text):
        return H(*[field(v) for v in (row[0], row[3], row[2], row[4], text)])

    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    built, out = {}, []
    for key in order:
        trees[key].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        built[key] = levels_of([leaf(r, r[1]) for r in trees[key]])
    top = levels_of([built[key][-1][0] for key in order])
    for number, key in enumerate(order):
        for place, row in enumerate(trees[key]):
            siblings = [*way(built[key], place), *way(top, number)]
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = brute.lowered(text.encode()).decode()
            node = leaf(row, text)
            for left, right in siblings:
                node = H(left, node, right)
            proof = H(*[left + right for left, right in siblings])
            root = top[-1][0]
            out.append((row[0], leaf(row, row[1]), built[key][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def found(df) -> list:
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def run(spark, tmp_path, df) -> list:
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return found(merkle.query(spark, str(tmp_path)))


def test_trees_of_many_sizes_with_nulls_ties_and_repeated_rows(spark, documents, tmp_path):
    draw = random.Random(2)
    sizes = {"a": 1, "b": 8, "c": 9, "d": 65, None: 3, "": 2, "é": 513, "z": 1100}
    rows = [
        (draw.randrange(10**6) if draw.random() > 0.01 else None, draw.choice(["Ab", "ab", None, "", "Ünd X"]), lang,
         draw.choice(["s", None]), draw.choice([None, 0, 7]))
        for lang, n in sizes.items() for _ in range(n)
    ]
    rows += [(5, "T", "z", None, 1), (5, "T", "z", None, 1), (5, "U", "z", None, 1)]
    assert run(spark, tmp_path, documents(rows)) == expected(rows)


def test_one_leaf_is_the_root(spark, documents, tmp_path):
    rows = [(3, "x" * 300_000, None, None, None)]
    assert run(spark, tmp_path, documents(rows)) == expected(rows)


def test_more_keys_than_a_chunk(spark, documents, tmp_path):
    rows = [(i, "T", f"k{i % 700}", None, None) for i in range(900)]
    assert run(spark, tmp_path, documents(rows)) == expected(rows)


def test_empty_table_and_clashing_columns(spark, documents, tmp_path):
    assert run(spark, tmp_path / "none", documents([])) == []
    rows = [(1, "A", "x", "s", 2), (2, "b", "x", "s", 2)]
    df = documents(rows)
    for name in ("id", "key", "leaf", "changed", "position", "tree", "n", "digest", "root", "__tie", "__place"):
        df = df.withColumn(name, F.lit("mine"))
    assert run(spark, tmp_path / "names", df) == expected(rows)


def test_a_tree_of_three_rounds(spark):
    n = 8**6 + 17
    nodes = spark.range(n).select(
        F.lit(0).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"), F.col("id").alias("position"),
        F.sha2(F.col("id").cast("string"), 256).alias("digest"),
    )
    rounds, roots = merkle.grown(nodes)
    assert len(rounds) == 3
    assert [r.digest for r in roots.collect()] == levels_of([H(str(i)) for i in range(n)])[-1]


def test_folding_resumes_the_state_of_the_slot():
    nodes = [H(str(i)).encode() for i in range(20)]
    levels = merkle.Levels(nodes, whole=True)
    assert levels.top.decode() == levels_of([n.decode() for n in nodes])[-1][0]
    for place in range(20):
        changed = [*nodes]
        changed[place] = H("other").encode()
        assert levels.fold(place, changed[place]) == merkle.Levels(changed, whole=True).top
        assert levels.fold(place, nodes[place]) == levels.top
        left = b"".join(nodes[place // 8 * 8 : place])
        assert levels.states[0][place].hexdigest() == hashlib.sha256(left).hexdigest()
