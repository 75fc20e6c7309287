"""Near-duplicates by min-max hashing, and connected components."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import ODD, groups, prose, shingles, similar_groups

from llm import minhash
from llm.components import components, forest
from llm.passages import keyed


def edited(text: str, seed: int, edits: int) -> str:
    draw = random.Random(seed)
    found = text.split()
    for _ in range(edits):
        found[draw.randrange(len(found))] = f"w{draw.randrange(10**6)}"
    return " ".join(found)


def near_copies(seed: int, n: int) -> list[str]:
    base = prose(seed, 120)
    return [edited(base, seed * 1000 + i, i % 9) for i in range(n)]


@pytest.mark.parametrize("members", [512, 7])
def test_against_brute_force(documents, monkeypatch, members):
    monkeypatch.setattr(minhash, "MEMBERS", members)
    texts = near_copies(1, 60) + near_copies(2, 20) + [prose(i, 50) for i in range(10, 30)] + ODD + ODD[3:5] + [prose(1, 120).upper()]
    rows = list(zip(random.Random(3).sample(range(500), len(texts)), texts))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.verdicts(keyed(documents(rows))).collect()}
    assert found == similar_groups(dict(rows))


def test_links_in_a_chain_reach_the_smallest(documents):
    """Each text is similar to the next one only, so no centre is linked with all of them."""
    found = prose(9, 400).split()
    rows = [(i, " ".join(found[12 * i : 12 * i + 120])) for i in range(20)]
    expected = similar_groups(dict(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.verdicts(keyed(documents(rows))).collect()}
    assert got == expected and {c for _, c in expected.values()} == {0}


def test_threshold_is_exact():
    inter, a, b = np.array([6, 6, 75, 74]), np.array([7, 7, 100, 100]), np.array([7, 8, 75, 74])
    assert minhash.linked(inter, a, b).tolist() == [True, False, True, False]


def test_signature_estimates_similarity():
    import pyarrow as pa
    from llm import hashing

    a, b = prose(4, 500), edited(prose(4, 500), 1, 15)
    value, offsets = minhash.shingles(next(hashing.chunks(pa.array([a, b]))))
    signature = minhash.signatures(value, offsets)
    true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert abs((signature[0] == signature[1]).mean() - true) < 0.12


def test_one_of_each_keeps_all_columns_and_repeated_rows_once(spark):
    text = prose(2, 30)
    rows = [(3, text, "k1", 1), (1, text, "k2", 2), (1, text, "k2", 2), (None, "alone in the world", "k3", 3), (9, None, "k4", 4), (8, None, "k5", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `key` string, `component` int")
    kept = minhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.key) for r in kept.collect()) == [(0, "k3"), (1, "k2"), (8, "k5"), (9, "k4")]


def test_one_of_each_keeps_a_column_of_its_own_key_name(spark):
    text = prose(3, 30)
    df = spark.createDataFrame([(1, text, "a"), (1, text, "b"), (2, text, "c")], "doc_id long, text string, `__key` string")
    (row,) = minhash.one_of_each(df).collect()
    assert row.doc_id == 1 and row["__key"] in ("a", "b")


def test_empty(documents):
    assert minhash.verdicts(keyed(documents([]))).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    found = {r.node: r.component for r in components(df).collect()}
    truth = groups({n for e in edges for n in e}, edges)
    assert found == {n: c for n, c in truth.items() if n != c}
    assert components(df.limit(0)).count() == 0


def test_forest():
    a, b = forest(np.array([3, 9, 7]), np.array([9, 1, 8]))
    assert dict(zip(a.tolist(), b.tolist())) == {3: 1, 9: 1, 8: 7}
