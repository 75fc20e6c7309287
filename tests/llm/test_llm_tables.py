"""Embeddings, mixing, archives and the pipeline."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import os
import random

import numpy as np
import pytest
from brute import ODD, groups, prose, words

import corpus_pipeline
from llm import mixing, neighbours, registry, warc
from llm.common import table
from lakestrata.session import new_shared_path

FOLDER = "/root/testdata/sf0.001"


def vectors_of(seed, n=400, width=24):
    rng = np.random.default_rng(seed)
    rows = list(rng.normal(size=(n, width)))
    for size, spread in ((40, 0.05), (15, 0.09), (6, 0.12)):
        middle = rng.normal(size=width)
        rows += [middle + spread * rng.normal(size=width) for _ in range(size)]
    rows += [rows[0], rows[0] * 3, rows[1]]
    return [r.astype(np.float32).tolist() for r in rows]


def expected_links(rows):
    usable = {i: np.array(v, dtype=float) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = list(usable)
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
        if len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] / np.linalg.norm(usable[a]) / np.linalg.norm(usable[b]) >= 0.9
    ]
    found = groups([i for i, _ in rows], links)
    return {i: (sum(i in link for link in links), found[i], found[i] == i) for i, _ in rows}


@pytest.mark.parametrize("shard,most", [(2000, 16_384), (40, 60), (60, 16_384)])
def test_neighbours_against_brute_force(spark, monkeypatch, shard, most):
    monkeypatch.setattr(neighbours, "SHARD", shard)
    monkeypatch.setattr(neighbours, "MOST", most)
    rows = list(enumerate(vectors_of(shard)))
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [1.0, None] * 12), (904, [float("nan")] * 24), (905, [float("inf")] * 24), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int").repartition(4)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neighbours.near_duplicates(df).collect()}
    expected = expected_links(rows)
    true = sum(n for n, _, _ in expected.values())
    assert set(found) == set(expected)
    assert all(found[i][0] <= expected[i][0] for i in found)  # nothing below the threshold
    assert sum(min(found[i][0], expected[i][0]) for i in found) >= 0.98 * true
    if shard == 2000:
        assert found == expected


def test_neighbours_are_compared_exactly_where_the_search_misses(spark, monkeypatch):
    """A graph without edges finds nothing, and few nodes leave no overlap to widen."""
    monkeypatch.setattr(neighbours, "graph", lambda member: member.select("node").distinct().selectExpr("node", "array(node) AS lists"))
    rows = list(enumerate(vectors_of(5)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for most in (16_384, 100):
        monkeypatch.setattr(neighbours, "MOST", most)
        found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neighbours.near_duplicates(df).collect()}
        assert found == expected_links(rows)


def test_audit_counts_distinct_pairs(spark):
    """A vector with most copies does not decide the recall alone."""
    rng = np.random.default_rng(1)
    pairs = [[v, v * 1.001 + 1e-3] for v in rng.normal(size=(50, 24))]
    rows = [(2 * i + j, 10_000 if i == 0 else 1, v.tolist()) for i, pair in enumerate(pairs) for j, v in enumerate(pair)]
    found = neighbours.with_identity(spark.createDataFrame(rows, "node long, copies long, embedding array<double>"))
    counts = spark.createDataFrame([(0, 10_000, 1), (1, 10_000, 1)], "node long, n long, pairs long")
    assert neighbours.recall(found, counts) == pytest.approx(2 / 100)


def test_neighbours_edges(spark):
    kinds = "vec_id long, embedding array<float>, node string, copies int"
    assert neighbours.near_duplicates(spark.createDataFrame([], kinds)).count() == 0
    odd = spark.createDataFrame([(1, [1.0, 0.0], "a", 1), (1, [1.0, 0.0], "a", 1), (2, [0.0, 1.0], "b", 2), (None, [1.0, 0.1], "c", 3), (5, None, "d", 4)], kinds)
    found = sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in neighbours.near_duplicates(odd).collect())
    assert found == [(0, 2, 0), (1, 2, 0), (1, 2, 0), (2, 0, 2), (5, 0, 5)]
    large = spark.createDataFrame([(1, [1e300, 1e300]), (2, [2e-300, 2e-300])], "vec_id long, embedding array<double>")
    assert [r.n_links for r in neighbours.near_duplicates(large).collect()] == [1, 1]


def test_robust_pruning_keeps_graph_connected():
    from llm.components import forest

    rng = np.random.default_rng(1)
    rows = neighbours.unit(rng.normal(size=(300, 16))).astype(np.float32)
    links = neighbours.pruned(rows, 1)
    source = np.repeat(np.arange(300), links.shape[1])
    inside = source != links.ravel()
    a, b = forest(source[inside], links.ravel()[inside])
    assert set(a.tolist()) == set(range(1, 300)) and set(b.tolist()) == {0}


def filled(sizes, weights=(5, 2, 1)):
    """Targets by raising the level until the shares are met."""
    total = 1.5 * sum(sizes)
    targets, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        level = left / sum(weights[i % 3] for i in open_)
        over = [i for i in open_ if level * weights[i % 3] > 2 * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = level * weights[i % 3]
            break
        for i in over:
            targets[i] = 2.0 * sizes[i]
            left -= targets[i]
            open_.remove(i)
    return targets


def mixture(seed):
    draw = random.Random(seed)
    sources = ["b", "a", None, "z", "é", "", "\U0001f600", "Z"]
    rows = []
    for i in range(400):
        source = draw.choice([sources[0]] * 6 + sources)
        rows.append((i, prose(i, draw.choice([0, 3, 40, 40, 200])) or None, "en", source, 1))
    return rows + [(9000 + i, text, "en", "a", 1) for i, text in enumerate(ODD)] + [rows[5], rows[5]]


@pytest.mark.parametrize("bucket_rows", [1, 1000])
def test_mixing_against_plain_targets(documents, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "_BUCKET_ROWS", bucket_rows)
    rows = mixture(1)
    found = mixing.mixed(documents(rows)).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    by_source = {}
    for i, text, _, source, _ in rows:
        by_source.setdefault(source, []).append((i, len(words(text))))
    order = sorted((s for s in by_source if s is not None)) + [None]
    sizes = [sum(n for _, n in by_source[s]) for s in order]
    targets = dict(zip(order, filled(sizes)))
    source_of = {r[0]: r[3] for r in rows}
    size_of = {r[0]: len(words(r[1])) for r in rows}
    taken = dict.fromkeys(order, 0)
    for r in found:
        source = source_of[r.doc_id]
        assert r.size == size_of[r.doc_id] and r.source_size == sizes[order.index(source)]
        assert r.target == pytest.approx(targets[source]) and 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source in order:
        assert abs(taken[source] - targets[source]) <= max(2 * mixing.BLOCK, 0.01 * targets[source])


def test_mixing_reruns_agree(documents):
    rows = mixture(2)
    a, b = (sorted(map(tuple, mixing.mixed(documents(r)).collect()), key=repr) for r in (rows, rows[::-1]))
    assert a == b


def test_schedule_is_evenly_spread(spark):
    sources = spark.createDataFrame([("a", 0, 64_000, 10, 64_000.0), ("b", 1, 64_000, 10, 32_000.0), ("c", 2, 6_400, 10, 12_800.0)], "source string, sid int, source_size long, rows long, target double")
    slots = mixing.schedule(sources).orderBy("slot").collect()
    for sid, target in ((0, 64_000), (1, 32_000), (2, 12_800)):
        own = [s for s in slots if s.sid == sid]
        assert sum(s.words for s in own) == target and [s.rank for s in own] == list(range(len(own)))
        share = target / 108_800
        for n in (50, 400, 1200):  # every stretch of the mix holds about each source's share
            assert abs(sum(s.sid == sid for s in slots[:n]) - n * share) <= 4
    assert max(s.block for s in slots if s.sid == 2) == 99


def long_tail():
    """A large source among 300 small ones, whose last blocks are part-filled."""
    sizes = {f"tail {i:03d}": (10, 20, 64, 80, 150, 300, 1000)[i % 7] for i in range(300)}
    return sizes | {"large": 400_000}


def test_mixing_of_a_long_tail_of_sources(documents):
    sizes = long_tail()
    rows = [(i, "w " * n, "en", source, 1) for i, (source, n) in enumerate(sizes.items())]
    order = sorted(sizes)
    expected = dict(zip(order, filled([sizes[s] for s in order])))
    found = {r.doc_id: r for r in mixing.mixed(documents(rows)).collect()}
    assert len(found) == len(rows)
    for i, (source, n) in enumerate(sizes.items()):
        assert found[i].target == pytest.approx(expected[source])
        assert abs(found[i].taken - expected[source]) <= max(1, 0.001 * expected[source]), (source, n)


def test_schedule_of_a_long_tail_has_every_rank_at_its_own_slot(spark):
    sized = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(long_tail().items())], "doc_id long, source string, size long")
    sources = mixing.targets(sized)
    slots = mixing.schedule(sources).collect()
    assert len({s.slot for s in slots}) == len(slots) and min(s.words for s in slots) > 0
    by_source = {}
    for s in slots:
        by_source.setdefault(s.sid, []).append(s)
    for r in sources.collect():
        own = by_source[r.sid]
        assert sorted(s.rank for s in own) == list(range(len(own)))
        assert sum(s.words for s in own) == int(r.target)
    odd = sorted(s.slot for s in slots if s.slot % 2)
    last = max(s.slot for s in slots)  # late ranks are spread over the mix, not put at its end
    assert odd and all(abs(sum(s < last * q for s in odd) - q * len(odd)) <= 0.05 * len(odd) + 2 for q in (0.25, 0.5, 0.75))


def test_mix_takes_the_scheduled_words_once(documents):
    sized = mixing.with_sizes(documents(mixture(3)))
    sources = mixing.targets(sized)
    parts = mixing.mix(mixing.streams(sized, sources), mixing.schedule(sources)).collect()
    covered = {}
    for p in parts:
        for w in range(p.from_word, p.to_word):
            covered[p.sid, p.start, w] = covered.get((p.sid, p.start, w), 0) + 1
    assert max(covered.values()) <= 2


def test_mixing_edges(documents):
    assert mixing.mixed(documents([])).count() == 0
    silent = mixing.mixed(documents([(1, None, None, None, 0), (2, "", None, "a", 0)])).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in silent) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


PAGES = "page_id long, url string, html string"


def pages_of():
    body = "<p>ä</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(1, "http://a", body), (2, "http://b\r\nX: y", body), (3, None, None), (4, "u", ""), (7, "http://a", body), (5, "c", "x" * 200_000), (6, "d", "\n\r\n")]
    return rows + [(10 + i, f"http://h/{i}", "copy" if i % 3 else f"page {i}") for i in range(60)]


def test_archives_round_trip(spark):
    rows = pages_of()
    path = new_shared_path(spark, "pages")
    warc.write(spark.createDataFrame(rows, PAGES).repartition(3), path, file_records=20)
    records = warc.read(spark, path).collect()
    assert len(records) == 3 * len(rows)
    expected = {}
    for i, _, html in rows:
        expected.setdefault((html or "").encode(), []).append(i)
    responses = {bytes(r.payload) for r in records if r.record_type == "response"}
    assert responses == set(expected)
    assert all(r.payload_digest == "sha1:" + base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode() for r in records if r.record_type == "response")
    whole = warc.transactions(warc.read(spark, path)).collect()
    assert len(whole) == len(rows)
    for capture in whole:
        assert capture.copies == 1 and capture.request.record_type == "request"
        assert capture.main.concurrent_to == capture.metadata.concurrent_to == capture.request.record_id == capture.capture
    target = [c.main.target for c in whole if "X: y" in c.main.target]
    assert target == ["http://b X: y"]


def found_captures(spark, rows, tmp_path, columns=PAGES):
    df = spark.createDataFrame(rows, columns)
    df.write.parquet(f"{tmp_path}/pages.parquet")
    return sorted(map(tuple, warc.captures(spark, str(tmp_path)).collect()), key=repr)


def expected_captures(rows):
    largest = {}
    for i, _, html, *_ in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    out = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        first = largest.get(html or "")
        kind = "response" if first is None or first == i else "revisit"
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, first if kind == "revisit" else None))
    return sorted(out, key=repr)


def test_captures_against_plain(spark, tmp_path):
    rows = [(*r, 1, "x") for r in pages_of()] + [(1, "http://a", pages_of()[0][2], 1, "x"), (99, "u", "twice", 1, "x"), (99, "u", "twice", 1, "x"), (None, "n", "copy", 1, "x")]
    assert found_captures(spark, rows, tmp_path, PAGES + ", sha1 int, name string") == expected_captures(rows)


def test_captures_of_nothing(spark, tmp_path):
    assert found_captures(spark, [], tmp_path) == []


def test_least_bytes(spark):
    rows = [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")]
    path = new_shared_path(spark, "pages")
    warc.write(spark.createDataFrame(rows, PAGES), path, least_bytes=3)
    assert sorted(r.record_type for r in warc.read(spark, path).collect() if r.record_type in ("response", "revisit")) == ["response"] * 3 + ["revisit"]


def test_reader_takes_members_and_refuses_cut_records():
    record = b"WARC/1.0\r\nwarc-type: warcinfo\r\ncontent-length: 5\r\n\r\nab\r\n\x00\r\n\r\n"
    assert [(f["warc-type"], b) for f, b in warc.parsed(gzip.compress(record) + gzip.compress(record))] == [("warcinfo", b"ab\r\n\x00")] * 2
    assert list(warc.parsed(b"")) == []
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parsed(record[:-6]))
    with pytest.raises(ValueError, match="whole record"):
        list(warc.parsed(record + b"garbage"))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered_query_equals_sql(spark, name):
    from checks.compare import difference

    assert difference(spark, name, FOLDER) is None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_pipeline_stages(spark):
    """Each stage against what a plain version says of its own input."""
    docs = table(spark, FOLDER, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = new_shared_path(spark, name)
        out = stage(spark, docs, FOLDER)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema.names == before.schema.names
    labels = {r.doc_id: r for r in table(spark, FOLDER, "labels").collect()}

    before, after = kept["quality_classifier"]
    ids = {r.doc_id for r in after.collect()}
    good = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert np.mean([i in ids for i in good]) > 0.95
    before, after = kept["minhash_near_dedup"]
    from brute import similar_groups

    expected = similar_groups({r.doc_id: r.text for r in before.collect()})
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in expected.items() if i == c}
    before, after = kept["benchmark_decontamination"]
    from test_llm_text import expected_hits

    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    hits = expected_hits([(r.doc_id, r.text) for r in before.collect()], items)
    assert {r.doc_id for r in after.collect()} == {i for i, h in hits.items() if not h[4]}
    before, after = kept["secret_scans"]
    from llm.secrets import base_spans

    assert before.count() == after.count() and not any(base_spans(r.text or "") for r in after.collect())
    before, after = kept["source_mixing"]
    assert {r.doc_id: r.size for r in after.collect()} == {r.doc_id: len(words(r.text)) for r in before.collect()}
