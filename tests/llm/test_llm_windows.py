"""Both window operators and the resolution they share."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import ODD, prose, repeated, sha, words

from llm import hashing, passages, relative_lz, suffix_lpf


def corpus(seed: int) -> list[tuple[int, str | None]]:
    """Copies, shared passages, edits, and texts which repeat themselves."""
    draw = random.Random(seed)
    base = [prose(seed * 100 + i, 120) for i in range(12)]
    texts = list(base) + ODD
    for i in range(60):
        parts = []
        for _ in range(draw.randrange(1, 4)):
            source = draw.choice(base).split()
            at = draw.randrange(0, 90)
            parts += source[at : at + draw.randrange(5, 60)]
            if draw.random() < 0.3:
                parts.insert(draw.randrange(0, len(parts) + 1), f"edit{i}")
        texts.append(draw.choice([" ", "\n", "  "]).join(parts))
    texts += ["ab " * 200, "ab " * 201 + "tail", "line one is here\n" * 60, "\x1cnot a blank\x85 " * 30]
    ids = draw.sample(range(1000), len(texts))
    return list(zip(ids, texts))


def expected_words(rows, window):
    sequences = {key: words(text) for key, text in rows}
    covered = repeated(sequences, window, first_too=False)
    return {
        key: (len(found), sum(covered[key]), sha(b" ".join(w for w, gone in zip(found, covered[key]) if not gone)))
        for key, found in sequences.items()
    }


@pytest.mark.parametrize("window,group", [(20, 4096), (20, 1), (5, 3), (1, 4096)])
def test_words_against_brute_force(documents, window, group):
    rows = corpus(window)
    found = relative_lz.deduplicated(documents(rows), window, group).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, sha(bytes(r.kept))) for r in found} == expected_words(rows, window)
    assert all(sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed for r in found)


@pytest.mark.parametrize("first_too", [True, False])
@pytest.mark.parametrize("window,group", [(60, 4096), (60, 1), (33, 2)])
def test_bytes_against_brute_force(documents, window, group, first_too):
    rows = [(key, text[:3000] if text else text) for key, text in corpus(window)]
    found = suffix_lpf.deduplicated(documents(rows), window, first_too, group).collect()
    sequences = {key: (text or "").encode() for key, text in rows}
    covered = repeated(sequences, window, first_too)
    for r in found:
        gone = covered[r.doc_id]
        kept = bytes(b for b, x in zip(sequences[r.doc_id], gone) if not x)
        assert (r.n_bytes, r.n_removed, bytes(r.kept)) == (len(gone), sum(gone), kept)
        assert len(r.spans) // 2 == sum(x and not y for x, y in zip(gone, [False, *gone]))


def test_rows_with_equal_ids_are_documents_of_their_own(documents):
    text = prose(5, 40)
    rows = [(1, text), (1, text), (None, text), (2, "other"), (2, None)]
    found = relative_lz.deduplicated(documents(rows)).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in found) == [(False, 0), (False, 0), (False, 40), (False, 40), (True, 0)]


def test_empty_table_and_clashing_columns(spark, documents):
    assert relative_lz.deduplicated(documents([])).count() == 0
    assert suffix_lpf.deduplicated(documents([])).count() == 0
    text = prose(6, 30)
    odd = spark.createDataFrame([(1, text, 7, "x"), (2, text, 8, "y")], "doc_id int, text string, `key` int, `start` string")
    assert {r.doc_id: r.n_removed for r in relative_lz.deduplicated(odd).collect()} == {1: 0, 2: 30}


def test_greedy_factors_and_lookups_at_their_boundaries():
    a, b = list(range(10, 20)), list(range(30, 40))
    words = np.array([*a, *b, *a[2:], *b[:7], 99, *b[3:]], dtype=np.uint64)
    ends = np.array([10, 20, 35, 43])
    begins = [0, 10, 20, 35]
    window = 3
    at = np.concatenate([np.arange(low, high - window + 1) for low, high in zip(begins, ends)])
    of = np.concatenate([np.full(high - low - window + 1, high) for low, high in zip(begins, ends)])
    found = relative_lz.factors(words, at, of, window)
    # The third passage is the rest of the first and the begin of the second; 99 is nowhere before.
    assert found == [(20, 2, 8), (28, 10, 7), (36, 13, 7)]


def naive_previous(payloads):
    places = [(p, i) for p, text in enumerate(payloads) for i in range(len(text))]

    def common(x, y):
        a, b = payloads[x[0]][x[1] :], payloads[y[0]][y[1] :]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    return [max((common(x, y) for y in places[:n]), default=0) for n, x in enumerate(places)]


@pytest.mark.parametrize("letters,sizes", [(b"ab", [40, 1, 60, 25]), (b"a", [30, 30, 31]), (bytes(range(256)), [200, 90]), (b"abc", [7, 8, 21, 22, 64])])
def test_longest_previous_factors_have_the_naive_lengths(letters, sizes):
    draw = random.Random(sum(sizes))
    payloads = [bytes(draw.choices(letters, k=n)) for n in sizes]
    payloads.append(payloads[0][3:] + payloads[-1][:5])
    found = suffix_lpf.suffixes(payloads)
    place = np.concatenate([np.arange(len(p)) + sum(len(q) + 1 for q in payloads[:n]) for n, p in enumerate(payloads)])
    rest = np.concatenate([len(p) - np.arange(len(p)) for p in payloads])
    length, source = suffix_lpf.longest_previous(found, place, rest)
    assert length.tolist() == naive_previous(payloads)
    assert all(s < i for i, s in enumerate(source.tolist()))
    texts = b"\x00".join(payloads) + b"\x00"
    suffix = [texts[a : texts.index(b"\x00", a)] if 0 not in letters else None for a in found.order[np.isin(found.order, place)]]
    assert 0 in letters or suffix == sorted(suffix)


def test_nearest_smaller():
    draw = random.Random(1)
    for values in ([5, 4, 3, 2, 1], list(range(50)), draw.sample(range(1000), 400), [], [1]):
        found = suffix_lpf.nearest_smaller(np.array(values, dtype=np.int64))
        assert found.tolist() == [max((j for j in range(i) if values[j] < v), default=-1) for i, v in enumerate(values)]


@pytest.mark.parametrize("at_once", [1 << 20, 50])
def test_windows_of_a_passage_differ_however_a_text_repeats(at_once):
    chunk = next(hashing.chunks(pa.array(["a b a b a b c " * 50])))
    kind = relative_lz.kind_of(20)
    units, offsets = kind.units(chunk)
    sums = hashing.prefix_sums(units)
    found = list(passages.passages(units, offsets, kind, at_once))
    assert sum(f.windows.sum() for f in found) == 350 - 19 and max(f.windows.max() for f in found) <= 15
    for f in found:
        for start, n in zip(f.start, f.windows):
            at = np.arange(start, start + n)
            assert len(np.unique(hashing.range_hash(sums, at, at + 20, 8))) == n


def test_a_document_in_pieces_has_the_same_words(monkeypatch):
    texts = pa.array(["ab cd  " * 40 + "x" * 90 + " yz\n" + "w" * 70, None, "q r"])
    whole = [hashing.words(c, hashing.PLAIN) for c in hashing.chunks(texts, 1)]
    monkeypatch.setattr(hashing, "CHUNK_BYTES", 16)
    for before, chunk in zip(whole, hashing.chunks(texts, 1)):
        after = hashing.words(chunk, hashing.PLAIN)
        assert all(a.tolist() == b.tolist() for a, b in zip(before, after))
