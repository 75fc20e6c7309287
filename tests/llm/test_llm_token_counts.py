"""Token counts against the library's own, text by text."""

from __future__ import annotations

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
DEFINITION = open(PATH, encoding="utf-8").read()

PIECES = [
    "'", "'s", "'re", "'ll", "'ve", "'d", "'S", "s", "t", "a", "B", "é", "漢", "1", "²", "٣", " ", "  ", "\n", "\t", "\r\n",
    " ", "!", "?", '"', "-", "\x1c", "\U0001f600", "̈", "Ᲊ", "x" * 30, "<|endoftext|>", "<|endof", "leéenan",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows) -> list:
    texts = [text or "" for _, text in rows]
    counts = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    return sorted((str(i), len(t.encode()), n) for (i, _), t, n in zip(rows, texts, counts))


def counted(documents, rows) -> list:
    df = token_counts.count_tokens(documents(rows), DEFINITION)
    return sorted((str(r.id), r.n_bytes, r.n_tokens) for r in df.collect())


def test_random_texts(documents, library):
    draw = random.Random(4)
    rows = [(i, "".join(draw.choice(PIECES) for _ in range(draw.randrange(30)))) for i in range(4000)]
    assert counted(documents, rows) == expected(library, rows)


def test_odd_texts_repeated_rows_and_missing_ids(documents, library):
    rows = [*enumerate(brute.ODD), (3, "a"), (3, "a"), (None, "x y"), (None, None), (7, brute.prose(1, 500))]
    assert counted(documents, rows) == expected(library, rows)


def test_long_texts_in_pieces_and_several_blocks(documents, library, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE_BYTES", 300)
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 2000)
    rows = [(i, brute.prose(i, 900) + " 'tis\n\nthe  end ") for i in range(12)] + [(99, "漢" * 2000), (98, " " * 2000 + "z")]
    # The workers read the module anew, so the same is done here without them.
    vocab = token_counts.vocabulary(DEFINITION)
    data = [t.encode() for _, t in rows]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    block = token_counts.Block("b", vocab)
    block.take(None, np.frombuffer(b"".join(data), dtype=np.uint8), bounds)
    base, names, row, number, count = block.frequencies()
    pieces = np.array([vocab.pieces(n) for n in names])
    got = base + np.bincount(row, weights=pieces[number] * count, minlength=len(rows)).astype(int)
    assert got.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for _, t in rows]
    assert len(list(token_counts.cut(data[0]))) > 3


def test_each_distinct_pretoken_once_in_its_block_and_bucket(documents):
    rows = [(i, "leéenan ouanne leéenan") for i in range(50)]
    vocab = token_counts.vocabulary(DEFINITION)
    block = token_counts.Block("b", vocab)
    data = [t.encode() for _, t in rows]
    block.take(None, np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum([0, *map(len, data)]))
    _, names, row, _, count = block.frequencies()
    assert len(names) == len(set(names)) == 3 and len(row) == 150 and set(count) == {1}
    assert all(token_counts.bucket_of(a) <= token_counts.bucket_of(b) for a, b in zip(names, names[1:]))


def test_empty_table_and_clashing_columns(spark, documents):
    assert token_counts.count_tokens(documents([]), DEFINITION).collect() == []
    df = documents([(1, "a b")])
    for name in ("id", "block", "bucket", "pieces", "base", "entries", "n_tokens"):
        df = df.withColumn(name, F.lit("mine"))
    assert [tuple(r) for r in token_counts.count_tokens(df, DEFINITION).collect()] == [(1, 3, 2)]


def test_other_kinds_of_tokenizer_are_refused(documents):
    other = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.count_tokens(documents([(1, "a")]), other)


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.query(spark, folder).collect())
    assert got == [(*row, row[2] > 1024) for row in expected(library, rows)]
