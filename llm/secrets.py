"""Secret scans: fixed patterns, and character Markov models for what no pattern names.

The patterns give the base spans. Of every other long identifier two character models are asked,
one of random strings and one of ordinary identifiers; where the log-likelihood ratio per
character is high enough, it is a further span. Both models are trained from labelled samples:
what the patterns find is labelled random, other words are labelled ordinary.

Defined results: null and empty texts have no spans. Spans count code points, ends are exclusive.
Equal documents give equal spans; further columns are ignored; an empty table gives no rows, and
without samples the models are not asked.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import hashed_sample, per_batch, table, written

# Fixed patterns. Only the key names of an assignment are taken in either case.
KEY_NAMES = "(?:password|passwd|secret|token|api_?key)"
ASSIGN = re.compile(rf"(?ai:{KEY_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "markov")

#: Identifiers the models are asked about, and from which they learn ordinary ones.
IDENTIFIER = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Labelled samples of each kind the models are fitted on at most; which ones is decided by a hash.
SAMPLES = 20_000
#: Least mean log-likelihood ratio per character, in nats.
LEAST_RATIO = 0.2

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODES = np.full(128, -1, dtype=np.int64)
_CODES[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))

Span = tuple[int, int, int]  # start, index of the kind, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns: leftmost, not overlapping within a kind, in order."""
    found = []
    if ":" in text or "=" in text:  # no assignment without one
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def secret_values(text: str, spans: list[Span]) -> Iterator[str]:
    """The secret of each base span, without the name it is assigned to."""
    for start, kind, end in spans:
        value = ASSIGN.match(text, start)[1] if kind == 0 else text[start:end]
        if len(value) >= 16 and IDENTIFIER.fullmatch(value):
            yield value


def uncovered(text: str, spans: list[Span]) -> Iterator[re.Match]:
    """Identifiers which no base span touches; both come in order and are walked through once."""
    at, reach = 0, 0
    for match in IDENTIFIER.finditer(text):
        while at < len(spans) and spans[at][0] < match.end():
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= match.start():
            yield match


class Models(NamedTuple):
    """Log-likelihood ratios of two order-1 character models: first characters and transitions."""

    first: np.ndarray
    next: np.ndarray

    def ratio(self, word: str) -> float:
        """Mean log-likelihood ratio per character, random against ordinary."""
        codes = _CODES[np.frombuffer(word.encode("ascii"), dtype=np.uint8)]
        return float(self.first[codes[0]] + self.next[codes[:-1], codes[1:]].sum()) / len(codes)


def counted(words: Iterator[str]) -> tuple[np.ndarray, np.ndarray]:
    n = len(ALPHABET)
    first, pairs = np.zeros(n), np.zeros((n, n))
    for word in words:
        codes = _CODES[np.frombuffer(word.encode("ascii"), dtype=np.uint8)]
        first[codes[0]] += 1
        np.add.at(pairs, (codes[:-1], codes[1:]), 1)
    return first, pairs


def fit(random_words: list[str], ordinary_words: list[str], smoothing: float = 0.5) -> Models | None:
    """Models of both samples; None if one of them is empty."""
    if not random_words or not ordinary_words:
        return None
    logs = []
    for words in (random_words, ordinary_words):
        first, pairs = (counts + smoothing for counts in counted(iter(words)))
        logs.append((np.log(first / first.sum()), np.log(pairs / pairs.sum(axis=1, keepdims=True))))
    (r_first, r_next), (o_first, o_next) = logs
    return Models(r_first - o_first, r_next - o_next)


def samples(documents: DataFrame, most: int = SAMPLES) -> DataFrame:
    """Labelled identifiers ``word, is_random``: at most ``most`` of each label, by a hash of the
    word. Each task hands on its own ``most`` distinct ones with the smallest hash."""
    schema = pa.schema([("word", pa.string()), ("is_random", pa.bool_()), ("rank", pa.int64())])

    def rank(word: str) -> int:
        return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big", signed=True)

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        labelled: tuple[set, set] = (set(), set())
        for text in rows.column(0).to_pylist():
            if text:
                spans = base_spans(text)
                labelled[1].update(secret_values(text, spans))
                labelled[0].update(m[0] for m in uncovered(text, spans))
        for is_random, words in enumerate(labelled):
            least = sorted((rank(w), w) for w in words)[:most]
            if least:
                ranks, kept = zip(*least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kept), pa.array([bool(is_random)] * len(kept)), pa.array(ranks)], schema=schema
                )

    found = per_batch(documents.select("text"), run, "word string, is_random boolean, rank long").distinct()
    found = written(found, "words")
    halves = [hashed_sample(found.filter(F.col("is_random") == label), "rank", most, "word") for label in (True, False)]
    return halves[0].unionByName(halves[1]).select("word", "is_random")


def train(documents: DataFrame, most: int = SAMPLES) -> Models | None:
    """Fit the models on the bounded sample; two tables of 67 by 67 numbers are the result."""
    rows = samples(documents, most).collect()
    return fit([r.word for r in rows if r.is_random], [r.word for r in rows if not r.is_random])


def all_spans(text: str, models: Models | None, least_ratio: float = LEAST_RATIO) -> tuple[list[Span], list[Span]]:
    """Base spans, and those of the models."""
    base = base_spans(text)
    if models is None:
        return base, []
    return base, [(m.start(), 3, m.end()) for m in uncovered(text, base) if models.ratio(m[0]) >= least_ratio]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan(documents: DataFrame, models: Models | None, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """Spans of every document: counts by base kind, the digest of the base spans, all spans."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
        ("base_sha256", pa.string()), ("spans", pa.string()), ("n_markov", pa.int64()),
    ])

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for text in rows.column(1):
            base, more = all_spans(text.as_py() or "", models, least_ratio)
            kinds = [kind for _, kind, _ in base]
            digest = hashlib.sha256(listed(base).encode()).hexdigest()
            out.append((*(kinds.count(k) for k in range(3)), digest, listed(base + more), len(more)))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*out), list(schema)[1:]))], schema=schema
        )

    kinds = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"
    return per_batch(documents.select(F.col("doc_id").cast("long"), "text"), run, kinds)


def without_secrets(documents: DataFrame, models: Models | None, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """The documents with each secret replaced by ``[kind]``; all columns stay, ``n_chars`` counts
    the new text where the documents have it. Overlapping spans are replaced as one."""

    def cleaned(text: str | None) -> str | None:
        base, more = all_spans(text or "", models, least_ratio)
        if not base and not more:
            return text
        out, at = [], 0
        for start, kind, end in sorted(base + more):
            if start >= at:
                out += [text[at:start], f"[{KINDS[kind]}]"]
            at = max(at, end)
        return "".join(out) + text[at:]

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = rows.schema.get_field_index("text")
        texts = pa.array([cleaned(text.as_py()) for text in rows.column(at)], rows.schema.field(at).type)
        yield rows.set_column(at, rows.schema.field(at), texts)

    out = per_batch(documents, run, documents.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: spans of all documents."""
    documents = table(spark, sf_dir, "documents")
    return scan(documents, train(documents))
