"""Quality classifier by importance resampling.

Two generative models of hashed one and two word sequences are fitted: the target's, from a
bounded sample of labelled good documents, and the raw text's, from all documents. A document's
importance weight is the ratio of both, taken per sequence so that length decides nothing and
raised to ``SHARPNESS``; ``k`` documents are drawn by it with Gumbel top-k, where ``k`` is the
number of documents beyond the cut which separates a second labelled sample best.

Defined results: a text that is null or without words has the neutral ratio 0. Documents with
equal ids have equal noise, and all rows that tie with the last one drawn are kept. Labels that
are null or contradict each other are not used; without labels of both kinds all rows are kept.
Further columns are ignored by the models and stay in the filter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import hashing
from llm.common import hashed_sample, per_batch, streamed, table, written

#: Labelled documents of each kind which are used at most; a hash of the id decides which.
SAMPLE = 50_000
#: Buckets of the hashed sequences, as a power of two.
BITS = 18
SMOOTHING = 1.0
#: Sequences a document counts as when noise is added; the higher, the less is left to chance.
SHARPNESS = 500.0
#: A good document lost weighs as much as so many bad ones kept, when the cut is chosen.
LOSS = 3.0

_SLICES = 64
_SEED = 7


class Sequences(NamedTuple):
    """Buckets of all sequences of a chunk, and the document each belongs to."""

    bucket: np.ndarray
    document: np.ndarray


def sequences(chunk: hashing.Chunk) -> Sequences:
    words = hashing.words(chunk, hashing.LOWERED)
    document = hashing.owners(words.offsets)
    shift = np.uint64(64 - BITS)
    pairs = np.flatnonzero(document[:-1] == document[1:])
    both = hashing.mix(words.hashes[pairs] * np.uint64(3) + words.hashes[pairs + 1], salt=11)
    bucket = np.concatenate([words.hashes >> shift, both >> shift]).astype(np.int64)
    return Sequences(bucket, np.concatenate([document, document[pairs]]))


class Sample(NamedTuple):
    """Ids of labelled documents, ascending: to fit the target, and to choose the cut."""

    target: np.ndarray
    good: np.ndarray
    bad: np.ndarray


def labelled(labels: DataFrame, most: int = SAMPLE) -> Sample:
    """Good are documents of quality 1 which are not toxic, bad are those of quality 0."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    kinds = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(good).alias("good"), F.max("quality").alias("best"), F.min("quality").alias("worst"))
        .filter("best = worst")
        .withColumn("rank", F.xxhash64("doc_id"))
    )

    def ids(rows: DataFrame) -> np.ndarray:
        chosen = hashed_sample(rows, "rank", most, "doc_id").select("doc_id").toArrow()
        return chosen.column(0).to_numpy().astype(np.int64)

    all_good = ids(kinds.filter("good"))
    return Sample(np.sort(all_good[::2]), np.sort(all_good[1::2]), np.sort(ids(kinds.filter("best = 0"))))


def member(ids: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """Whether each id is in an ascending sample."""
    if not len(sample):
        return np.zeros(len(ids), dtype=bool)
    return sample[np.minimum(np.searchsorted(sample, ids), len(sample) - 1)] == ids


def counts(documents: DataFrame, sample: Sample) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of all documents and of the target sample, by bucket.

    Every task adds up what it reads and hands on slices of its sums; a slice is added up in one
    task as a stream of arrays of fixed size.
    """
    n, width = 1 << BITS, (1 << BITS) // _SLICES
    shared = documents.sparkSession.sparkContext.broadcast(sample.target)
    schema = pa.schema([("slice", pa.int32()), ("raw", pa.binary()), ("target", pa.binary())])
    kinds = "slice int, raw binary, target binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for rows in batches:
            chosen = member(rows.column(0).fill_null(-1).to_numpy(zero_copy_only=False), shared.value)
            for chunk in hashing.chunks(rows.column(1)):
                found = sequences(chunk)
                raw += np.bincount(found.bucket, minlength=n)
                wanted = chosen[chunk.first + found.document]
                target += np.bincount(found.bucket[wanted], minlength=n)
        if raw.any():
            yield _slices({i: (a, b) for i, (a, b) in enumerate(zip(raw.reshape(_SLICES, width), target.reshape(_SLICES, width)))}, schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for rows in batches:
            for i, raw, target in zip(*(rows.column(c) for c in range(3))):
                a, b = sums.setdefault(i.as_py(), (np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)))
                a += np.frombuffer(raw.as_py(), dtype=np.int64)
                b += np.frombuffer(target.as_py(), dtype=np.int64)
        if sums:
            yield _slices(sums, schema)

    parts = streamed(documents.select(F.col("doc_id").cast("long"), "text"), count, kinds)
    raw, target = np.zeros((_SLICES, width)), np.zeros((_SLICES, width))
    for row in streamed(parts.repartition(_SLICES, "slice"), add, kinds).collect():  # 64 rows
        raw[row.slice] = np.frombuffer(row.raw, dtype=np.int64)
        target[row.slice] = np.frombuffer(row.target, dtype=np.int64)
    return raw.ravel(), target.ravel()


def _slices(sums: dict[int, tuple[np.ndarray, np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
    columns = [list(sums), [a.tobytes() for a, _ in sums.values()], [b.tobytes() for _, b in sums.values()]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class Model(NamedTuple):
    """Log ratio by bucket, and the ids whose scores choose the cut."""

    ratio: np.ndarray
    sample: Sample


def fit(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    sample = labelled(labels, most)
    raw, target = (values + SMOOTHING for values in counts(documents, sample))
    if not len(sample.good) or not len(sample.bad):
        return Model(np.zeros(1 << BITS, dtype=np.float32), sample)
    return Model(np.log((target / target.sum()) / (raw / raw.sum())).astype(np.float32), sample)


def ratios(texts: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """Mean log ratio of each text's sequences, 0 where there are none."""
    out = np.zeros(len(texts))
    for chunk in hashing.chunks(texts):
        found = sequences(chunk)
        sums = np.bincount(found.document, weights=ratio[found.bucket], minlength=chunk.size)
        sizes = np.bincount(found.document, minlength=chunk.size)
        out[chunk.first : chunk.first + chunk.size] = sums / np.maximum(sizes, 1)
    return out


def keys(ids: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """Tempered log weight plus Gumbel noise drawn from the id."""
    numbers = ids.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    uniform = (hashing.mix(hashing.mix(numbers, _SEED), _SEED) >> np.uint64(11)).astype(np.float64) + 0.5
    return SHARPNESS * ratio - np.log(-np.log(uniform / 2.0**53))


def scores(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, log_ratio, gumbel_key, sampled``: 1 and 0 for the sample which chooses the cut."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("log_ratio", pa.float64()), ("gumbel_key", pa.float64()), ("sampled", pa.int32())])

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, sample = rows.column(0), shared.value.sample
        ratio = ratios(rows.column(1), shared.value.ratio)
        numbers = ids.fill_null(-1).to_numpy(zero_copy_only=False)
        sampled = np.where(member(numbers, sample.good), 1, np.where(member(numbers, sample.bad), 0, -1))
        columns = [ids, pa.array(ratio), pa.array(keys(ids, ratio)), pa.array(sampled, pa.int32(), mask=sampled < 0)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return per_batch(
        documents.select(F.col("doc_id").cast("long"), "text"), run,
        "doc_id long, log_ratio double, gumbel_key double, sampled int",
    )


def best_cut(good: np.ndarray, bad: np.ndarray, loss: float = LOSS) -> float:
    """The ratio from which on documents count as good, least costly on the sample."""
    if not len(good) or not len(bad):
        return -np.inf
    good, bad = np.sort(good), np.sort(bad)
    cuts = np.concatenate([good, np.nextafter(bad, np.inf)])
    cost = loss * np.searchsorted(good, cuts) / len(good) + (len(bad) - np.searchsorted(bad, cuts)) / len(bad)
    best = cuts[cost == cost.min()]
    return float((best.min() + best.max()) / 2)


def kth_largest(values: DataFrame, column: str, k: int, bins: int = 1024, few: int = 10_000) -> float:
    """The exact ``k``-th largest value: counts in ever finer bins, then one short sorted list."""
    if k <= 0:
        return np.inf
    low, high = values.agg(F.min(column), F.max(column)).first()
    above = 0  # rows beyond ``high``, all of them among the k
    while True:
        inside = values.filter((F.col(column) >= low) & (F.col(column) <= high))
        width = (high - low) / bins
        if width <= 0:
            return low
        slot = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
        sizes = {r.slot: r for r in inside.groupBy(slot.alias("slot")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()}
        for slot in sorted(sizes, reverse=True):
            if above + sizes[slot].n >= k:
                low, high, n = sizes[slot].low, sizes[slot].high, sizes[slot].n
                break
            above += sizes[slot].n
        else:
            return low
        if n <= few:
            rest = values.filter((F.col(column) >= low) & (F.col(column) <= high)).select(column).collect()
            return sorted((r[0] for r in rest), reverse=True)[k - above - 1]


class Choice(NamedTuple):
    k: int
    threshold: float


def choose(scored: DataFrame) -> Choice:
    """How many documents to draw, and the smallest key among them; ``scored`` is a table."""
    sample = scored.filter("sampled IS NOT NULL").select("sampled", "log_ratio").toArrow()
    is_good = sample.column(0).to_numpy() == 1
    values = sample.column(1).to_numpy()
    cut = best_cut(values[is_good], values[~is_good])
    k = scored.filter(F.col("log_ratio") >= F.lit(cut)).count()
    return Choice(k, kth_largest(scored, "gumbel_key", k))


def resampled(documents: DataFrame, model: Model, choice: Choice) -> DataFrame:
    """The documents drawn, with all their columns; scored again in place, nothing is shuffled."""
    shared = documents.sparkSession.sparkContext.broadcast(model.ratio)

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, texts = (rows.column(rows.schema.get_field_index(name)) for name in ("doc_id", "text"))
        yield rows.filter(pa.array(keys(ids, ratios(texts, shared.value)) >= choice.threshold))

    return per_batch(documents, run, documents.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: weight and choice of every document."""
    documents = table(spark, sf_dir, "documents")
    scored = written(scores(documents, fit(documents, table(spark, sf_dir, "labels"))), "quality")
    kept = F.col("gumbel_key") >= F.lit(choose(scored).threshold)
    return scored.select("doc_id", "log_ratio", "gumbel_key", kept.alias("kept"))
