"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A sequence of three letters is bound into one
vector: the first letter's permuted twice, the second's once, the third's as it is, multiplied.
A document bundles (adds) the vectors of its sequences; a language's prototype bundles its
documents, each at unit length. The language with the largest cosine is predicted.

Letters are compared in lower case; a run of other characters is one space, which takes part in
sequences. Defined results: a text that is null or has no letter is ``und`` with score 0, as is
every text if no language was learned; ties go to the first language by code point; documents
without language teach nothing; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import hashing
from llm.common import per_batch, streamed, table

DIMENSIONS = 512
UNKNOWN = "und"

_CELLS = 1 << 22  # of a table of documents by sequences at a time
_letters: dict[int, np.ndarray] = {}


def letter_vector(code: int) -> np.ndarray:
    """+1 and -1 drawn from the code point; the space is code 32."""
    if code not in _letters:
        bits = hashing.mix(np.arange(DIMENSIONS, dtype=np.uint64) + np.uint64(code << 16), salt=21)
        _letters[code] = np.where(bits >> np.uint64(63), 1, -1).astype(np.int8)
    return _letters[code]


def folded(codes: np.ndarray) -> np.ndarray:
    """Lower case letters by code point; all else is a space. A letter whose lower case is more than
    one code point stays as it is."""
    known, inverse = np.unique(codes, return_inverse=True) if len(codes) < 4096 else _by_table(codes)
    lower = [c.lower() if len(c.lower()) == 1 else c for c in map(chr, known)]
    return np.array([ord(x) if x.isalpha() else 32 for x in lower], dtype=np.int64)[inverse]


def _by_table(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known = np.flatnonzero(np.bincount(codes))
    place = np.zeros(known[-1] + 1, dtype=np.int64)
    place[known] = np.arange(len(known))
    return known, place[codes]


def letters(chunk: hashing.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded codes of a chunk with runs of spaces as one, their documents, and per document
    whether it has a letter. Each document is padded by a space on both sides."""
    codes = np.frombuffer(chunk.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    begins = np.zeros(len(chunk.data) + 1, dtype=np.int64)
    np.cumsum((chunk.data & 0xC0) != 0x80, out=begins[1:])
    offsets = begins[chunk.offsets]
    document = hashing.owners(offsets)
    code = folded(codes.astype(np.int64))
    has_letter = np.bincount(document[code != 32], minlength=chunk.size) > 0
    # A space in front and behind each document, then runs of spaces become one.
    n = chunk.size
    places = np.concatenate([offsets[:-1], np.arange(len(code)) , offsets[1:]])
    kinds = np.concatenate([np.zeros(n, np.int64), np.ones(len(code), np.int64), np.full(n, 2)])
    owner = np.concatenate([np.arange(n), document, np.arange(n)])
    order = np.lexsort((places, kinds, owner))
    code = np.concatenate([np.full(n, 32), code, np.full(n, 32)])[order]
    owner = owner[order]
    again = np.zeros(len(code), dtype=bool)
    again[1:] = (code[1:] == 32) & (code[:-1] == 32) & (owner[1:] == owner[:-1])
    return code[~again], owner[~again], has_letter


def vectors(chunk: hashing.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """A bundled vector per document (zero if it has no sequence), and whether it has a letter."""
    code, owner, has_letter = letters(chunk)
    out = np.zeros((chunk.size, DIMENSIONS), dtype=np.float32)
    if len(code) < 3:
        return out, has_letter
    known, index = _by_table(code)
    within = np.flatnonzero(owner[2:] == owner[:-2])
    if not len(within):
        return out, has_letter
    size = len(known)
    sequence = (index[within] * size + index[within + 1]) * size + index[within + 2]
    found, place = _by_table(sequence) if size**3 <= 1 << 23 else np.unique(sequence, return_inverse=True)
    table_ = np.stack([letter_vector(int(c)) for c in known])
    first, second, third = found // (size * size), found // size % size, found % size
    bound = np.roll(table_, 2, axis=1)[first] * np.roll(table_, 1, axis=1)[second] * table_[third]
    bound = bound.astype(np.float32)
    document = owner[within]
    step = max(1, _CELLS // len(found))
    bounds = np.searchsorted(document, np.arange(0, chunk.size + step, step))
    for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
        rows = min(step, chunk.size - i * step)
        if rows > 0 and high > low:
            cells = (document[low:high] - i * step) * len(found) + place[low:high]
            counts = np.bincount(cells, minlength=rows * len(found)).reshape(rows, len(found))
            out[i * step : i * step + rows] = counts.astype(np.float32) @ bound
    return out, has_letter


def unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def learn(documents: DataFrame) -> dict[str, np.ndarray]:
    """Prototypes from ``text, lang``: sums of unit vectors, one vector per language and task is
    shuffled and added up as a stream; the driver holds one vector per language."""
    schema = pa.schema([("lang", pa.string()), ("vector", pa.binary())])

    def emit(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if sums:
            columns = [list(sums), [v.tobytes() for v in sums.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for rows in batches:
            langs = np.array(rows.column(1).to_pylist(), dtype=object)
            for chunk in hashing.chunks(rows.column(0)):
                found, has_letter = vectors(chunk)
                found = unit(found)
                of = langs[chunk.first : chunk.first + chunk.size]
                for lang in set(of[has_letter]):
                    sums.setdefault(lang, np.zeros(DIMENSIONS))
                    sums[lang] += found[has_letter & (of == lang)].sum(axis=0, dtype=np.float64)
        yield from emit(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for rows in batches:
            for lang, vector in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                sums.setdefault(lang, np.zeros(DIMENSIONS))
                sums[lang] += np.frombuffer(vector)
        yield from emit(sums)

    known = documents.filter("lang IS NOT NULL").select("text", "lang")
    parts = streamed(known, bundle, "lang string, vector binary")
    rows = streamed(parts.repartition("lang"), add, "lang string, vector binary").collect()
    return {row.lang: np.frombuffer(row.vector) for row in sorted(rows, key=lambda r: r.lang)}


def predict(documents: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; only the text is looked at."""
    shared = documents.sparkSession.sparkContext.broadcast((
        [*prototypes, UNKNOWN], unit(np.stack([*prototypes.values()])).astype(np.float32) if prototypes else None
    ))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names, table_ = shared.value
        best = np.full(rows.num_rows, len(names) - 1)
        score = np.zeros(rows.num_rows)
        if table_ is not None:
            for chunk in hashing.chunks(rows.column(1)):
                found, has_letter = vectors(chunk)
                cosine = unit(found) @ table_.T
                part = slice(chunk.first, chunk.first + chunk.size)
                best[part] = np.where(has_letter, cosine.argmax(axis=1), len(names) - 1)
                score[part] = np.where(has_letter, np.clip(cosine.max(axis=1), 0, 1), 0)
        columns = [rows.column(0), pa.array([names[i] for i in best], pa.string()), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return per_batch(documents.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """A third of the documents, by their id, from which nothing is learned."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: languages of all documents, learned from those not held out."""
    documents = table(spark, sf_dir, "documents")
    prototypes = learn(documents.filter(~held_out()))
    found = predict(documents, prototypes)
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
