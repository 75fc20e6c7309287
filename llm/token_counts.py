"""Token counts of whole texts: pieces of distinct pre-tokens joined to frequencies per document.

A byte-level BPE never merges across a pre-token's end, so a text has as many tokens as its
pre-tokens have pieces. No sequence of ids is made:

1. Each task cuts texts into pre-tokens (positions in the text's own buffer, no Python object
   each) and counts them per document. Those which are entries of the vocabulary, a table of
   known size, are added up at once. The others are numbered within a block of documents; a block
   leaves its distinct pre-tokens, dealt into buckets by their bytes, and per document the pairs
   (number, frequency).
2. Per bucket each distinct pre-token is given to the library's model once.
3. The counts go back to their blocks, where numbers and frequencies meet them.

A pre-token occurs once in a block however frequent it is, so no key is hot; a bucket is read as a
stream. Where a pre-token ends is the library's decision too: its classes of characters are asked
of its own pre-tokenizer, character by character, when one first occurs.

Defined results: a null text is empty, an empty text has no tokens, and each row is counted by
itself, also those which share an id or have none. Bytes which are no UTF-8 count as U+FFFD.
Strings of added tokens (``<|endoftext|>``) are one token each, as the library has it by default.
An empty table gives no rows. Further columns are ignored.

A text longer than ``PIECE_BYTES`` is taken in pieces which end before a single blank between two
other characters, where a pre-token ends whatever follows. A pre-token itself is never cut: one of
many megabytes is held by one task, as the model needs it whole.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.common import ship, streamed, table, written
from llm.hashing import texts

#: Bytes of text which are cut at a time; work arrays take about 30 times as much.
PIECE_BYTES = 1 << 20
#: Bytes of text which share one numbering of pre-tokens.
BLOCK_BYTES = 16 << 20
#: Buckets of distinct pre-tokens; a block leaves one row for each at most.
BUCKETS = 4096
#: Pre-tokens whose counts a task remembers at a time. Beyond it one is counted anew, with the same result.
REMEMBERED = 1 << 20

LIMIT = 1024

LETTER, NUMBER, OTHER, BLANK = 1, 2, 3, 4
_SPACE, _APOSTROPHE = 0x20, 0x27

# The contractions which the pre-tokenizer of this family takes off a word.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


class Texts(NamedTuple):
    """Texts back to back: bytes, code points, and the code points at which each text begins."""

    data: bytes
    points: np.ndarray
    starts: np.ndarray  # n + 1


class Vocabulary:
    """What a task needs of a tokenizer file."""

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        plain = json.loads(definition)
        check(plain)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        #: The character that stands for each byte: itself if printable, else one beyond 255.
        self.characters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
        bytes_of = {c: b for b, c in self.characters.items()}
        added = {t["content"] for t in plain["added_tokens"]}
        self.added = re.compile("|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        self.added_strings = sorted(added)
        entries = [e for e in self.tokenizer.get_vocab(with_added_tokens=False) if e not in added]
        known = sorted(bytes(bytes_of[c] for c in e) for e in entries)
        self.known = pa.array(known, pa.large_binary())
        self.known_pieces = np.array([self.pieces(e) for e in known], dtype=np.int64)
        self._classes = np.zeros(0x110000, dtype=np.uint8)

    def pieces(self, pretoken: bytes) -> int:
        return len(self.tokenizer.model.tokenize(pretoken.decode("latin-1").translate(self.characters)))

    def classes(self, points: np.ndarray) -> np.ndarray:
        """The class of every code point; those met for the first time are asked of the library."""
        found = self._classes[points]
        if not found.all():
            new = np.unique(points[found == 0]).tolist()
            for c in new:
                self._classes[c] = self._ask(chr(c))
            found = self._classes[points]
        return found

    def _ask(self, character: str) -> int:
        """Between two characters of its own class, a character other than a blank joins them."""
        for kind, other in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.tokenizer.pre_tokenizer.pre_tokenize_str(other + character + other)) == 1:
                return kind
        return BLANK


def check(definition: dict) -> None:
    """Refuse tokenizers whose counts this way of counting would not give."""
    pre = definition.get("pre_tokenizer") or {}
    plain = (
        definition["model"]["type"] == "BPE"
        and not definition.get("normalizer")
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
    )
    simple = not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in definition["added_tokens"])
    if not (plain and simple):
        raise ValueError("only byte-level BPE files without normalizer and prefix blank are counted")


_vocabularies: dict[int, Vocabulary] = {}


def vocabulary(definition: str) -> Vocabulary:
    """One per worker, however many tasks it runs."""
    key = hash(definition)
    if key not in _vocabularies:
        _vocabularies[key] = Vocabulary(definition)
    return _vocabularies[key]


def joined(parts: list[bytes]) -> Texts:
    """Texts of the given bytes; invalid sequences become U+FFFD."""
    data = b"".join(parts)
    try:
        text = data.decode()
        sizes = np.array([len(p) for p in parts])
    except UnicodeDecodeError:
        parts = [p.decode("utf-8", "replace").encode() for p in parts]
        data = b"".join(parts)
        text, sizes = data.decode(), np.array([len(p) for p in parts])
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return Texts(data, points, np.searchsorted(byte_starts(points), bounds))


def byte_starts(points: np.ndarray) -> np.ndarray:
    """Where each code point begins in UTF-8, and where the last ends."""
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    return np.concatenate([[0], np.cumsum(width)])


def pretoken_starts(t: Texts, classes: np.ndarray) -> np.ndarray:
    """Code points at which a pre-token begins. They cover the texts without gaps.

    A pre-token is a run of one class, together with one space before it. Of several blanks before
    a run the last stands apart; blanks at a text's end are one. An apostrophe which begins a run
    takes the letters of a contraction with it.
    """
    n = len(classes)
    if not n:
        return np.zeros(0, dtype=np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[t.starts] = True
    first = edge[:-1].copy()
    first[1:] |= classes[1:] != classes[:-1]
    blank = classes == BLANK
    before_text_end = edge[1:]
    last_blank = blank & ~before_text_end
    last_blank[:-1] &= ~blank[1:]
    last_blank[-1] = False
    starts = first.copy()
    # The last blank before a run begins a pre-token; if it is a space, the run belongs to it.
    starts |= last_blank
    joins = np.zeros(n, dtype=bool)
    joins[1:] = (last_blank & (t.points == _SPACE))[:-1]
    starts &= ~(joins & ~blank)

    mark = np.flatnonzero((t.points == _APOSTROPHE) & starts)
    for tail in CONTRACTIONS:
        size = len(tail) + 1
        here = mark[mark + size <= n]
        for i, c in enumerate(tail, 1):
            here = here[(t.points[here + i] == ord(c)) & ~edge[here + i]]
        starts[here + 1] = False
        after = here[here + size < n] + size
        starts[after] = True
    return np.flatnonzero(starts)


def pretokens(t: Texts, starts: np.ndarray) -> pa.DictionaryArray:
    """The pre-tokens in order, encoded by the distinct ones. Bytes are compared, not hashes."""
    offsets = np.append(byte_starts(t.points)[starts], len(t.data)).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(t.data)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()


def segments(vocab: Vocabulary, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Texts in runs of about ``PIECE_BYTES``: their parts between added tokens, the row of each
    part, and rows with an added token for each occurrence."""
    parts, rows, added, held = [], [], [], 0
    for row in range(len(bounds) - 1):
        raw = data[bounds[row] : bounds[row + 1]].tobytes()
        if vocab.added and any(s.encode() in raw for s in vocab.added_strings):
            text = raw.decode("utf-8", "replace")
            whole = [p.encode() for p in vocab.added.split(text)]
            added += [row] * (len(whole) - 1)
        else:
            whole = [raw]
        for part in whole:
            for piece in cut(part):
                parts.append(piece)
                rows.append(row)
                held += len(piece)
                if held >= PIECE_BYTES:
                    yield parts, np.array(rows), np.array(added, dtype=np.int64)
                    parts, rows, added, held = [], [], [], 0
    if parts or added:
        yield parts, np.array(rows, dtype=np.int64), np.array(added, dtype=np.int64)


#: A space or line break between two characters of ASCII which are no blanks.
_SAFE = re.compile(rb"(?<=[!-~])[ \n](?=[!-~])")


def cut(text: bytes) -> Iterator[bytes]:
    """Pieces of a long text which end where a pre-token ends."""
    low = 0
    while len(text) - low > 2 * PIECE_BYTES:
        # A match needs one byte on each side, so the place before it is found by a search from there.
        found = _SAFE.search(text, low + PIECE_BYTES)
        if not found:
            break
        yield text[low : found.start()]
        low = found.start()
    yield text[low:]


class Block:
    """Documents which share one numbering of pre-tokens."""

    def __init__(self, name: str, vocab: Vocabulary):
        self.name, self.vocab, self.bytes, self.n = name, vocab, 0, 0
        self.batches: list[tuple[pa.Array, np.ndarray]] = []
        self.encoded: list[pa.DictionaryArray] = []
        self.rows: list[np.ndarray] = []
        self.added: list[np.ndarray] = []

    def take(self, ids: pa.Array, data: np.ndarray, bounds: np.ndarray) -> None:
        """Cut the texts of a batch."""
        for parts, rows, added in segments(self.vocab, data, bounds):
            self.added.append(added + self.n)
            t = joined(parts)
            starts = pretoken_starts(t, self.vocab.classes(t.points))
            if len(starts):
                self.encoded.append(pretokens(t, starts))
                self.rows.append((rows + self.n)[np.searchsorted(t.starts, starts, side="right") - 1].astype(np.int32))
        self.batches.append((ids, np.diff(bounds)))
        self.bytes += int(bounds[-1] - bounds[0])
        self.n += len(bounds) - 1

    def frequencies(self) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Per row the tokens of known pre-tokens; the other pre-tokens, in the order of their
        buckets; and row, number and count of those, ascending."""
        base = np.bincount(np.concatenate([*self.added, np.zeros(0, np.int64)]), minlength=self.n)
        if not self.encoded:
            return base, [], *[np.zeros(0, dtype=np.int64)] * 3
        whole = pa.chunked_array(self.encoded).unify_dictionaries()
        distinct = whole.chunk(0).dictionary
        which = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in whole.chunks])
        row = np.concatenate(self.rows)
        place = pc.index_in(distinct, value_set=self.vocab.known).fill_null(-1).to_numpy(zero_copy_only=False)
        pieces = np.where(place >= 0, self.vocab.known_pieces[place], 0)
        base = base + np.bincount(row, weights=pieces[which], minlength=self.n).astype(np.int64)

        names = distinct.filter(pa.array(place < 0)).to_pylist()
        buckets = np.array([bucket_of(p) for p in names], dtype=np.int64)
        order = np.argsort(buckets, kind="stable")
        numbers = np.full(len(distinct), -1, dtype=np.int64)
        numbers[np.flatnonzero(place < 0)[order]] = np.arange(len(names))
        rest = numbers[which] >= 0
        width = max(len(names), 1)
        keys, counts = np.unique(row[rest] * np.int64(width) + numbers[which][rest], return_counts=True)
        return base, [names[i] for i in order], keys // width, keys % width, counts

    def parts(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row per bucket with its pre-tokens, and a row per batch of documents."""
        base, names, row, number, count = self.frequencies()
        buckets = np.array([bucket_of(p) for p in names], dtype=np.int64)
        cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
        for low, high in zip(cuts, np.append(cuts[1:], len(names))):
            yield part(schema, block=self.name, bucket=int(buckets[low]), pretokens=names[low:high])
        entries = np.bincount(row, minlength=self.n)
        first, before = 0, 0
        for ids, sizes in self.batches:
            mine = slice(first, first + len(sizes))
            after = before + int(entries[mine].sum())
            yield part(
                schema, block=self.name, ids=ids, n_bytes=sizes, base=base[mine], entries=entries[mine],
                frequencies=packed(entries[mine], number[before:after], count[before:after]),
            )
            first, before = mine.stop, after


def bucket_of(pretoken: bytes) -> int:
    return zlib.crc32(pretoken) % BUCKETS


def packed(entries: np.ndarray, numbers: np.ndarray, counts: np.ndarray) -> bytes:
    """Pairs which ascend within each document, as differences and counts, compressed."""
    steps = np.diff(numbers, prepend=0)
    starts = (np.cumsum(entries) - entries)[entries > 0]
    steps[starts] = numbers[starts]
    planes = np.stack([steps, counts]).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(entries: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(entries.sum())
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    steps, counts = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(2, n).astype(np.int64)
    running = np.cumsum(steps)
    starts = np.cumsum(entries) - entries
    filled = entries > 0
    before = np.zeros(len(entries), dtype=np.int64)
    before[filled] = running[starts[filled]] - steps[starts[filled]]
    return running - np.repeat(before, entries), counts


PARTS = (
    "block string, bucket int, pretokens array<binary>, ids array<{id}>, n_bytes array<bigint>, "
    "base array<bigint>, entries array<int>, frequencies binary"
)


def part(schema: pa.Schema, **values) -> pa.RecordBatch:
    """One row; a field that is not given is null."""
    columns = []
    for field in schema:
        value = values.get(field.name)
        if isinstance(value, pa.Array):
            value = pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value).cast(field.type)
        else:
            value = pa.array([value.tolist() if isinstance(value, np.ndarray) else value], field.type)
        columns.append(value)
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def count_frequencies(definition: str, parts: pa.Schema):
    """A task's documents as parts: distinct pre-tokens and frequencies of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(definition)
        partition, n = TaskContext.get().partitionId(), 0
        block = Block(f"{partition}-0", vocab)
        for batch in batches:
            if not batch.num_rows:
                continue
            data, bounds = texts(batch.column(1))
            block.take(batch.column(0), data, bounds)
            if block.bytes >= BLOCK_BYTES:
                yield from block.parts(parts)
                n += 1
                block = Block(f"{partition}-{n}", vocab)
        yield from block.parts(parts)

    return run


PIECES = "block string, bucket int, pieces array<int>"


def count_pieces(definition: str, schema: pa.Schema):
    """Pieces of the pre-tokens of each row; buckets come one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(definition)
        known: dict[bytes, int] = {}
        bucket = None
        for batch in batches:
            columns = batch.to_pydict()
            counted = []
            for b, pretokens_ in zip(columns["bucket"], columns["pretokens"]):
                if b != bucket or len(known) > REMEMBERED:
                    bucket, known = b, {}
                for p in pretokens_:
                    if p not in known:
                        known[p] = vocab.pieces(p)
                counted.append([known[p] for p in pretokens_])
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("bucket"), pa.array(counted, pa.list_(pa.int32()))], schema=schema
            )

    return run


def add_up(schema: pa.Schema):
    """Tokens of every document; the counts of a block come before its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pieces, counted = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                if row["block"].as_py() != block:
                    block, pieces, counted = row["block"].as_py(), [], None
                if row["pieces"].is_valid:
                    pieces.append(row["pieces"].values.to_numpy())
                    continue
                if counted is None:
                    counted = np.concatenate([*pieces, np.zeros(0, dtype=np.int32)]).astype(np.int64)
                entries = row["entries"].values.to_numpy().astype(np.int64)
                numbers, counts = unpacked(entries, row["frequencies"].as_py())
                sums = np.concatenate([[0], np.cumsum(counted[numbers] * counts)])
                ends = np.cumsum(entries)
                tokens = sums[ends] - sums[ends - entries] + row["base"].values.to_numpy()
                columns = [row["ids"].values, row["n_bytes"].values, pa.array(tokens)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def count_tokens(documents: DataFrame, definition: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens`` of every row; ``definition`` is the content of a tokenizer file."""
    check(json.loads(definition))
    ship(documents.sparkSession)
    named = documents.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    id_type = named.schema["id"].dataType.simpleString()
    layout = PARTS.format(id=id_type)
    parts = written(streamed(named, count_frequencies(definition, arrow_schema(named, layout)), layout), "pretokens")

    pretokens_ = parts.filter("pretokens IS NOT NULL").select("block", "bucket", "pretokens")
    by_bucket = pretokens_.repartition("bucket").sortWithinPartitions("bucket")
    pieces = streamed(by_bucket, count_pieces(definition, arrow_schema(named, PIECES)), PIECES)

    frequencies_ = parts.filter("frequencies IS NOT NULL").select("block", "ids", "n_bytes", "base", "entries", "frequencies")
    together = frequencies_.unionByName(pieces, allowMissingColumns=True)
    by_block = together.repartition("block").sortWithinPartitions("block", F.col("pieces").isNull(), "bucket")
    layout = f"id {id_type}, n_bytes bigint, n_tokens bigint"
    return streamed(by_block, add_up(arrow_schema(named, layout)), layout)


def arrow_schema(df: DataFrame, layout: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(layout))


def query(spark: SparkSession, sf_dir: str, name: str = "byte_bpe_50k.json") -> DataFrame:
    """Token counts of all documents by the named file of the public tokenizers."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        definition = file.read()
    counted = count_tokens(table(spark, sf_dir, "documents"), definition)
    return counted.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit")
    )
