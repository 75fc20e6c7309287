"""WARC archives: write captures, read archives back, and assemble transactions.

A capture is three records: the ``request``, the ``response`` (or a ``revisit`` which points at
the response with the same payload) and the ``metadata``. The last two name the request in
``WARC-Concurrent-To``; reading joins the records through these identifiers again and emits one
nested row per capture.

Defined results: a null html is an empty payload; a null url has an empty target; a null id never
becomes the response of a group that has ids. Rows equal in id, url and html are one capture that
is archived as often as it occurs (``copies``): identifiers are made from the content, so a re-run
task writes the same records. Further columns of the pages are ignored. An empty table gives an
empty archive and no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import streamed, table
from lakestrata.session import new_shared_path

#: Records of one archive file; a reader holds one compressed file and one record of it.
FILE_RECORDS = 6000
#: Longest record header this reader accepts.
HEADER_LIMIT = 1 << 20

CRLF = "\r\n"
END = "\r\n\r\n"

RECORDS = (
    "record_id string, concurrent_to string, record_type string, target string, refers_to string, "
    "payload_digest string, payload binary"
)


# Digits of numbers to base 32 as Spark writes them, and the characters of RFC 4648 for them.
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """Base32 of a SHA-1 given in hexadecimal digits: 10 digits of 4 bits are 8 of 5 bits."""
    groups = [F.lpad(F.conv(F.substring(hexadecimal, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), BASE32_DIGITS, BASE32_CHARACTERS)


def with_payload(pages: DataFrame) -> DataFrame:
    """``id, target, payload`` with the payload's size and digest."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").alias("id"),
        F.coalesce(F.col("url"), F.lit("")).alias("target"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.sha1(payload).alias("sha1"),
    )


def responses(captures: DataFrame, least_bytes: int) -> DataFrame:
    """Per payload which more than one capture has, the id which stays a response."""
    return (
        captures.filter(F.col("bytes") >= least_bytes)
        .groupBy("sha1", "bytes")
        .agg(F.max("id").alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .drop("copies")
    )


def capture_name() -> Column:
    """A name made from the capture, so that a re-run task names it the same."""
    identity = F.coalesce(F.col("id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws("/", identity, F.col("sha1"), F.col("target")).cast("binary"))


def record_id(kind: str) -> Column:
    return F.concat(F.lit("<urn:md5:"), F.col("name"), F.lit(f":{kind}>"))


def line(name: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def record(headers: list[Column], block: Column) -> Column:
    """Header and block; what ends the record is the writer's separator."""
    length = line("Content-Length", F.octet_length(block))
    return F.concat(F.concat(F.lit("WARC/1.1" + CRLF), *headers, length, F.lit(CRLF)).cast("binary"), block)


def clean(value: Column) -> Column:
    """A header value must stay on its line."""
    return F.regexp_replace(value, r"[\r\n]+", " ")


def write(pages: DataFrame, path: str, least_bytes: int = 0, file_records: int = FILE_RECORDS) -> None:
    """Write one capture per row of ``pages`` (``page_id, url, html``) below ``path``.

    Of captures with equal payloads of at least ``least_bytes`` bytes the one with the largest id
    is the response and the others revisit it; a revisit has the digest of the full payload and
    ends after its HTTP header. Copies are counted by partial aggregation and joined by payload;
    a payload which a third of all pages share makes a skewed side that AQE splits, and the other
    side has one row per payload.
    """
    captures = with_payload(pages)
    each = (
        captures.join(responses(captures, least_bytes), ["sha1", "bytes"], "left")
        .withColumn("name", capture_name())
        .withColumn("digest", base32(F.col("sha1")))
        .withColumn("target", clean(F.col("target")))
    )
    is_response = F.col("first_id").isNull() | F.col("id").eqNullSafe(F.col("first_id"))
    kind = F.when(is_response, "response").otherwise("revisit")
    digest, target = F.concat(F.lit("sha1:"), F.col("digest")), F.col("target")
    request, main, metadata = record_id("request"), record_id("main"), record_id("metadata")
    date = line("WARC-Date", "1970-01-01T00:00:00Z")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF),
        line("Content-Length", F.col("bytes")),
        F.lit(CRLF),
    ).cast("binary")
    asked = F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1" + END)).cast("binary")
    revisit = F.when(
        kind == "revisit",
        F.concat(
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">"))),
            line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ),
    ).otherwise("")
    rows = F.array(
        record(
            [line("WARC-Type", "request"), line("WARC-Record-ID", request), date, line("WARC-Target-URI", target),
             line("Content-Type", "application/http; msgtype=request")],
            asked,
        ),
        record(
            [line("WARC-Type", kind), line("WARC-Record-ID", main), date, line("WARC-Target-URI", target),
             line("WARC-Concurrent-To", request), line("WARC-Payload-Digest", digest), revisit,
             line("Content-Type", "application/http; msgtype=response")],
            F.when(kind == "revisit", http).otherwise(F.concat(http, F.col("payload"))),
        ),
        record(
            [line("WARC-Type", "metadata"), line("WARC-Record-ID", metadata), date, line("WARC-Target-URI", target),
             line("WARC-Concurrent-To", request), line("Content-Type", "application/warc-fields")],
            F.concat(line("page-id", F.coalesce(F.col("id").cast("string"), F.lit(""))),
                     line("payload-length", F.col("bytes"))).cast("binary"),
        ),
    )
    # The text writer writes the bytes of each row as they are, then the separator; a WARC
    # record ends with two line ends, so rows and separators are exactly an archive.
    (
        each.select(F.explode(rows).alias("value"))
        .select(F.col("value").cast("string"))
        .write.mode("append")
        .option("lineSep", END)
        .option("maxRecordsPerFile", file_records)
        .option("compression", "gzip")
        .text(path)
    )


_LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*(\d+)", re.IGNORECASE)


def inflated(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Pieces of an archive; a gzip archive is a row of members, one per record or one for all."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    member = zlib.decompressobj(wbits=31)
    for at in range(0, len(data), step):
        piece = data[at : at + step]
        while piece:
            yield member.decompress(piece)
            piece = member.unused_data
            if member.eof:
                member = zlib.decompressobj(wbits=31)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of an archive.

    The length field alone says where a block ends, so a block may contain anything.
    """
    source, held = inflated(data), bytearray()

    def grow() -> bool:
        piece = next(source, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        while (stop := held.find(b"\r\n\r\n", held.find(b"WARC/") if b"WARC/" in held else len(held))) < 0:
            if len(held) > HEADER_LIMIT or not grow():
                if held.strip():
                    raise ValueError("an archive does not end with a whole record")
                return
        header = bytes(held[held.find(b"WARC/") : stop])
        length = _LENGTH.search(header)
        if length is None:
            raise ValueError(f"a record header without a length: {header[:200]!r}")
        end = stop + 4 + int(length[1])
        while len(held) < end:
            if not grow():
                raise ValueError(f"a record is cut off: {header[:200]!r}")
        lines = header.decode("utf-8", "replace").split(CRLF)[1:]
        fields = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
        yield fields, bytes(held[stop + 4 : end])
        del held[:end]


_READ = pa.schema([
    ("record_id", pa.string()), ("concurrent_to", pa.string()), ("record_type", pa.string()),
    ("target", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()),
    ("payload", pa.binary()),
])


def _records(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Records of archive files in batches of about ``most`` bytes."""
    rows: list[tuple] = []

    def packed() -> pa.RecordBatch:
        columns = [pa.array(column, field.type) for column, field in zip(zip(*rows), _READ)]
        return pa.RecordBatch.from_arrays(columns, schema=_READ)

    held = 0
    for batch in batches:
        for content in batch.column(0):
            for fields, block in parsed(content.as_py()):
                kind = fields.get("warc-type")
                http = kind in ("request", "response", "revisit")
                names = ("record-id", "concurrent-to", "type", "target-uri", "refers-to", "payload-digest")
                payload = block.partition(b"\r\n\r\n")[2] if http else block
                rows.append((*(fields.get(f"warc-{name}") for name in names), payload))
                held += len(payload) + 500
                if held > most:
                    yield packed()
                    rows, held = [], 0
    if rows:
        yield packed()


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``: identifiers, type, digest, payload.

    A task holds the compressed archives of its split and one record at a time.
    """
    archives = spark.read.format("binaryFile").load(path).select("content")
    return streamed(archives, _records, RECORDS)


def transactions(records: DataFrame) -> DataFrame:
    """One row per capture: ``request``, ``main`` (response or revisit) and ``metadata`` structs
    with the columns of the records, and ``copies``, how often the capture was archived.

    Records of a capture meet under the identifier of their request: the record they are
    concurrent to, or their own where they name none. Parts which are missing are null.
    """
    part = F.struct(*records.columns)
    kind = F.col("record_type")

    def of(name: str, *kinds: str) -> Column:
        own = kind.isin(*kinds)
        return F.max_by(F.when(own, part), F.when(own, F.col("record_id"))).alias(name)

    return (
        records.filter(kind.isin("request", "response", "revisit", "metadata"))
        .groupBy(F.coalesce("concurrent_to", "record_id").alias("capture"))
        .agg(
            of("request", "request"), of("main", "response", "revisit"), of("metadata", "metadata"),
            F.greatest(
                F.count_if(kind == "request"), F.count_if(kind.isin("response", "revisit")), F.count_if(kind == "metadata")
            ).alias("copies"),
        )
    )


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: archive all pages, read the archives back, one row per page.

    Size and digest of a response are those of the payload as read; a revisit has its size from
    its metadata record and its digest from its header. Payloads are reduced to both before
    the records are joined.
    """
    path = new_shared_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    payload, kind = F.col("payload"), F.col("record_type")
    records = read(spark, path).select(
        "record_id", "concurrent_to", "record_type", "refers_to", "payload_digest",
        F.when(kind == "response", F.octet_length(payload).cast("long")).alias("read_bytes"),
        F.when(kind == "response", base32(F.sha1(payload))).alias("read_digest"),
        F.when(kind == "metadata", payload.cast("string")).alias("note"),
    )
    found = transactions(records).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    number = lambda text, pattern: F.expr(f"try_cast(regexp_extract({text}, '{pattern}', 1) AS BIGINT)")
    return found.select(
        number("metadata.note", "page-id: (-?[0-9]*)").alias("page_id"),
        F.coalesce("main.read_bytes", number("metadata.note", "payload-length: ([0-9]+)")).alias("payload_bytes"),
        F.coalesce("main.read_digest", F.substring_index("main.payload_digest", ":", -1)).alias("payload_digest"),
        F.col("main.record_type").alias("record_type"),
        number("main.refers_to", "<urn:page:(-?[0-9]+)>").alias("refers_to"),
    )


# Digests in base32 are not in the SQL of the other engine; its hexadecimal SHA-1 is cut in
# groups of five bits.
CAPTURES_SQL = """
WITH sized AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
    FROM pages
), bits AS (
    SELECT *, list_reduce(list_transform(range(1, 41), lambda i:
        lpad(bin(instr('0123456789abcdef', hex[i]) - 1), 4, '0')), lambda a, b: a || b) AS digits
    FROM sized
), named AS (
    SELECT page_id, payload_bytes, hex, list_reduce(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            (list_sum(list_transform(range(0, 5), lambda j: CASE WHEN digits[i * 5 + j + 1] = '1' THEN 2 ** (4 - j) ELSE 0 END)) + 1)::BIGINT, 1)),
        lambda a, b: a || b) AS payload_digest
    FROM bits
), grouped AS (
    SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS first_id FROM named
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM grouped
"""
