"""WARC archives with revisit records for payloads that occur before.

Headers (digest, length, page) are shuffled by payload digest to find the
response of each payload; payloads are moved once, by row, so that a payload
which a third of all pages share does not meet in one task. Archives are
written by Spark's own text writer: a record is one value and the two line
ends after it are the separator, so files go wherever Spark can write. They
are read as binary files and parsed record by record, each by the length its
header states.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import stored, with_row

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"

HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 4096

_READ = (
    "record_id string, record_type string, page_id long, uri string, refers_to_id string,"
    " payload_digest string, payload_bytes long, digest_matches boolean, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, 20 bits at a time."""
    bits = lambda g: F.conv(F.substring(F.sha1(payload), g * 5 + 1, F.lit(5)), 16, 10).cast("int")
    chars = lambda n: F.concat(
        *(
            F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(F.lit(31)) + 1, F.lit(1))
            for s in (15, 10, 5, 0)
        )
    )
    return F.concat(*(chars(bits(F.lit(g))) for g in range(8)))


def resolve_revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Record type and response of each header row.

    ``headers`` has row, page_id, payload_bytes and payload_key, equal exactly
    for equal payloads. Of equal payloads of at least ``min_bytes`` the largest
    page id is the response (null ids come last; of rows that repeat an id the
    last in the table) and the others revisit it. Adds record_type,
    response_row and response_page.
    """
    best = headers.groupBy("payload_key", "payload_bytes").agg(
        F.max(F.struct("page_id", "row")).alias("best")
    )
    # Stored first, so that the join has two plain sides and a hot payload can be split.
    joined = headers.join(stored(best, "warc-best"), ["payload_key", "payload_bytes"])
    response = (F.col("payload_bytes") < min_bytes) | (F.col("row") == F.col("best.row"))
    return joined.select(
        *headers.columns,
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("best.row")).alias("response_row"),
        F.when(~response, F.col("best.page_id")).alias("response_page"),
    )


def _record_id(row: Column) -> Column:
    digest = F.md5(F.concat(F.lit("record-"), row.cast("string")).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, empty if there is no value; controls and blanks are escaped."""
    safe = value.cast("string")
    for code in (0, 9, 10, 13, 32, 127):
        safe = F.replace(safe, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: str = DATE,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write one record per page: a response with its payload, or a revisit without.

    A null payload counts as empty; a null url or id leaves out its line. The
    payload column may be text (written as UTF-8) or binary. ``pages`` must
    read a stored table. Extra columns are ignored.
    """
    rows = with_row(
        pages.select(
            F.col(id_col).alias("page_id"),
            F.col(url_col).alias("url"),
            F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
        )
    )
    headers = rows.select(
        "row",
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.unhex(F.sha2("payload", 256)).alias("payload_key"),
    )
    resolved = stored(
        resolve_revisits(stored(headers, "warc-headers"), min_bytes).drop("page_id", "payload_key"),
        "warc-resolved",
    )
    records = rows.join(resolved, "row")
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit(b"")).otherwise(
        F.concat(F.lit(HTTP_HEAD.encode()), F.col("payload"))
    )
    head = F.concat(
        F.lit(VERSION + CRLF),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", _record_id(F.col("row"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("X-Page-ID", F.col("page_id")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        _field("WARC-Refers-To", F.when(revisit, _record_id(F.col("response_row")))),
        _field("Content-Type", F.lit("application/http;msgtype=response").cast("string")),
        _field("Content-Length", F.octet_length("body")),
        F.lit(CRLF),
    )
    record = records.withColumn("body", body).select(
        F.concat(head.cast("binary"), F.col("body")).cast("string").alias("value")
    )
    record.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def _records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of one uncompressed stream."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields["content-length"]))


class _Inflated(io.RawIOBase):
    """Any number of gzip members after one another, inflated as they are read."""

    def __init__(self, content: bytes):
        self.left, self.inflate = content, zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            data = self.inflate.decompress(self.left, len(buffer))
            self.left = self.inflate.unconsumed_tail
            if data:
                buffer[: len(data)] = data
                return len(data)
            if self.inflate.eof and self.inflate.unused_data:
                self.left, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            elif not self.left:
                return 0


def _parsed(batches: Iterator[pa.RecordBatch], with_payload: bool, at_once: int = 1 << 24):
    schema = pa.schema(
        [
            ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
            ("uri", pa.string()), ("refers_to_id", pa.string()), ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()), ("digest_matches", pa.bool_()), ("payload", pa.binary()),
        ]
    )
    rows, held = [], 0
    for batch in batches:
        for content in batch.column(0):
            raw = content.as_py()
            zipped = raw[:2] == b"\x1f\x8b"
            stream = io.BufferedReader(_Inflated(raw), 1 << 16) if zipped else io.BytesIO(raw)
            for fields, block in _records(stream):
                response = fields["warc-type"] == "response"
                payload = block.partition(b"\r\n\r\n")[2] if response else b""
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                page = fields.get("x-page-id")
                rows.append(
                    (
                        fields["warc-record-id"], fields["warc-type"],
                        None if page is None else int(page), fields.get("warc-target-uri"),
                        fields.get("warc-refers-to"), found if response else digest,
                        len(payload) if response else None,
                        found == digest if response else None,
                        payload if with_payload and response else None,
                    )
                )
                held += len(payload) if with_payload else 200
                if held > at_once:
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(schema.names, r, strict=True)) for r in rows], schema
                    )
                    rows, held = [], 0
    yield pa.RecordBatch.from_pylist(
        [dict(zip(schema.names, r, strict=True)) for r in rows], schema
    )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives under ``path``, gzipped or not.

    A response's digest and length are computed from its payload, and compared
    with the digest in its header. A revisit has its header's digest.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(lambda b: _parsed(b, with_payload), _READ)


def resolved_records(records: DataFrame) -> DataFrame:
    """Records with revisits joined to their responses, which give length and page."""
    # Stored first, or both sides of the join would read and hash all archives.
    records = stored(records.drop("payload"), "warc-records")
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"),
        F.col("page_id").alias("response_page"),
        F.col("payload_bytes").alias("response_bytes"),
    )
    return records.join(responses, "refers_to_id", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "response_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.col("response_page").alias("refers_to"),
        "uri",
        "digest_matches",
    )
