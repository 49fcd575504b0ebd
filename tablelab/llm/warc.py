"""Content-addressed WARC archive.

Payload bytes are stored once, under their SHA-256, in WARC ``response`` records; each
other capture of the same bytes is a ``revisit`` record of headers alone.  The SHA-1 that
WARC readers look for is written too, but nothing is found by it.  Reading parses the files
by their Content-Length, recomputes both digests from the bytes read and raises where one
differs, keeps each record's header block as it was written, and restores full records by
joining the revisits' headers with the payloads they refer to; responses have their own.

Files are written by Spark's text writer (so by its commit protocol, on any store):
one row per record, CR LF CR LF after each, which is WARC's own record end.  A file takes
no more than ``FILE_BYTES`` of payload, or one record: records are written by classes of
size, each with as many to a file as its largest allow.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelab.llm.common import col, fresh, settled

CRLF = "\r\n"
#: Fixed values of RFC 4648 (base 32).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_URN = "urn:x-record:"
DATE = "1970-01-01T00:00:00Z"
KEY_FIELD = "X-Payload-SHA256"
#: Payload bytes of a file at most, unless one record is larger; records of a file at most.
FILE_BYTES, RECORDS_PER_FILE = 256 << 20, 2000

READ_SCHEMA = (
    "file string, record_id string, record_type string, refers_to string, target_uri string, "
    "payload_digest string, store_key string, payload_bytes long, header string, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """Base-32 SHA-1 of binary data (20 bits, four letters, at a time)."""
    hexed = F.sha1(data)
    letters = []
    for i in range(8):
        five = F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [
            F.substring(F.lit(BASE32), F.shiftright(five, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)
        ]
    return F.when(data.isNotNull(), F.concat(*letters))


def plan_records(
    df: DataFrame,
    id_col: str = "page_id",
    payload_col: str = "html",
    uri_col: str | None = "url",
    min_revisit_bytes: int = 0,
) -> DataFrame:
    """``(id, uri, payload, digest, key, bytes, refers_to)`` per row: what is to be archived.

    ``key`` is the payload's SHA-256, by which equal payloads are found, ``digest`` its SHA-1.

    Of rows with equal payloads of ``min_revisit_bytes`` or more, that with the largest
    id (null is least) is the response, ``refers_to`` null; the others refer to its id.
    A null payload is empty.  Repeated rows with the response's own id are responses too.
    """
    payload = F.coalesce(col(payload_col).cast("binary"), F.lit(b""))
    rows = df.select(
        col(id_col).alias("id"),
        (col(uri_col).cast("string") if uri_col else F.lit(None).cast("string")).alias("uri"),
        payload.alias("payload"),
        base32_sha1(payload).alias("digest"),
        F.sha2(payload, 256).alias("key"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    # Only digests met more than once need the join.  Their table is written first: while
    # it is small it is broadcast, and the payloads aren't shuffled.
    shared = settled(
        rows.where(F.col("bytes") >= min_revisit_bytes)
        .groupBy("key")
        .agg(F.max("id").alias("response"), F.count("*").alias("n"))
        .where("n > 1")
        .select("key", "response"),
        "shared-payloads",
    )
    joined = rows.join(shared, "key", "left")
    revisit = (F.col("bytes") >= min_revisit_bytes) & F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    return joined.select("id", "uri", "payload", "digest", "key", "bytes", F.when(revisit, F.col("response")).alias("refers_to"))


def _one_line(value: Column) -> Column:
    """A header value: bytes that would end the line are percent-encoded."""
    for raw, code in (("%0D", "%250D"), ("%0A", "%250A"), ("\r", "%0D"), ("\n", "%0A")):
        value = F.replace(value, F.lit(raw), F.lit(code))
    return value


def write_warc(
    planned: DataFrame, path: str, date: str = DATE, records_per_file: int = RECORDS_PER_FILE, file_bytes: int = FILE_BYTES
) -> None:
    """Write the rows of ``plan_records`` as gzipped WARC files below ``path``, which must be new.

    One pass finds which classes of size there are: payloads of up to ``file_bytes`` by
    ``records_per_file`` bytes, then by powers of two.  Most archives have a few; each is one
    write.  All rows of the first class, where it is the only one, are one pass."""
    revisit = F.col("refers_to").isNotNull()

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    urn = lambda c: F.concat(F.lit(f"<{RECORD_URN}"), F.coalesce(_one_line(c.cast("string")), F.lit("")), F.lit(">"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", _one_line(F.col("uri"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line(KEY_FIELD, F.col("key")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", urn(F.col("refers_to"))),
            ),
        ).otherwise(line("Content-Type", F.lit("text/html; charset=utf-8"))),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(CRLF),
    )
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(header.cast("binary"), body).cast("string")
    limit = max(1, file_bytes // records_per_file)
    size = F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    kind = F.when(size <= limit, F.lit(0)).otherwise(F.ceil(F.log2(size / limit))).cast("int")
    classes = sorted(r[0] for r in planned.select(kind.alias("k")).distinct().collect()) or [0]
    for k in classes:
        rows = planned if classes == [k] else planned.where(kind == k)
        (
            rows.select(record.alias("value"))
            .write.option("lineSep", CRLF * 2)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", max(1, records_per_file >> k))
            .mode("errorifexists")
            .text(f"{path}/size-{k}")
        )


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], str, bytes]]:
    """``(fields by lower-case name, header block as written, content)`` of each record."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        header = data[at : end + 4].decode("utf-8")
        fields = {}
        for one in header.split(CRLF)[1:]:
            name, _, value = one.partition(":")
            if name:
                fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        content = data[end + 4 : end + 4 + length]
        at = end + 4 + length
        if len(content) != length or data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record ends early")
        at += 4
        yield fields, header, content


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all WARC files (plain or gzipped) below ``path``: ``READ_SCHEMA``.

    Digests are of the content read; one that isn't the recorded digest raises.
    ``payloads=False`` leaves the bytes out.  Revisits have the digest they were
    recorded under, and null bytes.  A folder without files gives no rows.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        urn = lambda x: None if x is None else x.removeprefix("<").removesuffix(">").removeprefix(RECORD_URN) or None
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                data = content.as_buffer().to_pybytes()
                if data[:2] == b"\x1f\x8b":
                    data = gunzip(data)
                rows, held = [], 0
                for fields, header, body in parse_warc(data):
                    kind, told = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    store_key = fields.get(KEY_FIELD.lower())
                    if kind != "revisit":
                        found = base64.b32encode(hashlib.sha1(body).digest()).decode(), hashlib.sha256(body).hexdigest()
                        if told not in (None, found[0]) or store_key not in (None, found[1]):
                            raise ValueError(f"digest differs: {fields.get('warc-record-id')} in {name}")
                        told, store_key = found
                    real = None if kind == "revisit" else body
                    rows.append(
                        (
                            name.as_py(), urn(fields.get("warc-record-id")), kind, urn(fields.get("warc-refers-to")),
                            fields.get("warc-target-uri"), told, store_key, None if real is None else len(body), header,
                            real if payloads else None,
                        )
                    )
                    held += len(body) * payloads + len(header)
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(parse, READ_SCHEMA)


def gunzip(data: bytes) -> bytes:
    """All members of a gzip file, one after another."""
    out = []
    while data:
        member = zlib.decompressobj(31)
        out += [member.decompress(data), member.flush()]
        data = member.unused_data
    return b"".join(out)


_ARROW = pa.schema(
    [(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (x.split() for x in READ_SCHEMA.split(", "))]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW
    )


def payload_store(records: DataFrame) -> DataFrame:
    """``(store_key, payload_digest, payload_bytes, payload)``, each payload once, by its SHA-256.

    Repeated copies are merged by partial aggregation, so a payload met everywhere is not
    gathered."""
    return records.where("record_type != 'revisit'").groupBy("store_key").agg(
        F.first("payload_digest").alias("payload_digest"), F.first("payload_bytes").alias("payload_bytes"), F.first("payload").alias("payload")
    )


def restore(records: DataFrame) -> DataFrame:
    """Every record, revisits too, with its full payload and length.

    Responses have their own; only payloads that a revisit refers to are joined, so the rest
    isn't shuffled.  A revisit is one of the payload under its ``store_key``, and where a
    foreign archive has none, under its SHA-1.  A revisit whose payload is in no file
    keeps null bytes."""
    headers = records.where("record_type = 'revisit'").drop("payload", "payload_bytes")
    named = F.coalesce("store_key", "payload_digest")
    wanted = settled(headers.select(named.alias("wanted")).distinct(), "revisited")
    # Which names a payload answers to; few revisits are of foreign archives.
    names = F.array_distinct(F.array(F.col("store_key"), F.col("payload_digest")))
    held = records.where("record_type != 'revisit'").select("store_key", "payload_bytes", "payload", F.explode(names).alias("wanted"))
    held = held.join(wanted, "wanted", "left_semi").groupBy("wanted").agg(
        F.first("payload_bytes").alias("payload_bytes"), F.first("payload").alias("payload")
    )
    again = headers.join(held, named == F.col("wanted"), "left").drop("wanted")
    return records.where("record_type != 'revisit'").unionByName(again)


def original_record(restored: DataFrame, out_col: str = "record") -> DataFrame:
    """The exact bytes of each record as first captured: header block, payload, record end.

    A revisit's header block is its own; its payload is the response's.
    """
    out_col = fresh(restored, out_col)[0]
    return restored.withColumn(
        out_col, F.concat(F.col("header").cast("binary"), F.coalesce("payload", F.lit(b"")), F.lit(CRLF.encode() * 2))
    )
