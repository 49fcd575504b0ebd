import base64
import hashlib

import pytest

from tablelab.llm import warc
from tablelab.session import scratch_dir

ROWS = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (3, None, "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (4, "http://a/\r\nX: y", ""),
    (5, "http://a/5", None),
    (6, "http://a/6", "é" * 50_000),
    (None, "http://a/7", "<p>one</p>"),
    (9, "http://a/9", "<p>one</p>"),
    (9, "http://a/9", "<p>one</p>"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def archive(spark):
    pages = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, payload string, digest int")
    path = scratch_dir(spark, "warc-test")
    warc.write_warc(warc.plan_records(pages), path, records_per_file=2)
    return path


def test_records_read_back_as_written(spark, archive):
    back = {(r["record_id"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_warc(spark, archive).collect()}
    last = {digest("<p>one</p>"): 9, digest(""): 5, digest(ROWS[2][2]): 3, digest(ROWS[5][2]): 6}
    want = set()
    for i, _, html in ROWS:
        d = digest(html)
        own = last[d] == i
        want.add((None if i is None else str(i), d, "response" if own else "revisit", None if own else str(last[d])))
    assert back == want
    assert warc.read_warc(spark, archive).count() == len(ROWS)


def test_payloads_are_stored_once_and_restored_everywhere(spark, archive):
    records = warc.read_warc(spark, archive)
    store = warc.payload_store(records)
    assert store.count() == len({r[2] or "" for r in ROWS})
    full = warc.restore(records).collect()
    by_id = {r[0]: (r[2] or "").encode() for r in ROWS}
    assert all(bytes(r["payload"]) == by_id[int(r["record_id"]) if r["record_id"] else None] for r in full)
    assert all(r["payload_bytes"] == len(bytes(r["payload"])) for r in full)


def test_original_records_have_their_exact_headers(spark, archive):
    written = b"".join(warc.gunzip(bytes(r["content"])) for r in spark.read.format("binaryFile").load(archive + "/*/part-*").collect())
    records = warc.read_warc(spark, archive)
    for r in warc.original_record(warc.restore(records)).collect():
        assert r["header"].encode() in written
        if r["record_type"] == "response":
            assert bytes(r["record"]) in written
        else:
            assert bytes(r["record"]).endswith(bytes(r["payload"]) + b"\r\n\r\n")


def test_a_url_cannot_add_headers(spark, archive):
    got = [r["target_uri"] for r in warc.read_warc(spark, archive).collect() if r["record_id"] == "4"]
    assert got == ["http://a/%0D%0AX: y"]


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    planned = warc.plan_records(pages, min_revisit_bytes=3)
    assert [r["refers_to"] for r in planned.collect()] == [None, None]


def test_changed_bytes_raise():
    head = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc.parse_warc((head + "ab").encode()))
    with pytest.raises(ValueError):
        list(warc.parse_warc(b"nothing of the kind"))


def test_wrong_digest_raises(spark):
    pages = spark.createDataFrame([(1, "u", "ab")], "page_id long, url string, html string")
    path = scratch_dir(spark, "warc-wrong")
    from pyspark.sql import functions as F

    warc.write_warc(warc.plan_records(pages).withColumn("digest", F.lit("A" * 32)), path)
    with pytest.raises(Exception, match="digest differs"):
        warc.read_warc(spark, path).collect()


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_dir(spark, "warc-empty")
    warc.write_warc(warc.plan_records(pages), path)
    assert warc.restore(warc.read_warc(spark, path)).count() == 0


def test_two_payloads_under_one_sha1_stay_apart(spark):
    # The same SHA-1 for both, as if they collided; the store goes by SHA-256.
    schema = "record_id string, record_type string, payload_digest string, store_key string, payload_bytes long, header string, payload binary"
    keys = [hashlib.sha256(x).hexdigest() for x in (b"one", b"two")]
    rows = [("1", "response", "S", keys[0], 3, "h", b"one"), ("2", "response", "S", keys[1], 3, "h", b"two"),
            ("3", "revisit", "S", keys[0], None, "h", None), ("4", "revisit", "S", keys[1], None, "h", None), ("5", "revisit", "S", "gone", None, "h", None)]
    records = spark.createDataFrame(rows, schema)
    got = {r["record_id"]: r["payload"] and bytes(r["payload"]) for r in warc.restore(records).collect()}
    assert got == {"1": b"one", "2": b"two", "3": b"one", "4": b"two", "5": None}
    assert warc.payload_store(records).count() == 2


def test_files_are_cut_by_bytes(spark):
    pages = spark.range(60).selectExpr("id as page_id", "'u' as url", "concat(id, repeat('x', if(id % 10 = 0, 5000, 40))) as html").coalesce(1)
    path = scratch_dir(spark, "warc-bytes")
    warc.write_warc(warc.plan_records(pages), path, records_per_file=20, file_bytes=8000)
    held = [warc.gunzip(bytes(r["content"])) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect()]
    sizes = [[len(body) for _, _, body in warc.parse_warc(x)] for x in held]
    assert all(sum(x) <= 8000 or len(x) == 1 for x in sizes) and sum(map(len, sizes)) == 60
    assert warc.restore(warc.read_warc(spark, path)).count() == 60
