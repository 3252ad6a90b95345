"""WARC archives: round trips, byte ranges of every size, damaged and foreign files, and odd input."""

import base64
import gzip
import hashlib
import io
import random
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.compare import differences, oracle_connection
from curbflow.llm import warc
from curbflow.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, sha1 string, bytes int, first long, rows int, key string, body string, refers_to int"


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, 3, "k", "b", 4) for row in rows], SCHEMA)


def digest(body):
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def brute(rows):
    """key, bytes, digest, type, refers_to of every row."""
    largest = {}
    for key, _, html in rows:
        body = (html or "").encode()
        if key is not None:
            largest[body] = max(key, largest.get(body, key))
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        first = largest.get(body)
        revisit = first is not None and key != first
        out.append((key, len(body), digest(body), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def read(spark, path, **more):
    records = warc.read_warc(spark, path, **more).filter("record_type <> 'warcinfo'")
    found = records.select(warc.key_of("record_id"), "payload_bytes", "payload_digest", "record_type", warc.key_of("refers_to"))
    return sorted(map(tuple, found.collect()), key=repr)


ROWS = [
    (None, None, None),
    (None, "http://a/", "same"),
    (1, "", ""),
    (2, None, "same"),
    (3, "http://a/ b\r\nWARC-Type: x\t\x7f", "Grüße\x00 \r\n\r\nWARC/1.1\r\n"),
    (4, "http://b/", None),
    (5, "http://b/", "same"),
    (5, "http://c/", "same"),
    (5, "http://c/", "same"),
    (-7, "http://d/", "a" * 3_000_000),
    (8, "http://é/", "".join(chr(33 + k * k % 90) for k in range(400_000))),
]


@pytest.mark.parametrize("split", [1 << 20, 997])
def test_round_trip_of_odd_input(spark, folder, split):
    warc.write_warc(table(spark, ROWS).repartition(3), f"{folder}/w")
    assert read(spark, f"{folder}/w", split_bytes=split) == brute(ROWS)
    records = warc.read_warc(spark, f"{folder}/w", split_bytes=split).filter("record_type = 'response'").collect()
    assert {bytes(r.payload) for r in records} == {(html or "").encode() for _, _, html in ROWS}
    assert all(r.digest_holds for r in records)
    urls = {warc_key: r.target_uri for r in records for warc_key in [r.record_id.split(":")[2]]}
    assert urls["3"] == "http://a/%20b%0D%0AWARC-Type:%20x%09%7F" and urls["8"] == "http://é/"
    assert {r.payload for r in warc.read_warc(spark, f"{folder}/w", payload=False).collect()} == {None}


def test_small_payloads_stay_responses(spark, folder):
    warc.write_warc(table(spark, ROWS), f"{folder}/w", least_bytes=5)
    found = read(spark, f"{folder}/w")
    assert all(kind == "response" for _, _, _, kind, _ in found)


def test_empty_table_and_second_write(spark, folder):
    warc.write_warc(table(spark, []), f"{folder}/w")
    assert read(spark, f"{folder}/w") == []
    warc.write_warc(table(spark, ROWS[:3]), f"{folder}/w")
    warc.write_warc(table(spark, ROWS[3:5]), f"{folder}/w")
    assert len(read(spark, f"{folder}/w")) == 5


def test_a_hot_payload(spark, folder):
    rows = [(k, "http://a/", "common" if k % 3 else f"page {k}") for k in range(3000)]
    warc.write_warc(table(spark, rows).repartition(8), f"{folder}/w")
    assert read(spark, f"{folder}/w", split_bytes=10_000) == brute(rows)


def test_failed_tasks_leave_no_file(spark, folder):
    broken = table(spark, [(1, "http://a/", "x")]).withColumn("html", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        warc.write_warc(broken, f"{folder}/w")
    assert not list(Path(folder).rglob("*.warc.gz"))


def archive(seed, n):
    rng = random.Random(seed)
    pages = [(k, f"http://h/{k}", rng.randbytes(rng.choice([0, 10, 3000, 70_000]))) for k in range(n)]
    members = [warc.member(warc.page_record(k, url, body, hashlib.sha1(body).hexdigest(), None, "2024-01-01T00:00:00Z")) for k, url, body in pages]
    return members


def owned(data, split):
    """Offsets found by ranges of the size, in order."""
    return [place for start in range(0, len(data), split) for place, _, _ in warc.records(_File(data), start, min(len(data), start + split))]


class _File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("split", [1, 2, 3, 7, 100, 4096, 1 << 20, 1 << 30])
def test_every_record_is_owned_once(monkeypatch, split):
    monkeypatch.setattr(warc, "PIECE", 5000)
    members = archive(1, 4 if split < 100 else 60)
    data, starts = b"".join(members), [0]
    for m in members[:-1]:
        starts.append(starts[-1] + len(m))
    if split < 100:
        data, starts = b"".join(members[:2]), starts[:2]
        monkeypatch.setattr(warc, "PIECE", 50)
    assert owned(data, split) == starts


def test_magic_inside_payloads_is_no_record():
    """Payloads that hold magic, whole members, and members of records, stored without compression."""
    inner = archive(2, 1)[0]
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    body = warc.MAGIC * 500 + gzip.compress(b"no record") + inner + warc.MAGIC
    record = warc.page_record(1, "http://a/", body, hashlib.sha1(body).hexdigest(), None, "2024-01-01T00:00:00Z")
    outer = stored.compress(record) + stored.flush()
    assert inner in outer
    members = [outer, *archive(3, 2), outer]
    data, starts = b"".join(members), [sum(map(len, members[:k])) for k in range(len(members))]
    for split in (500, 1000, 50_000, len(data)):
        assert owned(data, split) == starts


def test_damaged_members_are_skipped():
    members = archive(4, 6)
    cut = members[2][: len(members[2]) // 2]
    spoilt = bytearray(members[4])
    spoilt[-6] ^= 255  # the checksum
    data = b"".join([*members[:2], cut, members[3], bytes(spoilt), members[5], members[0][:20]])
    places = [0, len(members[0]), len(members[0]) + len(members[1]) + len(cut)]
    places.append(places[2] + len(members[3]) + len(spoilt))
    assert owned(data, 1 << 30) == owned(data, 5000) == places


def test_foreign_records(spark, folder):
    """Other header order and case, no digest, no HTTP, other kinds of records."""
    block = b"HTTP/1.0 200 OK\r\nX: 1\r\n\r\nhello"
    records = [
        b"WARC/1.0\r\ncontent-length:%d\r\nWARC-type:response\r\nwarc-record-id:<urn:uuid:1>\r\nContent-Type: application/http; msgtype=response\r\n\r\n%s\r\n\r\n" % (len(block), block),
        b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\nWARC-Payload-Digest: sha1:WRONG\r\n\r\nabc\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: revisit\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: broken\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: broken\r\n\r\nabc\r\n\r\n",
    ]
    with open(f"{folder}/x.warc.gz", "wb") as f:
        f.write(b"".join(gzip.compress(r) for r in records))
    rows = {r.record_type: r for r in warc.read_warc(spark, f"{folder}/x.warc.gz").collect()}
    assert set(rows) == {"response", "resource", "revisit"}
    response = rows["response"]
    assert (bytes(response.payload), response.digest_holds, response.payload_digest) == (b"hello", None, digest(b"hello"))
    assert bytes(rows["resource"].payload) == b"abc" and rows["resource"].digest_holds is False
    assert (rows["revisit"].payload_bytes, rows["revisit"].payload_digest, rows["revisit"].refers_to) == (None, None, None)


def test_query_equals_its_oracle(spark):
    answer = QUERIES["op11_warc"](spark, FOLDER).toPandas()
    assert not differences(answer, oracle_connection(FOLDER).execute(ORACLES["op11_warc"]).df())
