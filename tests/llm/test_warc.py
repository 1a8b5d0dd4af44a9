import base64
import hashlib
import os
import random
import tempfile
import zlib

import pytest
from pyspark.sql import functions as F

from lakestrata.llm.warc import GZIP, MAGIC, member, page_records, read_warc, write_warc
from tests.conftest import rows

PAGES = "page_id long, url string, html string"
AWKWARD = [
    (3, "http://a/1", "<p>same</p>"), (1, "http://a/2?x=ü \r\nWARC-Type: no", "<p>same</p>"), (2, None, "<p>same</p>"),
    (None, "http://n", "<p>same</p>"), (7, "u", None), (5, "u", ""), (9, "", "x"), (9, "", "x"), (9, "other", "x"),
    (11, "u", "ß日本\x00\x1f\U0001f600" * 50), (12, "u", "long " * 400_000), (None, None, None), (-4, "u", "\r\n\r\nWARC/1.0\r\n"),
    (None, "u", "nobody"), (None, "v", "nobody"),
]


def folder():
    return "file:" + tempfile.mkdtemp(prefix="ls-warc-") + "/archive"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def plain(pages, least_bytes=0):
    """The contract, one page after the other."""
    order = sorted(pages, key=lambda p: (p[0] is None, p[0] or 0))
    seen, out = {}, []
    for page_id, _, html in order:
        data = (html or "").encode()
        again = len(data) >= least_bytes and data in seen
        out.append((page_id, len(data), digest(html), "revisit" if again else "response", seen[data] if again else None))
        seen.setdefault(data, page_id)
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))


@pytest.mark.parametrize("least_bytes", [0, 5])
@pytest.mark.parametrize("split", ["128m", "700"])
def test_round_trip(spark, split, least_bytes):
    path, before = folder(), spark.conf.get("spark.sql.files.maxPartitionBytes")
    pages = spark.createDataFrame(AWKWARD, PAGES).withColumn("record_type", F.lit("clash")).withColumn("a.b", F.lit(1))
    write_warc(pages, path, least_bytes)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        records = read_warc(spark, path, payloads=True)
        assert rows(page_records(records)) == plain(AWKWARD, least_bytes)
        got = {r.payload.decode() for r in records.collect() if r.record_type == "response"}
        assert got == {h or "" for _, _, h in AWKWARD}
        assert {r.target_uri for r in records.collect()} == {u for _, u, _ in AWKWARD}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_table(spark):
    path = folder()
    write_warc(spark.createDataFrame([], PAGES), path)
    assert page_records(read_warc(spark, path)).collect() == []


def test_files_are_gzip_members_any_reader_takes(spark):
    path = folder()
    write_warc(spark.createDataFrame(AWKWARD, PAGES).coalesce(1), path)
    found = 0
    for name in os.listdir(path.removeprefix("file:")):
        if name.startswith("part-"):
            data = open(f"{path.removeprefix('file:')}/{name}", "rb").read()
            while data:
                z = zlib.decompressobj(GZIP)
                text = z.decompress(data)
                assert z.eof and text.startswith(b"WARC/1.0\r\n")
                data, found = z.unused_data, found + 1
    assert found == len(AWKWARD)


def resource(k, payload):
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <r:{k}>\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


@pytest.mark.parametrize("seed", range(2))
def test_chance_magic_and_any_split(spark, seed):
    """Stored members full of magics, empty members and members of several records, cut at many places."""
    rng = random.Random(seed)
    payloads, data = [], b""
    for _ in range(30):
        parts = []
        for _ in range(rng.choice([1, 1, 3])):
            body = b"".join(rng.choice([MAGIC, MAGIC + b"\x00" * 7, b"\x1f\x8b", rng.randbytes(rng.randrange(90))])
                            for _ in range(rng.randrange(40)))
            parts.append(resource(len(payloads), body))
            payloads.append(body)
        data += member(b"".join(parts), level=rng.choice([0, 0, 6])) + rng.choice([b"", member(b"")])
    path = tempfile.mkdtemp(prefix="ls-warc-")
    open(f"{path}/a.warc", "wb").write(data)
    open(f"{path}/b.warc", "wb").write(member(resource(0, b"second file")))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    want = sorted([(f"<r:{k}>", p) for k, p in enumerate(payloads)] + [("<r:0>", b"second file")])
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for split in (400, 1000, len(data) + 1):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            got = sorted((r.record_id, bytes(r.payload)) for r in read_warc(spark, "file:" + path, True).collect())
            assert got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


@pytest.mark.parametrize("data", [b"text", member(b"no warc"), member(resource(1, b"x" * 500))[:-20],
                                  member(resource(1, b"x"))[:-6] + b"??????",
                                  member(resource(1, b"x").replace(b"Content-Length: 1", b"Content-Length: 99"))])
def test_damage_fails(spark, data):
    path = tempfile.mkdtemp(prefix="ls-warc-")
    open(f"{path}/a.warc", "wb").write(data)
    with pytest.raises(Exception, match="member|record|header"):
        read_warc(spark, "file:" + path).collect()
