"""WARC archives: exact round trips over any byte ranges, false magics, odd rows."""

import gzip
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import skew, warc

PAGES = "page_id long, url string, html string"


def odd_pages():
    rng = random.Random(11)
    long = "".join(rng.choice("abcdefgh <>é") for _ in range(3000))
    rows = [(k, f"http://h/{k}", long) for k in range(40)]  # one large group of copies
    rows += [(100 + k, None if k % 7 == 0 else "http://é\n x", "x" * 990 + str(k % 3) * k) for k in range(30)]
    rows += [(200, "u", None), (201, "u", ""), (202, None, "y" * 1000), (203, "u", "y" * 1000), (203, "u", "y" * 1000)]
    rows += [(None, "u", "y" * 1000), (None, None, "z" * 2000), (None, "u", "z" * 2000), (204, "u", "a\r\n\r\nb" * 400)]
    rows += [(-5, "u", "q" * 1200), (-7, "u", "q" * 1200)]
    return rows


def expected(rows):
    keep = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            keep[b] = max(keep.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = keep.get(b) if keep.get(b) != i else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [skew.MOST, 1])
def test_pages_come_back(spark, monkeypatch, most):
    monkeypatch.setattr(warc, "join_keyed", lambda *a: skew.join_keyed(*a, most=most))
    rows = odd_pages()
    frame = spark.createDataFrame(rows, PAGES).repartition(3).select("*", *[F.lit(1).alias(c) for c in ("id", "same", "kept", "n", "body")])
    assert sorted(map(tuple, warc.page_records(frame).collect()), key=str) == expected(rows)
    assert warc.page_records(frame.limit(0)).count() == 0


def test_bodies_and_other_tools(spark, tmp_path):
    rows = odd_pages()
    warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(2), str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w")).where("record_type = 'response'").collect()
    bodies = {(h or "").encode() for _, _, h in rows}
    assert {bytes(r["payload"]) for r in back} == bodies
    assert {r["target_uri"] for r in back} >= {None, "http://%C3%A9%0A%20x"}
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("part*"))  # a valid file for any gzip tool
    assert whole.count(b"WARC/1.1\r\n") == len(rows)


def long_record(spark, n):
    return warc._member(1, None, b"l" * n, None, "d")


def test_long_records_end_in_a_zero_byte(spark):
    member = long_record(spark, (1 << 24) + 7)
    assert member[-1] == 0 and long_record(spark, 50)[-1] == 0
    assert len(gzip.decompress(member)) > 1 << 24


@pytest.fixture
def small_ranges(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(v)) for k, v in zip(held, (n, 1))]
    for k, v in held.items():
        spark.conf.set(k, v)


def stored(record):
    """A member whose bytes are stored, so that magics in the payload stand in the file."""
    c = zlib.compressobj(0, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


@pytest.mark.parametrize("size", [64, 333, 5000])
def test_false_magics_in_any_byte_range(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    members, want = [], []
    for k in range(60):
        body = rng.randbytes(rng.randrange(0, 400))
        for _ in range(rng.choice([0, 0, 1, 5])):
            at = rng.randrange(len(body) + 1)
            body = body[:at] + warc.MAGIC + rng.randbytes(rng.randrange(9)) + body[at:]
        head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{k}>\r\nContent-Length: {len(body)}\r\n\r\n".encode()
        members.append(rng.choice([stored, gzip.compress])(head + body + b"\r\n\r\n"))
        want.append((f"<urn:page:{k}>", "resource", body))
        if k % 20 == 0:
            members.append(gzip.compress(b""))
    (tmp_path / "a").write_bytes(b"".join(members))
    (tmp_path / "b").write_bytes(b"no archive at all")
    small_ranges(size)
    frame = warc.read_warc(spark, str(tmp_path))
    got = [(r["record_id"], r["record_type"], bytes(r["payload"])) for r in frame.collect()]
    assert sorted(got) == sorted(want)


def test_broken_members_are_reported(spark, tmp_path):
    good = gzip.compress(b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nok\r\n\r\n")
    short = gzip.compress(b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 200\r\n\r\nok")
    (tmp_path / "a").write_bytes(good + short + good[:-9] + good + gzip.compress(b"other data") + good[:20])
    got = sorted(r["record_type"] for r in warc.read_warc(spark, str(tmp_path), payloads=False).collect())
    assert got == ["broken", "broken", "broken", "metadata", "metadata"]


def test_names_that_spark_would_unpack(spark, tmp_path):
    good = gzip.compress(b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nok\r\n\r\n")
    (tmp_path / "a.warc.gz").write_bytes(good * 3)
    assert warc.read_warc(spark, str(tmp_path), split=False).count() == 3


def test_running_sums(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, rng.randrange(50)]), k, rng.randrange(-(2**63), 2**63)) for k in range(3000)]
    got = skew.running_sums(spark.createDataFrame(rows, "c long, at long, v long"), "c", [F.col("at")], ["v"]).collect()
    want, now = {}, {}
    for c, at, v in rows:
        now[c] = now.get(c, 0) + v
        want[(c, at)] = (now[c] + 2**63) % 2**64 - 2**63
    assert {(r["c"], r["at"]): r["sum_v"] for r in got} == want
    assert skew.running_sums(spark.createDataFrame([], "c long, at long, v long"), "c", [F.col("at")], ["v"]).count() == 0
