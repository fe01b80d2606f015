import base64
import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from binlens.llm import zip_archive as Z


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


@pytest.mark.parametrize("zip64", [False, True])
def test_other_readers_open_our_packages_and_we_theirs(zip64):
    out = io.BytesIO()
    z = Z.StoredZip(out, zip64)
    for name, chunks in (("archive/é", [b"hello", b" world"]), ("empty", [])):
        z.begin(name)
        for c in chunks:
            z.write(c)
        z.finish_member()
    z.close()
    theirs = zipfile.ZipFile(io.BytesIO(out.getvalue()))
    assert theirs.testzip() is None and theirs.read("archive/é") == b"hello world"
    found = Z.members(Bytes(out.getvalue()), len(out.getvalue()))
    assert {n: out.getvalue()[a:a + k] for n, (a, k) in found.items()} == {"archive/é": b"hello world", "empty": b""}
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w", zipfile.ZIP_STORED) as f:
        f.comment = b"PK a comment"
        f.writestr("x", b"abc")
        with f.open("y", "w", force_zip64=zip64) as g:
            g.write(b"defg")
        f.writestr("packed", b"z" * 100, zipfile.ZIP_DEFLATED)
    found = Z.members(Bytes(other.getvalue()), len(other.getvalue()))
    assert {n: other.getvalue()[a:a + k] for n, (a, k) in found.items()} == {"x": b"abc", "y": b"defg"}


def test_no_archive():
    with pytest.raises(ValueError):
        Z.members(Bytes(b"nothing here"), 12)


def test_record_round_trip():
    payload = "a\r\n\r\nb é".encode()
    fields, block = Z.parse_record(Z.record("response", "http://x/ y\n", payload, Z.digest_of(payload), 5, None))
    assert block == payload and fields["warc-target-uri"] == "http://x/ y" and fields["page-id"] == "5"
    with pytest.raises(ValueError):
        Z.parse_record(Z.record("response", "u", payload, "d", 5, None)[:-3])


def expected(rows, least):
    first = {}
    for i, _, h in rows:
        h = h or ""
        key = (i is None, i or 0)
        first[h] = min(first.get(h, key), key)
    n = {h: sum((r[2] or "") == h for r in rows) for h in first}
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= least and n[h or ""] > 1 and first[h or ""] != (i is None, i or 0)
        refers = None if first[h or ""][0] else first[h or ""][1]
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", refers if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 2])
def test_round_trip(spark, least):
    rows = [(1, "u", "a"), (2, None, None), (0, "u", "a"), (None, "u", "a"), (3, "u", ""), (3, "u", "bb"), (3, "v", "bb"), (7, "v", "bb"),
            (4, "u\n", "x" * 300_000), (5, "ü", "é🙂\r\n\r\n"), (6, "w", "x" * 300_000), (None, "z", None)]
    df = spark.createDataFrame([(*r, "p", "q") for r in rows], "page_id long, url string, html string, digest string, copies string")
    got = [tuple(r) for r in Z.round_trip(df.repartition(3), spark, least).collect()]
    assert sorted(got, key=str) == expected(rows, least)
    assert Z.round_trip(df.where("false"), spark, least).count() == 0


def test_many_packages(spark, monkeypatch):
    monkeypatch.setattr(Z, "RECORDS_PER_PACKAGE", 7)
    df = spark.range(60).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), (F.col("id") % 11).cast("string").alias("html"))
    got = Z.round_trip(df, spark).collect()
    assert len(got) == 60 and sum(r.record_type == "response" for r in got) == 11 and all(r.refers_to in (None, r.page_id % 11) for r in got)


def test_member_is_a_plain_warc_file(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc")], "page_id long, url string, html string")
    name = Z.write_packages(df.coalesce(1), f"file://{tmp_path}").first()["package"]
    f = zipfile.ZipFile(name.removeprefix("file://"))
    plain = gzip.decompress(f.read(Z.DATA))
    assert plain.count(b"WARC/1.1") == 2 and plain.count(b"abc") == 1 and f.testzip() is None
