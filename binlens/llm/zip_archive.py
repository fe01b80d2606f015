"""ZIP-packaged web archives: written with stored members, read back by byte ranges.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj`` (one
line per record with offset and length), both stored uncompressed in the ZIP, so that a record is one
range of the package.  The reader parses the end record, its ZIP64 form if there is one, and the
central directory, finds the two members and range-reads records without extracting anything.

Of records with equal payloads of at least ``min_bytes`` bytes, that with the smallest page id (nulls
last) is a response; the others are revisits that name it and hold no payload.  Rows that tie for the
smallest id are all responses.  A null page counts as empty.  An empty table writes nothing and reads
back empty.  Extra columns are ignored.

Every task writes packages of its own under a fresh name and reports them; a package of a lost
attempt is reported by nobody and so never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binlens.llm.common import shared_path, shared_table

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
RECORDS_PER_PACKAGE = 20_000
BYTES_PER_PACKAGE = 512 << 20
MAX_READ_TASKS = 10_000
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_BIG = 0xFFFFFFFF


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- ZIP ------------------------------------------------------------------------------------------------------
class StoredZip:
    """Writes stored members to an open stream; sizes go to the central directory and to data descriptors."""

    def __init__(self, stream, zip64: bool = False):
        self.stream, self.at, self.members, self.force64 = stream, 0, [], zip64

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.head, self.crc = name.encode(), self.at, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        # bit 3: sizes follow the data; bit 11: UTF-8 name; version 45 for 8-byte descriptors
        self._put(_LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x808, 0, 0, 33, 0, _BIG, _BIG, len(self.name), len(extra)) + self.name + extra)
        self.start = self.at

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self._put(data)

    def finish_member(self) -> None:
        size = self.at - self.start
        self._put(b"PK\x07\x08" + struct.pack("<IQQ", self.crc, size, size))
        self.members.append((self.name, self.head, size, self.crc))

    def close(self) -> None:
        begin = self.at
        for name, head, size, crc in self.members:
            extra, short = b"", (size, size, head)
            if self.force64 or max(size, head) >= _BIG:
                extra, short = struct.pack("<HHQQQ", 1, 24, size, size, head), (_BIG,) * 3
            self._put(_CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x808, 0, 0, 33, crc, *short[:2], len(name), len(extra), 0, 0, 0, 0,
                                             short[2]) + name + extra)
        size, n = self.at - begin, len(self.members)
        if self.force64 or max(begin, size) >= _BIG or n >= 0xFFFF:
            at64 = self.at
            self._put(_END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, begin))
            self._put(_LOCATOR64 + struct.pack("<IQI", 0, at64, 1))
            begin, size, n = _BIG, _BIG, 0xFFFF
        self._put(_END + struct.pack("<HHHHIIH", 0, 0, n, n, size, begin, 0))


def members(handle, length: int) -> dict[str, tuple[int, int]]:
    """Data offset and size of every stored member; ``handle.read_at(n, offset)`` reads a range."""
    tail_at = max(0, length - 65_557)
    tail = handle.read_at(length - tail_at, tail_at)
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("no end of central directory")
    n, size, begin = struct.unpack("<HII", tail[at + 10:at + 20])
    if n == 0xFFFF or size == _BIG or begin == _BIG:
        locator = tail.rfind(_LOCATOR64, 0, at)
        if locator < 0:
            raise ValueError("no ZIP64 locator")
        at64, = struct.unpack("<Q", tail[locator + 8:locator + 16])
        end64 = handle.read_at(56, at64)
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory")
        n, size, begin = struct.unpack("<QQQ", end64[32:56])
    directory, out, p = handle.read_at(size, begin), {}, 0
    for _ in range(n):
        if directory[p:p + 4] != _CENTRAL:
            raise ValueError("broken central directory")
        method, = struct.unpack("<H", directory[p + 10:p + 12])
        packed, plain, n_name, n_extra, n_note = struct.unpack("<IIHHH", directory[p + 20:p + 34])
        head, = struct.unpack("<I", directory[p + 42:p + 46])
        name = directory[p + 46:p + 46 + n_name].decode("utf-8")
        extra = directory[p + 46 + n_name:p + 46 + n_name + n_extra]
        q = 0
        while q + 4 <= len(extra):
            kind, k = struct.unpack("<HH", extra[q:q + 4])
            if kind == 1:
                wide = iter(struct.unpack(f"<{k // 8}Q", extra[q + 4:q + 4 + k // 8 * 8]))
                plain = next(wide) if plain == _BIG else plain
                packed = next(wide) if packed == _BIG else packed
                head = next(wide) if head == _BIG else head
            q += 4 + k
        if method == 0:
            local = handle.read_at(30, head)
            if local[:4] != _LOCAL:
                raise ValueError("broken local header")
            a, b = struct.unpack("<HH", local[26:30])
            out[name] = (head + 30 + a + b, plain)
        p += 46 + n_name + n_extra + n_note
    return out


# ---- records --------------------------------------------------------------------------------------------------
def record(kind: str, url: str, payload: bytes, digest: str, page_id: int | None, refers_to: int | None) -> bytes:
    block = payload if kind == "response" else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>",
             "WARC-Target-URI: " + " ".join(url.split()), "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
             f"Page-ID: {'' if page_id is None else page_id}", f"Payload-Length: {len(payload)}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"Refers-To-Page-ID: {'' if refers_to is None else refers_to}"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("broken record length")
    return fields, rest[:n]


def _open(uri: str, write: bool):
    system, path = pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    if not write:
        return system.open_input_file(path)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path)


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, revisit, first_id; payloads are compared by SHA-1 and length."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    keyed = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload"))
    # only digests are grouped, and only those that occur twice are joined back: written first, so that
    # their size is known and payloads are shuffled only where they are too many to broadcast
    smallest_first = F.struct(F.col("page_id").isNull().alias("missing"), "page_id")
    twice = shared_table(keyed.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(
        F.min(smallest_first)["page_id"].alias("first_id"), F.count("*").alias("copies")).where("copies > 1"), "copied-payloads")
    joined = keyed.join(twice, ["digest", "size"], "left")
    revisit = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", revisit.alias("revisit"), "first_id")


def write_packages(pages: DataFrame, folder: str, min_bytes: int = 0, zip64: bool = False) -> DataFrame:
    """Writes one record per row; returns package, records of every package written."""
    rows = with_roles(pages, min_bytes)
    return rows.mapInArrow(_writer(folder, zip64), "package string, records long")


def _writer(folder: str, zip64: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = stream = None
        done: list[tuple[str, int]] = []
        index: list[str] = []
        at = 0

        def close() -> None:
            package.finish_member()
            package.begin(INDEX)
            package.write("".join(index).encode())
            package.finish_member()
            package.close()
            stream.close()
            done.append((name, len(index)))

        for batch in batches:
            for row in batch.to_pylist():
                if package is None or len(index) >= RECORDS_PER_PACKAGE or at >= BYTES_PER_PACKAGE:
                    if package is not None:
                        close()
                    name = f"{folder}/{uuid.uuid4().hex}.wacz"
                    stream = _open(name, True)
                    package, index, at = StoredZip(stream, zip64), [], 0
                    package.begin(DATA)
                digest = digest_of(row["payload"])
                kind = "revisit" if row["revisit"] else "response"
                raw = gzip.compress(record(kind, row["url"], row["payload"], digest, row["page_id"], row["first_id"]), 6, mtime=0)
                package.write(raw)
                index.append(json.dumps({"page_id": row["page_id"], "type": kind, "digest": digest, "offset": at, "length": len(raw)}) + "\n")
                at += len(raw)
        if package is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())],
                                         names=["package", "records"])
    return run


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_packages(packages: DataFrame) -> DataFrame:
    """Every record of the packages, read by its range; payloads are checked against their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: int(x) if x else None
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with _open(name, False) as handle:
                    found = members(handle, handle.size())
                    (data_at, _), (index_at, index_size) = found[DATA], found[INDEX]
                    lines = handle.read_at(index_size, index_at).decode().splitlines()
                    for k in range(0, len(lines), 2000):
                        out: list[tuple] = []
                        for line in lines[k:k + 2000]:
                            entry = json.loads(line)
                            fields, payload = parse_record(gzip.decompress(handle.read_at(entry["length"], data_at + entry["offset"])))
                            kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                            if kind == "response" and (digest_of(payload) != digest or len(payload) != int(fields["payload-length"])):
                                raise ValueError(f"{name}: payload differs from its digest")
                            out.append((number(fields["page-id"]), int(fields["payload-length"]), digest, kind,
                                        number(fields.get("refers-to-page-id")) if kind == "revisit" else None))
                        cols = list(zip(*out))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                             pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64())],
                            names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return packages.select("package").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, spark: SparkSession, min_bytes: int = 0) -> DataFrame:
    """Writes the packages to the shared folder and reads every record back."""
    written = shared_table(write_packages(pages, shared_path(spark, "packages"), min_bytes), "package-list")
    return read_packages(written.repartition(max(1, min(MAX_READ_TASKS, written.count()))))
