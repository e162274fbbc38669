"""WARC records inside ZIP packages: writing, and reading by ranges without extraction."""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwarden import session
from tickwarden.llm import common

# Bytes of records after which a task begins another package.
PACKAGE_BYTES = 32_000_000
LEAST_REVISIT = 100
RECORDS, INDEX = "archive/records.warc.gz", "indexes/index.cdx"
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF


# ---- writing -----------------------------------------------------------------------------------


def record(page_id, url, html: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the response."""
    revisit = refers_to is not None
    block = b"" if revisit else html
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Target-URI: " + " ".join((url or "").split()),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {len(html)}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines.insert(3, f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Package:
    """A ZIP file with stored members, always with ZIP64 sizes, written from start to end."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def member(self, name: str, data: bytes) -> None:
        start, raw, crc = self.at, name.encode(), zlib.crc32(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        self.put(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x800, 0, 0, 33, crc, _MAX32, _MAX32, len(raw), len(extra)))
        self.put(raw + extra + data)
        self.members.append((raw, crc, len(data), start))

    def close(self) -> None:
        start = self.at
        for raw, crc, size, offset in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, offset)
            self.put(
                struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x800, 0, 0, 33, crc, _MAX32, _MAX32, len(raw),
                            len(extra), 0, 0, 0, 0, _MAX32) + raw + extra
            )
        size, end = self.at - start, self.at
        many = len(self.members)
        self.put(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, many, many, size, start))
        self.put(struct.pack("<IIQI", 0x07064B50, 0, end, 1))
        self.put(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, _MAX16, _MAX16, _MAX32, _MAX32, 0))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """(path, records) of the packages written to `folder`, which all machines share.

    `pages`: page_id, url, html.  The payload is the html in UTF-8 (NULL: empty).  Of records with equal
    payloads of at least LEAST_REVISIT bytes, those with the smallest page_id are responses and the others
    revisit it; all smaller ones are responses.  A NULL page_id never becomes the response of others: its
    row revisits the smallest id, if there is one.  Each record is a gzip member of its own, so a range of
    bytes can be read alone; an index member holds the ranges.  Files are written under a fresh name and then
    renamed, so a repeated task leaves no half package; only packages in the returned table count.  The table is
    stored, so a package is not written twice.  Empty tables give no packages.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= LEAST_REVISIT
    first = rows.filter(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = first.filter("n > 1 AND first IS NOT NULL").drop("n")
    rows = rows.join(first, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    )

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        body, index = io.BytesIO(), []

        def finish():
            own = uuid.uuid4().hex
            name = f"{base}/{own}"
            with store.open_output_stream(name + ".part") as out:
                package = Package(out)
                package.member(RECORDS, body.getvalue())
                package.member(INDEX, "".join(index).encode())
                package.close()
            store.move(name + ".part", name + ".zip")
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{own}.zip"], "records": pa.array([len(index)], pa.int64())})

        for batch in batches:
            for r in batch.to_pylist():
                raw = record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"])
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = pack.compress(raw) + pack.flush()
                index.append(f"{body.tell()} {len(data)}\n")
                body.write(data)
                if body.tell() >= PACKAGE_BYTES:
                    yield finish()
                    body, index = io.BytesIO(), []
        if index:
            yield finish()

    columns = rows.select("page_id", "url", "payload", "digest", "refers_to")
    return common.stored(columns.mapInArrow(run, "path string, records long"), "packages")


# ---- reading -----------------------------------------------------------------------------------


def directory(file, size: int) -> dict[str, tuple[int, int, int]]:
    """Members of a package: (offset of the local header, stored size, method), from its central directory.

    Reads the end record (searched backwards past a comment), the ZIP64 locator and record if there are, and
    the directory; nothing else.  Damaged packages raise ValueError.
    """
    tail_at = max(0, size - 22 - _MAX16)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of a central directory")
    many, length, start = struct.unpack("<10xHII2x", tail[at : at + 22])
    end = tail_at + at
    if _MAX16 == many or _MAX32 in (length, start):
        mark, where = struct.unpack("<I4xQ4x", file.read_at(20, end - 20)) if end >= 20 else (0, 0)
        if mark != 0x07064B50:
            raise ValueError("no ZIP64 locator")
        mark, many, length, start = struct.unpack("<I28xQQQ", file.read_at(56, where))
        if mark != 0x06064B50:
            raise ValueError("no ZIP64 record")
    raw, found, at = file.read_at(length, start), {}, 0
    for _ in range(many):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method, packed, full, names, extras, notes, offset = struct.unpack("<10xH8xIIHHH8xI", raw[at : at + 46])
        name = raw[at + 46 : at + 46 + names].decode()
        extra = raw[at + 46 + names : at + 46 + names + extras]
        while len(extra) >= 4:
            kind, wide = struct.unpack("<HH", extra[:4])
            if kind == 1:
                values = list(struct.unpack(f"<{wide // 8}Q", extra[4 : 4 + wide // 8 * 8]))
                full = values.pop(0) if full == _MAX32 else full
                packed = values.pop(0) if packed == _MAX32 else packed
                offset = values.pop(0) if offset == _MAX32 else offset
            extra = extra[4 + wide :]
        found[name] = (offset, packed, method)
        at += 46 + names + extras + notes
    return found


def member_range(file, member: tuple[int, int, int]) -> tuple[int, int]:
    """Where a stored member's bytes begin, and how many there are."""
    offset, size, method = member
    if method:
        raise ValueError("the member is compressed by the package itself")
    head = file.read_at(30, offset)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    names, extras = struct.unpack("<26xHH", head)
    return offset + 30 + names + extras, size


def read(packages: DataFrame) -> DataFrame:
    """(path, page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest) of all records.

    `packages`: path.  A task holds one package's index and one record at a time.  For a response the size and
    digest are those of the bytes read, which must agree with its header; a revisit has no payload.
    """

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, own = fs.FileSystem.from_uri(path)
                with store.open_input_file(own) as file:
                    members = directory(file, file.size())
                    at, size = member_range(file, members[INDEX])
                    index = [tuple(map(int, line.split())) for line in file.read_at(size, at).splitlines()]
                    base, _ = member_range(file, members[RECORDS])
                    rows = []
                    for offset, length in index:
                        rows.append({"path": path} | parse(zlib.decompress(file.read_at(length, base + offset), 31)))
                        if len(rows) == common.BATCH_ROWS:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    return packages.select("path").mapInArrow(
        run, "path string, page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"
    )


def _batch(rows):
    kinds = [("path", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
             ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in kinds], [n for n, _ in kinds])


def parse(raw: bytes) -> dict:
    head, _, block = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    number = lambda name: int(n) if (n := fields.get(name, "").strip("<>").removeprefix("urn:page:")) else None
    kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["WARC-Payload-Length"])
    payload = None
    if kind == "response":
        payload = block[: int(fields["Content-Length"])]
        if (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
            raise ValueError("a payload does not agree with its header")
    return {
        "page_id": number("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "record_type": kind, "refers_to": number("WARC-Refers-To"),
        "payload": payload, "payload_bytes": size, "payload_digest": digest,
    }


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE octet_length(encode(html)) >= 100 GROUP BY html)
SELECT p.page_id, octet_length(encode(p.html)) AS payload_bytes, sha256(p.html) AS payload_digest,
  CASE WHEN f.first IS NULL OR p.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.html = f.html
"""


def op8_warc(spark, sf_dir):
    pages = common.table(spark, sf_dir, "pages")
    packages = write(pages, session.scratch_path(spark, "warc"))
    return read(packages.repartition(common.partitions(spark), "path")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
