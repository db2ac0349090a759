"""Web archives in ZIP packages (op 3): writing, and reading by byte ranges.

A package is a ZIP file whose members are all stored, not deflated::

    archive/data.warc.gz    WARC 1.1 records, each a gzip member of its own
    indexes/index.cdx       a line for each record: page, offset, length

Spark's text sink ends a file with one line feed; the package declares it as
its comment of one byte, which makes it a regular ZIP file.

The reader takes the end record, the ZIP64 locator and end record where they
are needed, and the central directory; it finds a stored member's bytes from
its local header, reads the index and then single records by their ranges.
Nothing is extracted and no package is read whole.
"""

from __future__ import annotations

import binascii
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import RangeReader, blob_files, scratch_path, write_blobs

LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
_LOCAL = struct.Struct("<4s5H3I2H")
_CENTRAL = struct.Struct("<4s6H3I5H2I")
_END = struct.Struct("<4s4H2IH")
_END64 = struct.Struct("<4sQ2H2I4Q")
_LOCATOR64 = struct.Struct("<4sIQI")
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
REVISIT_FROM = 100
"""Payloads of fewer bytes are never written as revisits."""
PACKAGE_BYTES = 8 << 20
"""A package is closed beyond this size; it bounds a task's memory."""
COMMENT = b"\n"


# ---------------------------------------------------------------- packages

def zip_stored(members: list[tuple[str, bytes]], zip64_from: int = FULL32,
               comment: bytes = COMMENT) -> bytes:
    """A ZIP file of stored members, without its comment's bytes; ZIP64 fields
    are written for sizes and offsets of ``zip64_from`` or more."""
    out, central = bytearray(), bytearray()
    wide = False
    for name, data in members:
        at, crc, size, raw = len(out), binascii.crc32(data), len(data), name.encode()
        big_size, big_at = size >= zip64_from, at >= zip64_from
        wide |= big_size or big_at
        extra = struct.pack("<HHQQ", 1, 16, size, size) if big_size else b""
        short = FULL32 if big_size else size
        out += _LOCAL.pack(LOCAL, 45 if big_size else 20, 0x800, 0, 0, 0x21, crc, short, short,
                           len(raw), len(extra)) + raw + extra + data
        wide_fields = (struct.pack("<QQ", size, size) if big_size else b"") + (
            struct.pack("<Q", at) if big_at else b"")
        extra = struct.pack("<HH", 1, len(wide_fields)) + wide_fields if wide_fields else b""
        central += _CENTRAL.pack(CENTRAL, 45, 45 if wide_fields else 20, 0x800, 0, 0, 0x21, crc, short, short,
                                 len(raw), len(extra), 0, 0, 0, 0, FULL32 if big_at else at) + raw + extra
    start, n = len(out), len(members)
    out += central
    if wide or start >= zip64_from or n >= FULL16:
        end64 = len(out)
        out += _END64.pack(END64, 44, 45, 45, 0, 0, n, n, len(central), start)
        out += _LOCATOR64.pack(LOCATOR64, 0, end64, 1)
        out += _END.pack(END, 0, 0, min(n, FULL16), min(n, FULL16), min(len(central), FULL32), FULL32,
                         len(comment))
    else:
        out += _END.pack(END, 0, 0, n, n, len(central), start, len(comment))
    return bytes(out)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    crc: int
    header_at: int


class ZipPackage:
    """The members of a ZIP file, found by byte ranges alone."""

    def __init__(self, reader: RangeReader):
        self._reader = reader
        self._data_at: dict[str, int] = {}
        self.members = {m.name: m for m in self._central()}

    def _end(self) -> tuple[int, int, int]:
        """(members, size, offset) of the central directory."""
        size = self._reader.size
        span = min(size, _END.size + FULL16)
        tail = self._reader.read_at(size - span, span)
        at = tail.rfind(END)
        while at >= 0:  # a comment may hold the signature: the record must end the file
            if len(tail) - at >= _END.size:
                _, disk, first, _, n, length, start, note = _END.unpack_from(tail, at)
                if at + _END.size + note == len(tail):
                    break
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no end of central directory: not a ZIP file")
        if FULL16 in (disk, first, n) or FULL32 in (length, start):
            where = size - span + at - _LOCATOR64.size
            if where >= 0:
                sign, _, end64, disks = _LOCATOR64.unpack(self._reader.read_at(where, _LOCATOR64.size))
                if sign == LOCATOR64:
                    if disks > 1:
                        raise ValueError("ZIP files over several volumes can't be read")
                    (sign, _, _, _, disk, first, _, n, length, start) = _END64.unpack(
                        self._reader.read_at(end64, _END64.size))
                    if sign != END64:
                        raise ValueError("the ZIP64 locator points to no ZIP64 end record")
        if disk or first:
            raise ValueError("ZIP files over several volumes can't be read")
        return n, length, start

    def _central(self) -> Iterator[Member]:
        n, length, start = self._end()
        raw, at = self._reader.read_at(start, length), 0
        for _ in range(n):
            if raw[at:at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            (_, _, _, flags, method, _, _, crc, packed, size, names, extras, notes, _, _, _,
             header) = _CENTRAL.unpack_from(raw, at)
            at += _CENTRAL.size
            name = raw[at:at + names].decode("utf-8" if flags & 0x800 else "cp437")
            extra = raw[at + names:at + names + extras]
            at += names + extras + notes
            p = 0
            while p + 4 <= len(extra):
                kind, have = struct.unpack_from("<HH", extra, p)
                if kind == 1:  # the fields that don't fit, in this order
                    q = p + 4
                    if size == FULL32:
                        (size,), q = struct.unpack_from("<Q", extra, q), q + 8
                    if packed == FULL32:
                        (packed,), q = struct.unpack_from("<Q", extra, q), q + 8
                    if header == FULL32:
                        (header,), q = struct.unpack_from("<Q", extra, q), q + 8
                p += 4 + have
            yield Member(name, method, size, crc, header)

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        """A range of a stored member's bytes."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} is compressed in the package; only stored members have ranges")
        if name not in self._data_at:
            head = self._reader.read_at(m.header_at, _LOCAL.size)
            sign, *_, names, extras = _LOCAL.unpack(head)
            if sign != LOCAL:
                raise ValueError(f"no local header of {name} at {m.header_at}")
            self._data_at[name] = m.header_at + _LOCAL.size + names + extras
        length = m.size - offset if length is None else length
        if offset < 0 or length < 0 or offset + length > m.size:
            raise ValueError(f"range {offset}+{length} outside {name} of {m.size} bytes")
        return self._reader.read_at(self._data_at[name] + offset, length)


# ----------------------------------------------------------------- records

def _urn(page: int | None) -> str:
    return "<urn:page:none>" if page is None else f"<urn:page:{page}>"


def warc_record(page: int | None, url: str | None, payload: bytes, digest: str,
                refers_to: int | None = None) -> bytes:
    """One gzip member: a response with its payload, or a revisit without."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {_urn(page)}", "WARC-Date: 1970-01-01T00:00:00Z",
             f"WARC-Target-URI: {json.dumps(url or '')[1:-1]}",
             f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


@dataclass(frozen=True)
class Record:
    """What a record says; ``payload`` is None for a revisit."""
    page_id: int | None
    url: str
    kind: str
    digest: str
    payload_bytes: int
    refers_to: int | None
    payload: bytes | None


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in raw.decode().split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _page_of(urn: str | None) -> int | None:
    if urn is None or urn == "<urn:page:none>":
        return None
    return int(urn.removeprefix("<urn:page:").removesuffix(">"))


def parse_record(member: bytes) -> Record:
    z = zlib.decompressobj(31)
    raw = z.decompress(member) + z.flush()
    if not z.eof or z.unused_data:
        raise ValueError("a record's range doesn't hold one whole gzip member")
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("no WARC record at this place")
    h = _headers(head)
    block = rest[:int(h["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    length = int(_headers(http)["content-length"])
    revisit = h["warc-type"] == "revisit"
    if not revisit and len(body) != length:
        raise ValueError("a response's payload is shorter than it says")
    return Record(_page_of(h["warc-record-id"]), json.loads(f'"{h["warc-target-uri"]}"'), h["warc-type"],
                  h["warc-payload-digest"].removeprefix("sha256:"), length,
                  _page_of(h["warc-refers-to"]) if revisit else None, None if revisit else body)


def read_index(package: ZipPackage) -> list[tuple[int, int]]:
    """(offset, length) of the records, in their order."""
    rows = package.read(INDEX).decode().splitlines()
    return [(int(o), int(n)) for o, n in (r.split(" ")[-2:] for r in rows)]


def records(package: ZipPackage, span: int = 4 << 20) -> Iterator[Record]:
    """All records by ranges of the index, neighbours up to ``span`` bytes in one read."""
    index = read_index(package)
    at = 0
    while at < len(index):
        first, to = index[at][0], at + 1
        while to < len(index) and index[to][0] + index[to][1] - first <= span:
            to += 1
        raw = package.read(DATA, first, index[to - 1][0] + index[to - 1][1] - first)
        for offset, length in index[at:to]:
            yield parse_record(raw[offset - first:offset - first + length])
        at = to


def record_at(package: ZipPackage, i: int) -> Record:
    """One record, by its place in the index."""
    return parse_record(package.read(DATA, *read_index(package)[i]))


# ------------------------------------------------------------------- Spark

def revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, refers_to) for the pages whose payload of ``REVISIT_FROM`` bytes or
    more has another page with a smaller id; only digests are shuffled."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    seen = (pages.select(F.col(id_col).cast("long").alias("id"), F.sha2(payload, 256).alias("digest"),
                         F.octet_length(payload).alias("n"))
            .filter(f"n >= {REVISIT_FROM} and id is not null").select("id", "digest").distinct())
    first = seen.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("pages")).filter("pages > 1")
    return (seen.join(first.select("digest", "first"), "digest").filter("id > first")
            .select("id", "digest", F.col("first").alias("refers_to")))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", package_bytes: int = PACKAGE_BYTES) -> None:
    """A WARC record for every row, in packages below ``path``.

    The payload is the html in UTF-8, a null one is empty.  A page without an
    id is always a response, and so are rows that repeat the id that others
    refer to."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    digest = F.sha2("html", 256)
    again = revisits(pages, id_col, html_col)
    joined = (rows.withColumn("digest", digest).join(again, ["id", "digest"], "left")
              .select(F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("id"),
                      "url", "html", "digest", F.col("refers_to").isNull().alias("fresh"),
                      F.coalesce("refers_to", F.lit(0)).alias("refers_to")))

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        data, index = bytearray(), []

        def package() -> pd.DataFrame:
            name = f"{TaskContext.get().partitionId()}"
            lines = "".join(f"{name} {p} {o} {n}\n" for p, o, n in index)
            return pd.DataFrame({"package": [zip_stored([(DATA, data), (INDEX, lines.encode())])]})

        for f in frames:
            for r in f.itertuples(index=False):
                page = None if r.no_id else r.id
                rec = warc_record(page, r.url, r.html.encode("utf-8", "surrogatepass"), r.digest,
                                  None if r.fresh else r.refers_to)
                if index and len(data) + len(rec) > package_bytes:
                    yield package()
                    data, index = bytearray(), []
                index.append(("-" if page is None else page, len(data), len(rec)))
                data += rec
        if index:
            yield package()

    # fewer writers than shuffle partitions: each fills packages, and their workers are few
    writers = max(1, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    write_blobs(joined.coalesce(writers).mapInPandas(build, "package binary"), "package", path)


READ = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every record of the packages below ``path``; a response's digest is
    computed from its bytes and must be the one that it states, a revisit's is
    the stated one.  ``payload`` holds a response's bytes when asked for."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p in f["path"]:
                with RangeReader(p) as r:
                    rows = []
                    for rec in records(ZipPackage(r)):
                        if rec.payload is not None and hashlib.sha256(rec.payload).hexdigest() != rec.digest:
                            raise ValueError(f"{p}: the payload of page {rec.page_id} has another digest")
                        rows.append((rec.page_id, rec.url, rec.payload_bytes, rec.digest, rec.kind,
                                     rec.refers_to, rec.payload if payloads else None))
                        if len(rows) == 1000:
                            yield _frame(rows)
                            rows = []
                    yield _frame(rows)

    def _frame(rows: list) -> pd.DataFrame:
        cols = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        out = pd.DataFrame(rows, columns=cols)
        for c in ("page_id", "refers_to"):
            out[c] = pd.array([r[cols.index(c)] for r in rows], "Int64")
        out["payload_bytes"] = out["payload_bytes"].astype(np.int64)
        return out

    # the scan deals the packages to tasks by their length
    return blob_files(spark, path).select("path").mapInPandas(read, READ)


def archive_round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the packages (below ``path`` or a new shared folder) and read them back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    write_archives(pages, path, **options)
    return read_archives(spark, path)
