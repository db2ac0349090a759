import hashlib
import io
import struct
import zipfile

import pytest

from seqscore.llm import warc_zip as W
from seqscore.llm.common import RangeReader, blob_files, scratch_path


class Bytes:
    def __init__(self, raw):
        self.raw, self.size, self.reads = raw, len(raw), []

    def read_at(self, offset, length):
        assert 0 <= offset and offset + length <= self.size
        self.reads.append((offset, length))
        return self.raw[offset:offset + length]


MEMBERS = [("a.txt", b"hello"), ("archive/ü", bytes(range(256)) * 40), ("empty", b"")]


@pytest.mark.parametrize("zip64_from", [W.FULL32, 1000, 1])
def test_packages_are_zip_files_with_and_without_zip64(zip64_from):
    raw = W.zip_stored(MEMBERS, zip64_from) + b"\n"
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == dict(MEMBERS)
    p = W.ZipPackage(Bytes(raw))
    assert {n: p.read(n) for n in p.members} == dict(MEMBERS)
    assert p.read("archive/ü", 1000, 5) == (bytes(range(256)) * 40)[1000:1005]


def test_foreign_packages_and_faults():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, b in MEMBERS:
            z.writestr(zipfile.ZipInfo(n), b)
        z.writestr("packed", b"x" * 500, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"note PK\x05\x06 in a comment, long enough to hold a record"
    p = W.ZipPackage(Bytes(out.getvalue()))
    assert p.read("a.txt") == b"hello"
    with pytest.raises(ValueError, match="compressed"):
        p.read("packed")
    with pytest.raises(ValueError, match="outside"):
        p.read("a.txt", 3, 9)
    for bad in (b"", b"nothing here", out.getvalue()[:-60]):
        with pytest.raises(ValueError):
            W.ZipPackage(Bytes(bad))


def test_more_members_than_16_bits_count():
    raw = W.zip_stored([(f"m{i}", b"") for i in range(70_000)]) + b"\n"
    assert len(W.ZipPackage(Bytes(raw)).members) == 70_000


def test_single_records_are_range_reads():
    recs = [W.warc_record(i, "http://x/ü\r\n", b"p%d" % i * 400, hashlib.sha256(b"p%d" % i * 400).hexdigest())
            for i in range(50)]
    data, index, at = b"".join(recs), "", 0
    for i, r in enumerate(recs):
        index += f"0 {i} {at} {len(r)}\n"
        at += len(r)
    reader = Bytes(W.zip_stored([(W.DATA, data), (W.INDEX, index.encode())]) + b"\n")
    p = W.ZipPackage(reader)
    reader.reads.clear()
    r = W.record_at(p, 31)
    assert (r.page_id, r.payload, r.url) == (31, b"p31" * 400, "http://x/ü\r\n")
    assert sum(n for _, n in reader.reads) < len(index) + len(recs[31]) + 100
    with pytest.raises((ValueError, Exception)):
        W.parse_record(recs[0][:-3])


def test_round_trip(spark):
    long_text = "é" * 200 + "\r\n\r\nWARC/1.1 PK\x05\x06"
    rows = [(3, "u3", long_text), (1, "u1", long_text), (9, None, long_text), (4, "u", "short"), (5, "u", "short"),
            (6, "u", None), (7, "u", ""), (None, "u", long_text), (2, "u", "x" * 99), (8, "u", "x" * 99),
            (10, "u", "y" * 100), (11, "u", "y" * 100), (1, "again", long_text), (12, "u", "z" * 300_000)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows],
                               "page_id long, url string, html string, digest string, refers_to int")
    path = scratch_path(spark, "archives-test")
    W.write_archives(df, path, package_bytes=500)
    got = W.read_archives(spark, path, payloads=True).collect()
    assert len(got) == len(rows)
    first = {}
    for k, _, h in rows:
        b = (h or "").encode()
        if k is not None and len(b) >= 100:
            first[b] = min(first.get(b, k), k)
    want = []
    for k, u, h in rows:
        b = (h or "").encode()
        again = k is not None and b in first and first[b] != k
        want.append((k, u or "", len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response",
                     first[b] if again else None, None if again else b))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(*r[:6], None if r[6] is None else bytes(r[6])) for r in got], key=key) == sorted(want, key=key)
    files = blob_files(spark, path).collect()
    assert len(files) > 1
    for f in files:
        with RangeReader(f.path) as r, zipfile.ZipFile(io.BytesIO(r.read_at(0, r.size))) as z:
            assert z.testzip() is None and z.namelist() == [W.DATA, W.INDEX]
            assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())


def test_empty_table(spark):
    assert W.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_zip64_end_record_is_used():
    raw = W.zip_stored(MEMBERS, 1) + b"\n"
    end = raw.rfind(W.END)
    assert struct.unpack_from("<I", raw, end + 16)[0] == W.FULL32 and raw.rfind(W.LOCATOR64) > 0
