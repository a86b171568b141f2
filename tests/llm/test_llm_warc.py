"""WARC archives in ZIP files: written, found and read by ranges."""

import base64
import gzip
import hashlib
import json
import struct
import zipfile

import pytest

from personpub.llm import warc
from personpub.llm.warc import Archive, Ranges, members, parse_record, read_archives, record, records, write_archives
from personpub.session import scratch, settle

SCHEMA = "page_id long, url string, html string, key string, match string, top int, payload int, path string"


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "a", "b", 1, 2, "c") for r in rows], SCHEMA).repartition(3)
    return read_archives(settle(write_archives(df, scratch(spark, "test-warc"), **kw))).collect()


def sha1(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (3, None, None), (4, "u\r\nX: y%0A", ""), (5, "é", "é\r\n\r\nWARC/1.1"),
    (6, "l", "long " * 60_000), (7, "l", "long " * 60_000), (-8, "n", "neg"), (9, "c", "<P>same</P>"),
]


@pytest.mark.parametrize("kw", [{}, {"archive_bytes": 10}, {"least": 1}, {"least": 1 << 40}])
def test_round_trip(spark, kw):
    got = {int(r["page_id"]): r for r in run(spark, ROWS, **kw)}
    assert sorted(got) == sorted(r[0] for r in ROWS)
    for page, url, html in ROWS:
        r, body = got[page], (html or "").encode()
        top = max(p for p, _, h in ROWS if (h or "") == (html or "")) if len(body) >= kw.get("least", 0) else page
        assert (r["url"], r["payload_bytes"], r["payload_digest"], r["sound"]) == (url, len(body), sha1(html), True)
        assert r["record_type"] == ("response" if page == top else "revisit")
        assert r["refers_to"] == (None if page == top else str(top))
        assert r["payload"] is None if page != top else bytes(r["payload"]) == body


def test_repeated_rows_null_ids_and_empty(spark):
    got = run(spark, [(1, "a", "x"), (1, "a", "x"), (None, "b", "x"), (None, "c", "alone")])
    assert sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in got) == [
        ("1", "response", "None"), ("1", "response", "None"), ("None", "response", "None"), ("None", "revisit", "1"),
    ]
    empty = spark.createDataFrame([], SCHEMA)
    assert read_archives(settle(write_archives(empty, scratch(spark, "test-warc")))).collect() == []


def test_other_readers_see_a_plain_zip(tmp_path):
    archive = Archive(str(tmp_path / "a.zip"))
    packed = [record(str(i), None, b"x" * i, "D", i, None) for i in range(5)]
    for p in packed:
        archive.add(p)
    assert archive.close() == 5
    with zipfile.ZipFile(tmp_path / "a.zip") as z:
        assert z.testzip() is None
        assert z.read("archive/data.warc.gz") == b"".join(packed)
        assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
        read = Ranges(str(tmp_path / "a.zip"))
        for name, (method, start, size) in members(read).items():
            assert read(start, size) == z.read(name) and method == 0
        read.close()


def test_zip64_and_notes(tmp_path):
    """Directories as very large archives have them: full 32-bit fields, values in ZIP64 ones."""
    path = tmp_path / "big.zip"
    body, name = b"stored bytes", b"archive/data.warc.gz"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20)
    local += name + struct.pack("<HHQQ", 1, 16, len(body), len(body)) + body
    gap = b"junk before"
    extra = struct.pack("<HH2s", 0x9999, 2, b"zz") + struct.pack("<HHQQQ", 1, 24, len(body), len(body), len(gap))
    central = struct.pack(
        "<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0x800, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 4, 0, 0, 0,
        0xFFFFFFFF,
    ) + name + extra + b"note"
    at = len(gap) + len(local)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 7) + b"comment"
    path.write_bytes(gap + local + central + end64 + locator + end)
    read = Ranges(str(path))
    (method, start, size), = members(read).values()
    assert method == 0 and read(start, size) == body
    read.close()


def test_reads_ranges_only(tmp_path, monkeypatch):
    archive = Archive(str(tmp_path / "a.zip"))
    for i in range(300):
        archive.add(record(str(i), "u", bytes([i % 256]) * 3000 + str(i).encode(), "D", 1, None))
    archive.close()
    monkeypatch.setattr(warc, "FETCH", 500)
    lengths = []
    plain = Ranges.__call__
    monkeypatch.setattr(Ranges, "__call__", lambda self, a, n: lengths.append(n) or plain(self, a, n))
    got = list(records(str(tmp_path / "a.zip")))
    assert [f["WARC-Record-ID"] for f, _ in got] == [f"<urn:page:{i}>" for i in range(300)]
    assert len(lengths) > 60 and (tmp_path / "a.zip").stat().st_size > 60_000


def test_not_a_zip(tmp_path):
    (tmp_path / "x").write_bytes(b"nothing")
    with pytest.raises(ValueError):
        members(Ranges(str(tmp_path / "x")))


def test_record_headers_are_reversible():
    fields, block = parse_record(record("5", "a\r\nB: c%0D", b"body", "D", 4, None))
    assert fields["WARC-Target-URI"] == "a\r\nB: c%0D" and block.endswith(b"\r\n\r\nbody")


def foreign(number, payload):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{number}>\r\nContent-Length: {len(payload) + 19}\r\n\r\n"
    return gzip.compress(head.encode() + b"HTTP/1.1 200 OK\r\n\r\n" + payload + b"\r\n\r\n")


def package(path, files):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for name, data in files.items():
            z.writestr(name, data)
    return str(path)


def cdxj(name, parts, order=None):
    """Index lines by key, not by place."""
    at, lines = 0, []
    for i, part in enumerate(parts):
        told = {"url": f"http://x/{i}", "filename": name, "offset": str(at), "length": len(part)}
        lines.append(f"key{(i * 7) % 5} 20240101000000 {json.dumps(told)}\n")
        at += len(part)
    return "".join(sorted(lines)).encode()


@pytest.mark.parametrize("packed", [False, True])
def test_several_archive_members_and_indexes(spark, tmp_path, packed):
    one, two = ([foreign(n, f"payload {n} ".encode() * 50) for n in range(a, a + 9)] for a in (0, 100))
    both = b'!meta {"format": "x"}\n' if not packed else b""
    both += cdxj("one.warc.gz", one) + cdxj("archive/two.warc.gz", two)
    index = {"indexes/index.cdx.gz": gzip.compress(both[:300]) + gzip.compress(both[300:])} if packed else {"indexes/index.cdxj": both}
    files = {"archive/": b"", "archive/one.warc.gz": b"".join(one), "pages/pages.jsonl": b"{}", "archive/two.warc.gz": b"".join(two)}
    path = package(tmp_path / "a.zip", files | index)
    rows = read_archives(spark.createDataFrame([(path,)], "path string")).collect()
    want = {str(n): f"payload {n} ".encode() * 50 for n in [*range(9), *range(100, 109)]}
    got = {r["page_id"]: bytes(r["payload"]).removesuffix(b"\r\n\r\n") for r in rows}
    assert got == want and all(r["sound"] and r["payload_digest"] for r in rows) and len(rows) == 18


def test_an_archive_that_no_index_covers_is_an_error(tmp_path):
    parts = [foreign(1, b"x")]
    data = {"archive/one.warc.gz": parts[0], "archive/two.warc.gz": parts[0]}
    for files in (
        data,  # no index at all
        data | {"indexes/i.cdxj": cdxj("one.warc.gz", parts)},  # one member is left out
        data | {"indexes/i.cdxj": cdxj("three.warc.gz", parts)},  # a member that is not there
        data | {"indexes/i.txt": b"0 10\n"},  # which of the two?
        data | {"indexes/i.txt": b"something else\n"},
    ):
        with pytest.raises(ValueError):
            list(records(package(tmp_path / "a.zip", files)))
    assert list(records(package(tmp_path / "none.zip", {"pages/p": b"", "archive/empty.warc.gz": b""}))) == []
