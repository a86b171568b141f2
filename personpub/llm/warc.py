"""WARC records in ZIP-packaged archives: writing, and reading by ranges without extraction."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import only, small_batches, table
from personpub.session import scratch, settle

DATE = "2026-01-01T00:00:00Z"
LEAST = 0
#: payload bytes after which a task begins another archive
ARCHIVE_BYTES = 256 << 20
#: records next to each other are fetched together up to so many bytes
FETCH = 4 << 20
REPLY = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def store(path: str):
    """The file system and path of a url, as all executors see it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return fs.LocalFileSystem(), path


# --- writing ---------------------------------------------------------------------------------


def _line(value: str) -> str:
    """A header value on one line, reversibly."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: str, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: str | None) -> bytes:
    """One gzip member with one record; a revisit has no payload but tells its digest and size."""
    body = b"" if refers_to is not None else REPLY + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{_line(page_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{_line(refers_to)}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    raw = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class _Sink:
    """A write-only stream that knows its place, for stores that cannot seek."""

    def __init__(self, out):
        self.out, self.at = out, 0

    def write(self, data) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at

    def flush(self) -> None:
        pass


class Archive:
    """A ZIP file of two stored members: archive/data.warc.gz and indexes/index.cdx."""

    def __init__(self, path: str):
        files, name = store(path)
        files.create_dir(name.rpartition("/")[0], recursive=True)
        self.path, self.raw = path, files.open_output_stream(name)
        self.zip = zipfile.ZipFile(_Sink(self.raw), "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(_member("archive/data.warc.gz"), "w", force_zip64=True)
        self.index: list[bytes] = []
        self.at = 0

    def add(self, packed: bytes) -> None:
        self.data.write(packed)
        self.index.append(b"%d %d\n" % (self.at, len(packed)))
        self.at += len(packed)

    def close(self) -> int:
        self.data.close()
        with self.zip.open(_member("indexes/index.cdx"), "w", force_zip64=True) as out:
            for line in self.index:
                out.write(line)
        self.zip.close()
        self.raw.close()
        return len(self.index)


def _member(name: str) -> zipfile.ZipInfo:
    return zipfile.ZipInfo(name, (2026, 1, 1, 0, 0, 0))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of pages (page_id, url, html); one row per archive: path, records.

    Of rows with equal payloads of at least `least` bytes that with the largest page_id
    becomes a response, the others revisits of it; smaller payloads are all responses.
    A null html is an empty payload, a null url has no target line. Rows that repeat the
    winning page_id are responses too; rows without an id are revisits of a winner that
    has one, else responses. An empty table makes no archives.

    Payloads are matched by SHA-256 on ids and digests alone; the html then meets one row
    per payload in a join that can be split where copies are many. Each task streams
    its rows into archives of its own, under a name no other attempt uses; an archive counts
    only if its row comes back from a finished task.
    """
    small_batches(pages.sparkSession)
    rows = only(pages, page_id="page_id", url="url", html="html").select(
        F.col("page_id"),
        "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("key", F.sha2("payload", 256))
    best = rows.filter(F.octet_length("payload") >= least).groupBy("key").agg(F.max("page_id").alias("top"))
    # the join key is not the grouping key, so both sides are dealt anew and large groups split
    best = best.select(F.unhex("key").alias("match"), "top")
    marked = (
        rows.withColumn("match", F.unhex("key"))
        .drop("key")
        .join(best, "match", "left")
        .select(
            F.col("page_id").cast("string").alias("page_id"),
            "url",
            "payload",
            F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).cast("string").alias("refers_to"),
        )
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive, filled = None, 0
        for batch in batches:
            out = []
            for key, url, payload, refers in zip(batch["page_id"], batch["url"], batch["payload"], batch["refers_to"]):
                if archive is None:
                    archive, filled = Archive(f"{folder}/{uuid.uuid4().hex}.zip"), 0
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                archive.add(record("" if key is None else key, url, payload, digest, len(payload), refers))
                filled += len(payload)
                if filled >= archive_bytes:
                    out.append((archive.path, archive.close()))
                    archive = None
            yield pd.DataFrame(out, columns=["path", "records"])
        if archive is not None:
            yield pd.DataFrame([(archive.path, archive.close())], columns=["path", "records"])

    return marked.mapInPandas(run, "path string, records long")


# --- reading ---------------------------------------------------------------------------------


class Ranges:
    """Byte ranges of a file in any store."""

    def __init__(self, path: str):
        files, name = store(path)
        self.file = files.open_input_file(name)
        self.size = self.file.size()

    def __call__(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)

    def close(self) -> None:
        self.file.close()


def members(read: Ranges) -> dict[str, tuple[int, int, int]]:
    """The members of a ZIP file: name to method, start of the data and its packed length.

    Reads the end record, the ZIP64 one where the plain one is full, the central
    directory, and the fixed part of each local header. Nothing else is touched.
    """
    tail_at = max(0, read.size - 65_557)
    tail = read(tail_at, read.size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no ZIP directory")
    entries, size, start = struct.unpack_from("<HII", tail, at + 10)
    if 0xFFFF == entries or 0xFFFFFFFF in (size, start):
        place = read(tail_at + at - 20, 20)
        if place[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        (end64,) = struct.unpack_from("<Q", place, 8)
        size, start = struct.unpack_from("<QQ", read(end64, 56), 40)
    directory = read(start, size)
    out, at = {}, 0
    while directory[at : at + 4] == b"PK\x01\x02":
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, whole, n, extra, note = struct.unpack_from("<IIHHH", directory, at + 20)
        (local,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        more, here = directory[at + 46 + n : at + 46 + n + extra], 0
        while here + 4 <= len(more):
            kind, length = struct.unpack_from("<HH", more, here)
            if kind == 1:  # the ZIP64 values stand in for those that are full, in this order
                wide = iter(struct.unpack_from(f"<{length // 8}Q", more, here + 4))
                whole = next(wide) if whole == 0xFFFFFFFF else whole
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            here += 4 + length
        n_local, extra_local = struct.unpack_from("<HH", read(local, 30), 26)
        out[name] = (method, local + 30 + n_local + extra_local, packed)
        at += 46 + n + extra + note
    return out


def parse_record(packed: bytes) -> tuple[dict[str, str], bytes]:
    """The headers and block of one gzip member."""
    raw = zlib.decompress(packed, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        fields[name] = value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return fields, rest[: int(fields["Content-Length"])]


def records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records of an archive, fetched by the ranges in its indexes.

    Archive members stand below `archive/`, indexes below `indexes/`, both stored. A line of an
    index is CDXJ, with filename, offset and length, or the two numbers alone where there is
    one archive member; an index may be gzipped. An archive member that no index covers, or an
    index line that names no member, is an error.
    """
    read = Ranges(path)
    try:
        found = members(read)
        data = {name.rpartition("/")[2]: m for name, m in found.items() if name.startswith("archive/") and name[-1] != "/"}
        indexes = [name for name in found if name.startswith("indexes/") and name[-1] != "/"]
        if any(method for method, _, _ in [*data.values(), *(found[n] for n in indexes)]):
            raise ValueError(f"{path}: members must be stored")
        covered: set[str] = set()
        for index in indexes:
            last, group = "", []
            for name, at, size in _entries(read, index, found[index], list(data)):
                if name not in data:
                    raise ValueError(f"{path}: {index} names {name}, which is no archive member")
                covered.add(name)
                end = group[-1][0] + group[-1][1] if group else 0
                if name != last or at < end or group and at + size - group[0][0] > FETCH:
                    yield from _fetch(read, data[last][1] if group else 0, group)
                    last, group = name, []
                group.append((at, size))
            yield from _fetch(read, data[last][1] if group else 0, group)
        lost = [name for name, (_, _, size) in data.items() if size and name not in covered]
        if lost:
            raise ValueError(f"{path}: no index covers {', '.join(sorted(lost))}")
    finally:
        read.close()


def _entries(read: Ranges, index: str, place: tuple[int, int, int], names: list[str]) -> Iterator[tuple[str, int, int]]:
    """(archive member, offset, length) for each line of an index, read a part at a time."""
    rest = b""
    for part in _parts(read, place, index.endswith(".gz")):
        *lines, rest = (rest + part).split(b"\n")
        for line in lines:
            yield from _entry(line, index, names)
    yield from _entry(rest, index, names)


def _parts(read: Ranges, place: tuple[int, int, int], packed: bool) -> Iterator[bytes]:
    _, start, length = place
    inflate = zlib.decompressobj(31)
    for at in range(0, length, 1 << 20):
        part = read(start + at, min(1 << 20, length - at))
        if not packed:
            yield part
            continue
        while part:
            yield inflate.decompress(part)
            part = inflate.unused_data
            if inflate.eof:  # the next of several gzip members
                inflate = zlib.decompressobj(31)


def _entry(line: bytes, index: str, names: list[str]) -> Iterator[tuple[str, int, int]]:
    line = line.strip()
    if not line or line.startswith(b"!"):  # a CDXJ file may tell about itself
        return
    at = line.find(b"{")
    if at >= 0:
        told = json.loads(line[at:])
        yield told["filename"].rpartition("/")[2], int(told["offset"]), int(told["length"])
        return
    numbers = line.split()
    if len(numbers) != 2 or len(names) != 1:
        raise ValueError(f"{index}: neither CDXJ nor an offset and a length in the only archive member")
    yield names[0], int(numbers[0]), int(numbers[1])


def _fetch(read: Ranges, data: int, group: list[tuple[int, int]]) -> Iterator[tuple[dict[str, str], bytes]]:
    if group:
        first = group[0][0]
        block = read(data + first, group[-1][0] + group[-1][1] - first)
        for at, size in group:
            yield parse_record(block[at - first : at - first + size])


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record of the archives (path): page_id, url, record_type, refers_to,
    payload_bytes, payload_digest, payload (null for a revisit), sound.

    Digest and length are of the full payload: computed anew for responses, as the
    record tells for others, null where it does not. `sound` is false where a response differs from its headers.
    """
    small_batches(archives.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                out = []
                for fields, block in records(path):
                    told = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
                    size = fields.get("X-Payload-Length")
                    size = None if size is None else int(size)
                    payload, sound = None, True
                    if fields["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        sound = told in (None, digest) and size in (None, len(payload))
                        told, size = digest, len(payload)
                    out.append(
                        (
                            _page(fields.get("WARC-Record-ID")),
                            fields.get("WARC-Target-URI"),
                            fields["WARC-Type"],
                            _page(fields.get("WARC-Refers-To")),
                            size,
                            told,
                            payload,
                            sound,
                        )
                    )
                    if len(out) >= 500:
                        yield pd.DataFrame(out, columns=FIELDS)
                        out = []
                yield pd.DataFrame(out, columns=FIELDS)

    return archives.select("path").mapInPandas(
        run,
        "page_id string, url string, record_type string, refers_to string, payload_bytes long,"
        " payload_digest string, payload binary, sound boolean",
    )


FIELDS = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "sound"]


def _page(value: str | None) -> str | None:
    return (value.removeprefix("<urn:page:").removesuffix(">") or None) if value else None


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives when the query is built, and reads them when it runs."""
    folder = scratch(spark, "warc")
    archives = settle(write_archives(table(spark, sf_dir, "pages"), folder))
    # one task per archive or few
    archives = archives.repartition(max(1, archives.count()), "path")
    return read_archives(archives).select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
        "sound",
    )
