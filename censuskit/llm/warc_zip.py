"""ZIP-packaged web archives: WARC records and an index, stored in ZIP files.

Writing: records with equal payloads (SHA-1, length and a second hash) of at least
``min_revisit_bytes`` bytes become revisits of the one with the smallest id. Tasks write
ZIP files of about ``archive_bytes`` (before compression) to a shared folder, with stored
members: one or more ``archive/*.warc.gz``, each record a gzip member of its own, and
``indexes/index.cdx``, which has each record's member, offset and length. All members
carry ZIP64 fields. A task that is run again writes files of other names; the table of
paths that comes out names those of the run that counts.

Reading: a table of paths is dealt to tasks, and each archive is only reached by range
reads through its file system, so its size does not matter: the end record, the ZIP64
locator and end record, the central directory, the index member, then each record by its
range within a stored member, in order. Nothing is extracted; a compressed member is refused.

Defined results: null html is an empty payload; a null url or id is left out of the record
and read back as null. Rows that repeat id and html are records of their own, all of the
same type. Ids are exact beside nulls. An empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import gzip
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from censuskit.llm.common import shared_dir

END, END64, LOCATOR, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
URN = "urn:page:"
RECORDS = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, archive string, member string, record_offset long, record_length long"


# ---- records


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", "WARC-Date: 2024-01-01T00:00:00Z"]
    head += [f"WARC-Record-ID: <{URN}{page_id}>"] if page_id is not None else []
    head += ["WARC-Target-URI: " + "".join(url.split("\r")).replace("\n", " ")] if url is not None else []
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)


def parse_record(record: bytes) -> dict:
    """The fields of a record, and its payload (None for a revisit)."""
    head, _, rest = record.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(fields[name][len(URN) + 1 : -1]) if name in fields else None
    kind = fields["WARC-Type"]
    size = int(_fields(http)["Content-Length"])
    if kind == "response" and size != len(payload):
        raise ValueError("a payload is cut short")
    return {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": kind, "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": size, "refers_to": number("WARC-Refers-To"), "payload": payload if kind == "response" else None,
    }


# ---- ZIP directories by range reads


class ZipDirectory:
    """Members of a ZIP file that is only reached through read(offset, length)."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read = read
        tail_at = max(0, size - 65_557)  # the end record with the longest comment
        tail = read(tail_at, size - tail_at)
        at = tail.rfind(END)
        if at < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
        if 0xFFFF == count or 0xFFFFFFFF in (length, start):
            locator = tail.rfind(LOCATOR, 0, at)
            if locator < 0:
                raise ValueError("no ZIP64 locator")
            (end64,) = struct.unpack("<Q", tail[locator + 8 : locator + 16])
            record = read(end64, 56)
            if record[:4] != END64:
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = struct.unpack("<QQQ", record[32:56])
        self.members: dict[str, tuple[int, int, int]] = {}
        self._parse(read(start, length), count)

    def _parse(self, directory: bytes, count: int) -> None:
        at = 0
        for _ in range(count):
            if directory[at : at + 4] != ENTRY:
                raise ValueError("a broken central directory")
            method, packed, plain = struct.unpack("<H8xII", directory[at + 10 : at + 28])
            n_name, n_extra, n_comment = struct.unpack("<HHH", directory[at + 28 : at + 34])
            (local,) = struct.unpack("<I", directory[at + 42 : at + 46])
            name = directory[at + 46 : at + 46 + n_name].decode()
            extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
            plain, packed, local = self._wide(extra, plain, packed, local)
            self.members[name] = (method, plain, local)
            at += 46 + n_name + n_extra + n_comment

    @staticmethod
    def _wide(extra: bytes, *values: int) -> list[int]:
        """Values of 0xFFFFFFFF are in the ZIP64 extra field, in this order."""
        out, at = list(values), 0
        while at + 4 <= len(extra):
            tag, n = struct.unpack("<HH", extra[at : at + 4])
            if tag == 1:
                field = at + 4
                for i, v in enumerate(out):
                    if v == 0xFFFFFFFF:
                        (out[i],) = struct.unpack("<Q", extra[field : field + 8])
                        field += 8
            at += 4 + n
        return out

    def place(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes are: offset and length."""
        method, size, local = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        header = self.read(local, 30)
        if header[:4] != LOCAL:
            raise ValueError("a broken local header")
        n_name, n_extra = struct.unpack("<HH", header[26:30])
        return local + 30 + n_name + n_extra, size

    def range(self, name: str, offset: int, length: int) -> bytes:
        start, size = self.place(name)
        if offset < 0 or offset + length > size:
            raise ValueError("a range beyond its member")
        return self.read(start + offset, length)


# ---- files


class ArchiveWriter:
    """One ZIP file in a folder, written as records come; at most one member is in memory."""

    def __init__(self, files: fs.FileSystem, folder: str, member_bytes: int):
        self.path = f"{folder}/pages-{uuid.uuid4().hex}.zip"
        self.out = files.open_output_stream(self.path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member_bytes, self.members, self.total = member_bytes, 0, 0
        self.buffer, self.index = bytearray(), []

    def add(self, record: bytes) -> None:
        packed = gzip.compress(record, 1, mtime=0)
        self.index.append(f"{self._member()} {len(self.buffer)} {len(packed)}")
        self.buffer += packed
        self.total += len(record)
        if len(self.buffer) >= self.member_bytes:
            self._close_member()

    def _member(self) -> str:
        return f"archive/part-{self.members:03d}.warc.gz"

    def _store(self, name: str, data: bytes) -> None:
        with self.zip.open(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=True) as f:
            f.write(data)

    def _close_member(self) -> None:
        if self.buffer:
            self._store(self._member(), bytes(self.buffer))
            self.buffer, self.members = bytearray(), self.members + 1

    def close(self) -> str:
        self._close_member()
        self._store("indexes/index.cdx", "\n".join(self.index).encode())
        self.zip.close()
        self.out.close()
        return self.path


def open_archive(uri: str) -> ZipDirectory:
    """The directory of an archive in any store that Arrow's file systems read."""
    files, path = fs.FileSystem.from_uri(uri)
    source = files.open_input_file(path)

    def read(offset: int, length: int) -> bytes:
        source.seek(offset)
        return source.read(length)

    return ZipDirectory(read, source.size())


def records_of(uri: str) -> Iterator[dict]:
    """Each record of an archive, read by its range."""
    zipped = open_archive(uri)
    places = {m: zipped.place(m)[0] for m in zipped.members}
    start, size = zipped.place("indexes/index.cdx")
    for line in zipped.read(start, size).decode().splitlines():
        member, offset, length = line.split(" ")
        record = parse_record(gzip.decompress(zipped.read(places[member] + int(offset), int(length))))
        yield record | {"archive": uri, "member": member, "record_offset": int(offset), "record_length": int(length)}


# ---- Spark


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 0, archive_bytes: int = 64 << 20, member_bytes: int = 4 << 20) -> DataFrame:
    """Writes the archives when it is run: one row per archive, with its path."""
    folder = (folder or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}").rstrip("/")
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("html"), F.sha1(payload.cast("binary")).alias("sha1"), F.octet_length(payload).alias("n"), F.xxhash64(payload).alias("h"))
    firsts = rows.groupBy("sha1", "n", "h").agg(F.min("page_id").alias("first_id"))
    # the join side with one row per payload is small; a payload that most pages share is split by AQE
    both = rows.join(firsts.hint("merge"), ["sha1", "n", "h"]).withColumn("refers_to", F.when((F.col("n") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
    both = both.select("page_id", "url", "html", "sha1", "refers_to")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base)
        scheme = folder.removesuffix(base)
        writer, done = None, []
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                for r in batch.slice(start, 1024).to_pylist():
                    writer = writer or ArchiveWriter(files, base, member_bytes)
                    writer.add(warc_record(r["page_id"], r["url"], r["html"].encode(), base64.b32encode(bytes.fromhex(r["sha1"])).decode(), r["refers_to"]))
                    if writer.total >= archive_bytes:
                        done, writer = [*done, writer.close()], None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([scheme + path for path in done], pa.string())], ["archive"])

    return both.mapInArrow(work, "archive string")


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths of archives that lie in any store that Spark lists; their content is not read."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"))


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives, with its place; with_payload adds the payload."""
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [(c.split()[0], kinds[c.split()[1]]) for c in RECORDS.split(", ")] + [("payload", pa.binary())] * with_payload

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sheet(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[name] for r in rows], kind) for name, kind in fields], [name for name, _ in fields])

        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                rows: list[dict] = []
                for record in records_of(uri):
                    rows.append(record)
                    if len(rows) >= 256:
                        yield sheet(rows)
                        rows = []
                yield sheet(rows)

    # one archive is a task's least share
    return archives.mapInArrow(work, RECORDS + (", payload binary" if with_payload else ""))
