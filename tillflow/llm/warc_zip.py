"""WARC records in ZIP packages, written and read by byte ranges.

A package is a ZIP file with two stored (uncompressed) members: an archive
``archive/data.warc.gz`` of records, each a gzip member of its own, and an
index ``indexes/index.cdxj`` with one line of JSON per record.  As the members
are stored, a record's bytes stand in the package as they are, and a reader
fetches them by range: it reads the end-of-central-directory record (and its
ZIP64 form), the central directory, the index, and then only ranges of
records.  Nothing is unpacked to a disk.

Files are opened through pyarrow's file systems, by the URI of the shared
folder.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import new_folder, stored
from .words import slices

#: Payloads below this many bytes are never revisits.
LEAST_REVISIT = 1000
#: A package is closed when its archive has grown to this; ranges read at once have about the second size.
PACKAGE_BYTES, RANGE_BYTES = 256_000_000, 1_000_000
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path; Hadoop writes local URIs with one slash."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record(kind: str, page: object, url: str | None, date: str, payload: bytes, digest: str, refers_to: object) -> bytes:
    """One WARC record; a revisit has the HTTP headers and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:x-page:{'' if page is None else page}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else re.sub(r"[\r\n]", " ", url),
        "WARC-Payload-Digest": f"sha1:{base32(digest)}",
        "WARC-Block-Digest": f"sha1:{base32(hashlib.sha1(block).hexdigest())}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(block),
    }
    if kind == "revisit":
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:x-page:{refers_to}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


class Package:
    """A package being written: records as they come, the index at the end."""

    def __init__(self, folder: str):
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        name = f"{TaskContext.get().partitionId() if TaskContext.get() else 0:05d}-{uuid.uuid4().hex}.wacz"
        self.uri, self.size, self.lines = f"{folder}/{name}", 0, []
        self.stream = system.open_output_stream(f"{path}/{name}", buffer_size=1 << 20)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)

    def add(self, data: bytes, entry: dict[str, Any]) -> None:
        packed = gzip.compress(data, 4, mtime=0)
        self.lines.append(json.dumps(entry | {"filename": ARCHIVE, "offset": self.size, "length": len(packed)}))
        self.member.write(packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines))
        self.zip.close()
        self.stream.close()
        return self.uri, len(self.lines), self.size


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per row and returns the packages: uri, records, bytes.

    Of records with equal payloads of at least 1000 bytes the one with the
    largest key is a response and the others are revisits of it; rows that
    repeat that key and payload are responses too.  Smaller payloads are all
    responses.  A null payload is empty, a null key is written as no key, a
    null url is left out.  The digests are aggregated before they meet the
    pages, so a payload that a third of all pages share is one row.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    equal = (
        rows.where(F.octet_length("html") >= LEAST_REVISIT)
        .groupBy("digest").agg(F.max("key").alias("last"), F.count("*").alias("n")).where("n > 1").select("digest", "last")
    )
    rows = rows.join(equal.hint("shuffle_hash"), "digest", "left").withColumn("refers_to", F.when(~F.col("key").eqNullSafe(F.col("last")), F.col("last")))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in slices(batches, "html", 1_000_000):
            for row in batch.to_pylist():
                package = package or Package(folder)
                kind = "response" if row["refers_to"] is None else "revisit"
                data = record(kind, row["key"], row["url"], date, row["html"].encode(), row["digest"], row["refers_to"])
                package.add(data, {"url": row["url"], "digest": row["digest"], "type": kind})
                if package.size >= PACKAGE_BYTES:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        uris, records, size = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(uris, pa.string()), pa.array(records, pa.int64()), pa.array(size, pa.int64())], ["uri", "records", "bytes"])

    columns = rows.select("key", "url", "html", "digest", "refers_to")
    return stored(columns.mapInArrow(task, "uri string, records bigint, bytes bigint"), "packages")


def read_at(file: pa.NativeFile, offset: int, length: int) -> bytes:
    file.seek(offset)
    return file.read(length)


def members(file: pa.NativeFile) -> dict[str, tuple[int, int, int]]:
    """Name -> (method, offset of the data, size) of a ZIP file's members, from its central directory."""
    size = file.size()
    tail = read_at(file, max(0, size - 65_557), min(size, 65_557))
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        (where,) = struct.unpack_from("<Q", tail, at - 12)
        end64 = read_at(file, where, 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory where its locator points")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, found, p = read_at(file, start, length), {}, 0
    for _ in range(count):
        if directory[p : p + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", directory, p + 8)
        packed, plain = struct.unpack_from("<II", directory, p + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, p + 28)
        (offset,) = struct.unpack_from("<I", directory, p + 42)
        name = directory[p + 46 : p + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, q = directory[p + 46 + n_name : p + 46 + n_name + n_extra], 0
        while q + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, q)
            if tag == 1:  # ZIP64: only the values that don't fit, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, q + 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            q += 4 + n
        head = read_at(file, offset, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header of {name}")
        found[name] = (method, offset + 30 + sum(struct.unpack_from("<HH", head, 26)), packed)
        p += 46 + n_name + n_extra + n_comment
    return found


def ranges(file: pa.NativeFile) -> Iterator[tuple[int, list[int]]]:
    """Offset of a range and lengths of the records in it, from the indexes of a package."""
    held = members(file)
    for name, (method, offset, size) in held.items():
        if not name.startswith("indexes/") or method != 0:
            continue
        start, lengths = -1, []
        for line in read_at(file, offset, size).splitlines():
            entry = json.loads(line)
            method, base, _ = held[entry["filename"]]
            if method != 0:
                raise ValueError(f"{entry['filename']} is compressed in its package; records can't be read by range")
            at = base + entry["offset"]
            if lengths and (at != start + sum(lengths) or at - start >= RANGE_BYTES):
                yield start, lengths
                lengths = []
            start = at if not lengths else start
            lengths.append(entry["length"])
        if lengths:
            yield start, lengths


def parsed(data: bytes) -> dict[str, Any]:
    """Fields of a record, and its payload (None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{base32(hashlib.sha1(block).hexdigest())}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page = lambda name: (fields[name][12:-1] or None) if name in fields else None
    return {
        "key": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"),
        "digest": base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(),
        "payload": block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None,
    }


def read(packages: DataFrame, key_type: str = "bigint") -> DataFrame:
    """The records of packages (uri): key, url, record_type, refers_to, digest, payload (null for revisits).

    Packages are cut into ranges, which are dealt over the tasks; a task holds
    one range.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                system, path = opened(uri)
                with system.open_input_file(path) as file:
                    found = list(ranges(file))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * len(found)), pa.array([s for s, _ in found], pa.int64()), pa.array([n for _, n in found], pa.list_(pa.int32()))],
                    ["uri", "start", "lengths"],
                )

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "url", "record_type", "refers_to", "digest", "payload"]
        kinds = [pa.string()] * 5 + [pa.binary()]
        for batch in batches:
            for row in batch.to_pylist():
                system, path = opened(row["uri"])
                with system.open_input_file(path) as file:
                    data, at, out = read_at(file, row["start"], sum(row["lengths"])), 0, []
                for n in row["lengths"]:
                    out.append(parsed(zlib.decompress(data[at : at + n], 31)))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in out], k) for n, k in zip(names, kinds, strict=True)], names)

    found = packages.select("uri").repartition("uri").mapInArrow(listed, "uri string, start bigint, lengths array<int>")
    records = found.repartition("uri", "start").mapInArrow(fetched, "key string, url string, record_type string, refers_to string, digest string, payload binary")
    return records.withColumns({"key": F.col("key").cast(key_type), "refers_to": F.col("refers_to").cast(key_type)})


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the pages and reads them back: key, payload_bytes, payload_digest, record_type, refers_to, url.

    Size and digest of a response are those of the payload that was read; a
    revisit has those of the response it refers to.
    """
    kind = pages.schema[key].dataType.simpleString()
    packages = write(pages, new_folder(pages.sparkSession, "archives"), key, url, html)
    records = stored(
        read(packages, kind).select("key", "url", "record_type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha")),
        "records",
    )
    whole = records.where("record_type = 'response'").groupBy("digest").agg(F.max("size").alias("of_size"), F.max("sha").alias("of_sha"))
    revisits = records.where("record_type = 'revisit'").join(whole, "digest", "left")
    columns = lambda size, sha: [F.col("key").alias(key), F.col(size).alias("payload_bytes"), F.col(sha).alias("payload_digest"), "record_type", "refers_to", F.col("url").alias(url)]
    return records.where("record_type = 'response'").select(*columns("size", "sha")).unionByName(revisits.select(*columns("of_size", "of_sha")))
