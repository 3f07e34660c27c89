"""WARC records in ZIP packages, and a reader that fetches records by byte range.

A package is a ZIP archive with *stored* members: ``archive/data.warc.gz`` (a gzip member per record) and
``indexes/index.cdxj`` (a line per record with its offset and length in the data). As the members are
stored, a record is a byte range of the package. The reader takes the central directory from the end of
the file (ZIP64 where it is needed), finds both members by their local headers, reads the index, and
then fetches record ranges; nothing is extracted and no package is read whole.

Of records with equal payloads of ``REVISIT_BYTES`` or more the one with the largest id is a response,
the others revisit it; all smaller ones are responses. Null html is an empty payload; a null URL leaves
out the target. Rows that repeat an id with an equal payload are separate records: those of the largest
id are all responses. A null id is read back as null; its row revisits others, never is revisited by id. An empty table gives no
package and no record. Extra columns are ignored.

Packages go to the shared folder under names that no other attempt of a task uses. Only those in the
list that the successful attempts return are read. Paths there are opened with ``pyarrow.fs``.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfolio.llm.common import batches, join_groups, scratch, text_of, written

REVISIT_BYTES = 1000
PACKAGE_BYTES = 16 << 20
READ_AHEAD = 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


# ---- records ----


def record(id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC 1.1 record as a gzip member. A revisit has no payload, but tells its length and digest."""
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + " ".join(url.split()))
    if revisit:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 3, mtime=0)


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


# ---- packages ----


def package(records: list[tuple[dict, bytes]]) -> bytes:
    """A ZIP package of (index entry, gzip member) pairs."""
    out, offset, lines = io.BytesIO(), 0, []
    for entry, member in records:
        lines.append(json.dumps(entry | {"offset": offset, "length": len(member)}))
        offset += len(member)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr(DATA, b"".join(m for _, m in records))
        archive.writestr(INDEX, "\n".join(lines) + "\n")
        archive.writestr("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1"}))
    return out.getvalue()


def _extra64(extra: bytes, values: list[int]) -> list[int]:
    """Fields that the 32-bit directory marks as too large, from the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            return [next(wide) if v == 0xFFFFFFFF else v for v in values]
        at += 4 + n
    return values


def members(file) -> dict[str, tuple[int, int]]:
    """Name -> (first byte, length) of the stored members of a ZIP file that can seek."""
    size = file.seek(0, 2)
    tail_at = max(0, size - 65_557)
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    end = tail.rfind(b"PK\5\6")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = end - 20
    if locator >= 0 and tail[locator : locator + 4] == b"PK\6\7":
        file.seek(struct.unpack_from("<Q", tail, locator + 8)[0])
        wide = file.read(56)
        if wide[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    file.seek(start)
    directory, at, found = file.read(length), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != b"PK\1\2":
            raise ValueError("bad central directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", directory, at + 20)
        local, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        plain, packed, local = _extra64(extra, [plain, packed, local])
        at += 46 + n_name + n_extra + n_note
        if method == 0:
            found[name] = (local, packed)
    for name, (local, packed) in found.items():
        file.seek(local)
        head = file.read(30)
        if head[:4] != b"PK\3\4":
            raise ValueError("bad local header")
        found[name] = (local + 30 + sum(struct.unpack_from("<HH", head, 26)), packed)
    return found


def index_entries(file) -> Iterator[dict]:
    """The entries of a package's index, with ``offset`` counted from the start of the package."""
    at = members(file)
    file.seek(at[INDEX][0])
    for line in file.read(at[INDEX][1]).decode().splitlines():
        entry = json.loads(line)
        yield entry | {"offset": entry["offset"] + at[DATA][0]}


def ranges(file, wanted: Iterable[tuple[int, int]]) -> Iterator[bytes]:
    """Byte ranges in ascending order; one read serves neighbours."""
    wanted, held, begin = list(wanted), b"", 0
    for i, (offset, length) in enumerate(wanted):
        if not (begin <= offset and offset + length <= begin + len(held)):
            stop = offset + length
            for o, n in wanted[i + 1 :]:
                if o > stop or o + n - offset > READ_AHEAD:
                    break
                stop = o + n
            file.seek(offset)
            held, begin = file.read(stop - offset), offset
        yield held[offset - begin : offset - begin + length]


# ---- Spark ----


def plan_records(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, html, digest, n, refers_to) per row; groups of copies are summed before they move."""
    payload = F.encode(text_of(html), "UTF-8")
    rows = pages.select(
        F.col(id).alias("id"), F.col(url).alias("url"), text_of(html).alias("html"), F.sha1(payload).alias("digest"),
        F.length(payload).cast("long").alias("n"),
    )
    # what is too small to be revisited gets a key of its own and isn't gathered anywhere
    key = F.when(F.col("n") >= REVISIT_BYTES, F.concat_ws(":", "digest", "n")).otherwise(F.concat(F.lit("-"), F.col("id")))
    groups = rows.filter(F.col("n") >= REVISIT_BYTES).groupBy(F.concat_ws(":", "digest", "n").alias("same")).agg(
        F.max("id").alias("last"), F.count("*").alias("rows")
    ).filter(F.col("rows") > 1)
    joined = join_groups(rows.withColumn("same", key), groups, ["same"])
    return joined.select("id", "url", "html", "digest", "n", F.when(~F.col("last").eqNullSafe(F.col("id")), F.col("last")).alias("refers_to"))


def write_packages(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the packages; returns (path, records, bytes) of each, as a table in the shared folder."""
    spark = pages.sparkSession
    # a path without a scheme is where Hadoop's default puts it, not on each executor's own disk
    place = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark, "warc"))
    folder = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()

    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, files = [], 0, []
        store, root = _store(folder)

        def flush() -> None:
            nonlocal held, size
            name = f"{root}/{uuid.uuid4().hex}.wacz"
            store.create_dir(root, recursive=True)
            body = package(held)
            with store.open_output_stream(name) as out:
                out.write(body)
            files.append({"path": f"{folder}/{name.rpartition('/')[2]}", "records": len(held), "bytes": len(body)})
            held, size = [], 0

        for frame in batches(frames, "html"):
            for row in frame.to_pylist():
                payload = row["html"].encode()
                member = record(row["id"], row["url"], payload, row["digest"], row["refers_to"])
                held.append(({"id": row["id"], "url": row["url"], "digest": row["digest"]}, member))
                size += len(member)
                if size >= PACKAGE_BYTES:
                    flush()
        if held:
            flush()
        yield pa.RecordBatch.from_pylist(files, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    listed = plan_records(pages, id, url, html).mapInArrow(write, "path string, records long, bytes long")
    return written(listed, "warc-list")


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, which names its scheme, and the path in it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if scheme not in ("hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss"):
        raise ValueError(f"no file system for packages under {path}")
    return fs.FileSystem.from_uri(f"{scheme}:{rest}")


def _open(path: str):
    store, name = _store(path)
    return store.open_input_file(name)


def list_records(packages: DataFrame) -> DataFrame:
    """The indexes of packages as rows (path, id, url, digest, offset, length), to be filtered at will."""
    fields = pa.schema([("path", pa.string()), ("id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for path in frame.column("path").to_pylist():
                with _open(path) as file:
                    yield pa.RecordBatch.from_pylist([e | {"path": path} for e in index_entries(file)], fields)

    # a task per package; an explicit number, so that they are not merged into one by the bytes of their names
    spread = packages.select("path").repartition(max(1, packages.count()))
    return spread.mapInArrow(read, "path string, id long, url string, digest string, offset long, length long")


def read_records(index: DataFrame) -> DataFrame:
    """Fetches the records of index rows: (id, url, record_type, digest, payload_bytes, refers_to, html).
    Rows of one package should follow one another, as ``list_records`` gives them."""
    fields = pa.schema([
        ("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("digest", pa.string()),
        ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("html", pa.string()),
    ])

    def named(x: str) -> int | None:
        number = x.rpartition(":")[2].rstrip(">")
        return None if number == "None" else int(number)

    def rows(path: str, wanted: list[tuple[int, int]]) -> Iterator[dict]:
        with _open(path) as file:
            for member in ranges(file, wanted):
                headers, payload = parse_record(member)
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                if headers["warc-type"] == "response":
                    if hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(headers["x-payload-length"]):
                        raise ValueError(f"damaged payload in {path}")
                yield {
                    "id": named(headers["warc-record-id"]),
                    "url": headers.get("warc-target-uri"),
                    "record_type": headers["warc-type"],
                    "digest": digest,
                    "payload_bytes": int(headers["x-payload-length"]),
                    "refers_to": named(headers["warc-refers-to"]) if "warc-refers-to" in headers else None,
                    "html": payload.decode() if headers["warc-type"] == "response" else None,
                }

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            by_path: dict[str, list[tuple[int, int]]] = {}
            for path, offset, length in zip(*(frame.column(c).to_pylist() for c in ("path", "offset", "length")), strict=True):
                by_path.setdefault(path, []).append((offset, length))
            for path, wanted in by_path.items():
                held, size = [], 0
                for row in rows(path, sorted(wanted)):
                    held.append(row)
                    size += len(row["html"] or "")
                    if size > READ_AHEAD:
                        yield pa.RecordBatch.from_pylist(held, fields)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, fields)

    return index.mapInArrow(
        read, "id long, url string, record_type string, digest string, payload_bytes long, refers_to long, html string"
    )
