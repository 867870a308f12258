"""WARC records in ZIP archives: a writer, and a reader by byte ranges.

Writing: each task packs its rows into archives. An archive holds two *stored*
members: ``archive/data.warc.gz`` (one gzip member a record) and
``indexes/index.cdxj`` (a line a record: offset and length in the first member).
Of records with equal payloads of at least ``min_revisit`` bytes, the one with the
largest id is a response and the others revisit it.

Reading: the end record, the ZIP64 locator and end record where there are any, and
the central directory give the members' places. Only the index is read there; its
lines become byte ranges that tasks read and parse, each by itself, without
unpacking the archive.

A task names its archives anew on every attempt and reports those that it has
closed; the report is a written table, so what a lost attempt left behind is never
read. Archives go to the shared folder through Arrow's file systems (local, S3,
HDFS ...).

Defined results: a null payload is empty; rows whose id is null are kept with a
null id and never chosen as the response of a group that has an id; rows that repeat
the largest id of a group are all responses; a null URL leaves out its header; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, batch_of, pick, slices

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: An archive is closed at this many records or payload bytes; a task reads about RANGE_BYTES at once, TASK_BYTES in all.
ARCHIVE_RECORDS, ARCHIVE_BYTES, RANGE_BYTES, TASK_BYTES = 50_000, 1 << 30, 4 << 20, 64 << 20
MIN_REVISIT = 1000


class ArchiveError(ValueError):
    """What was read isn't such an archive."""


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def qualified(spark, path: str) -> str:
    """The path with the scheme that the session's Hadoop settings give it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()  # noqa: SLF001


# --- records -----------------------------------------------------------------


def record_uri(key: str) -> str:
    return f"<urn:page-id:{quote(key, safe='')}>"


def record_key(uri: str) -> str | None:
    return unquote(uri[len("<urn:page-id:") : -1]) if uri.startswith("<urn:page-id:") else None


def to_record(key: str | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: str | None) -> bytes:
    """A WARC/1.1 record; a revisit holds the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_uri(key) if key is not None else f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:?#[]@!$&'()*+,;=~")))
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_uri(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def headers(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """First line, fields (lower-case names) and what follows the blank line."""
    head, blank, rest = block.partition(b"\r\n\r\n")
    if not blank:
        raise ArchiveError("a head without its blank line")
    first, *lines = head.decode("utf-8").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, rest


def parse_record(raw: bytes) -> tuple[str | None, int, str, str, str | None]:
    """``(id, payload bytes, payload digest, type, id of the response)``, checked."""
    version, warc, block = headers(raw)
    if not version.startswith("WARC/"):
        raise ArchiveError(f"not a WARC record: {version[:20]!r}")
    block = block[: int(warc["content-length"])]
    _, http, payload = headers(block)
    kind, algorithm, stated = warc["warc-type"], *warc["warc-payload-digest"].partition(":")[::2]
    digest = base64.b32decode(stated).hex()
    if kind == "response" and (algorithm != "sha1" or hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
        raise ArchiveError(f"the payload of {warc['warc-record-id']} isn't what its head states")
    refers = record_key(warc["warc-refers-to"]) if kind == "revisit" else None
    return record_key(warc["warc-record-id"]), int(http["content-length"]), digest, kind, refers


# --- archives ----------------------------------------------------------------


def write_archive(path: str, rows: Iterator[tuple]) -> int:
    """Rows of ``to_record``'s arguments -> records written, until the archive is full."""
    where, name = file_system(path)
    where.create_dir(name.rpartition("/")[0], recursive=True)
    lines: list[str] = []
    at = size = 0
    with where.open_output_stream(name) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as data:
            for row in rows:
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                own = pack.compress(to_record(*row)) + pack.flush()
                data.write(own)
                lines.append(json.dumps({"id": row[0], "offset": at, "length": len(own)}))
                at += len(own)
                size += len(row[2])
                if len(lines) >= ARCHIVE_RECORDS or size >= ARCHIVE_BYTES:
                    break
        with z.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            index.write("".join(f"page {line}\n" for line in lines).encode())
    return len(lines)


def write_all(folder: str, rows: Iterator[tuple]) -> Iterator[tuple[str, int, int]]:
    """All rows in as many archives as they fill: ``(path, records, bytes)`` of each."""
    for row in rows:
        path = f"{folder}/{uuid.uuid4().hex}.wacz"
        # not a generator over `rows`: the writer leaves it when an archive is full, and it would close `rows` with it
        records = write_archive(path, chain([row], rows))
        where, name = file_system(path)
        yield path, records, where.get_file_info(name).size


def read_at(f, at: int, n: int) -> bytes:
    f.seek(at)
    got = f.read(n)
    if len(got) != n:
        raise ArchiveError(f"{n} bytes wanted at {at}, {len(got)} there")
    return got


def members(f, size: int) -> dict[str, tuple[int, int]]:
    """``name -> (first byte of its data, bytes)`` of the stored members."""
    tail_at = max(0, size - 65_557)  # the end record and the longest comment
    tail = read_at(f, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0 or len(tail) - end < 22:
        raise ArchiveError("no end record of a ZIP archive")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = tail_at + end - 20
    if (count == 0xFFFF or 0xFFFFFFFF in (length, start)) and locator >= 0:
        sign, _, at, _ = struct.unpack("<4sIQI", read_at(f, locator, 20))
        if sign != b"PK\x06\x07":
            raise ArchiveError("the ZIP64 locator is missing")
        record = read_at(f, at, 56)
        if record[:4] != b"PK\x06\x06":
            raise ArchiveError("the ZIP64 end record is missing")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, found = read_at(f, start, length), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ArchiveError("an entry of the central directory is missing")
        method, packed, plain = struct.unpack_from("<H", directory, at + 10)[0], *struct.unpack_from("<II", directory, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, at + 28)
        offset = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8")
        extra, k = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):  # the wide fields stand in this order, each only if its narrow one is full
            kind, own = struct.unpack_from("<HH", extra, k)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{own // 8}Q", extra, k + 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            k += 4 + own
        if method == 0 and packed == plain:
            local = read_at(f, offset, 30)
            if local[:4] != b"PK\x03\x04":
                raise ArchiveError(f"the local header of {name} is missing")
            found[name] = (offset + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
        at += 46 + n_name + n_extra + n_comment
    return found


def ranges(path: str) -> Iterator[tuple[int, list[int]]]:
    """``(first byte in the archive, lengths of the records that follow)`` of about RANGE_BYTES."""
    where, name = file_system(path)
    with where.open_input_file(name) as f:
        found = members(f, f.size())
        if DATA not in found or INDEX not in found:
            raise ArchiveError(f"{path} lacks a stored {DATA} or {INDEX}")
        first, _ = found[DATA]
        start, lengths, expected = first, [], first
        for line in read_at(f, *found[INDEX]).decode().splitlines():
            entry = json.loads(line.partition(" ")[2])
            if lengths and (sum(lengths) >= RANGE_BYTES or first + entry["offset"] != expected):
                yield start, lengths
                lengths = []
            if not lengths:
                start = first + entry["offset"]
            lengths.append(entry["length"])
            expected = first + entry["offset"] + entry["length"]
        if lengths:
            yield start, lengths


# --- Spark -------------------------------------------------------------------


def write_archives(df: DataFrame, scratch: Scratch, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Writes every row; a table of the archives: ``path, records, bytes``."""
    rows = pick(df, id=id_col, url=url_col, html=payload_col)
    rows = rows.withColumn("payload", F.encode(F.coalesce("html", F.lit("")), "UTF-8")).drop("html").withColumn("digest", F.sha1("payload"))
    big = F.octet_length("payload") >= min_revisit
    groups = rows.where(big).groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    # a common payload is one row of `groups`, which is written: with a plain shuffle on both sides AQE may split its rows
    rows = rows.join(scratch.table(groups.select("digest", "first"), "repeated"), "digest", "left")
    refers = F.when(big & ~F.col("first").eqNullSafe(F.col("id")), F.col("first").cast("string"))
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "payload", "digest", refers.alias("refers_to"))
    folder = qualified(scratch.spark, scratch.path("archives"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for b in batches:
                for part in slices(b):
                    yield from zip(*(part.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "refers_to")))

        for path, records, size in write_all(folder, each()):
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([records], pa.int64()), "bytes": pa.array([size], pa.int64())})

    return scratch.table(rows.mapInArrow(run, "path string, records bigint, bytes bigint"), "archives-written")


def read_tasks(archives: int, size: int, cores: int) -> tuple[int, int]:
    """Tasks that read the directories and indexes, and tasks that read the records.

    Both grow with the archives; small ones are spread over the cores. Numbers are stated, as
    Spark would put rows this small, whatever work is behind them, into one task.
    """
    ranges_ = -(-size // RANGE_BYTES)
    return max(1, min(archives, max(cores, archives // 16))), max(1, min(ranges_, cores), -(-size // TASK_BYTES))


def read_archives(spark, archives: DataFrame, id_type: str = "bigint", id_col: str = "page_id") -> DataFrame:
    """``id, payload_bytes, payload_digest, record_type, refers_to`` of every record."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int64()))])
        for b in batches:
            for path in b.column("path").to_pylist():
                found = list(ranges(path))
                yield batch_of(schema, [[path] * len(found), [s for s, _ in found], [n for _, n in found]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())])
        for b in batches:
            for path, start, lengths in zip(*(b.column(c).to_pylist() for c in ("path", "start", "lengths"))):
                where, name = file_system(path)
                with where.open_input_file(name) as f:
                    raw, at, out = memoryview(read_at(f, start, sum(lengths))), 0, []
                for n in lengths:
                    out.append(parse_record(zlib.decompress(raw[at : at + n], 31)))
                    at += n
                yield batch_of(schema, zip(*out))

    n, size = archives.agg(F.count("path"), F.sum("bytes")).first()
    finders, readers = read_tasks(n, size or 0, spark.sparkContext.defaultParallelism)
    places = archives.select("path").repartition(finders, "path").mapInArrow(find, "path string, start bigint, lengths array<bigint>")
    # rows of a few numbers, dealt evenly whatever archive they lie in
    places = places.repartition(readers, F.xxhash64("path", "start"))
    rows = places.mapInArrow(read, "id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string")
    return rows.select(F.col("id").cast(id_type).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))


def round_trip(df: DataFrame, scratch: Scratch, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes all rows to archives and reads them back."""
    archives = write_archives(df, scratch, id_col=id_col, url_col=url_col, payload_col=payload_col)
    return read_archives(scratch.spark, archives, pick(df, id=id_col).schema["id"].dataType.simpleString(), id_col)
