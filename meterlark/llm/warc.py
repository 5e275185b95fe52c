"""WARC archives: a writer for pages and a Python data source that reads archives.

The writer stores one record per page, each a gzip member of its own. Pages with equal payloads
are stored once: the page with the largest id is a `response`, the others are `revisit` records
that refer to it and keep their HTTP headers only. Every member carries its compressed length in
a gzip extra field, so the reader can go on to the next member without inflating the rest of one
that it does not want; members without the field are inflated to their end.

The data source plans partitions of whole files, evaluates predicates on record type, id, URI,
digest and content type after it has parsed a record's headers, and does not inflate, parse or
check the payload of a record that they reject.

Files are written under names of their own by every attempt of a task. The list of files is
written by Spark's commit protocol, and only listed files are read, so what a lost attempt has
left behind is never seen.

Null payloads are empty, null URIs are left out, null ids are kept as such and count as smaller
than any other. Control characters in a URI are percent-encoded. Rows that repeat an id and a
payload are all responses if the id is the largest with that payload. A payload of any length is
kept whole, one at a time in memory. No pages give no files, and reading none gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition
from pyspark.sql.types import StructType

from meterlark.llm.common import store
from meterlark.session import fresh_path, materialize

#: A file is closed when it has more compressed bytes than this.
FILE_BYTES = 1 << 30
#: Files up to this many bytes together are read by one task.
PARTITION_BYTES = 64 << 20
#: Payloads from this length on, in bytes, are stored once.
LEAST_SHARED = 0
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, content_type string, content_length bigint, "
    "refers_to string, payload_digest string, payload_bytes bigint, payload binary, file string, offset bigint"
)
#: Columns that predicates may test before a payload is touched, and their headers.
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "content_type": "content-type",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}


# ---------------------------------------------------------------- writing


def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_SHARED) -> DataFrame:
    """(key, url, payload binary, digest hex, record_type, refers_to) of each page.

    The largest id per payload is found by an aggregate that each task begins for its own rows;
    the join back may meet a payload of very many pages, which adaptive skew handling splits.
    """
    body = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b"")) if dict(pages.dtypes)[payload] == "string" else F.coalesce(F.col(payload), F.lit(b""))
    rows = pages.select(F.col(key).alias("_id"), F.col(url).alias("_url"), body.alias("_body")).withColumn("_hash", F.sha1("_body"))
    largest = rows.groupBy("_hash").agg(F.max("_id").alias("_largest"))
    again = (F.length("_body") >= least) & F.col("_largest").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_largest"))
    return rows.join(largest, "_hash").select(
        F.col("_id").alias(key),
        F.col("_url").alias("url"),
        F.col("_body").alias("payload"),
        F.col("_hash").alias("digest"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_largest")).alias("refers_to"),
    )


def page_urn(key) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def record_bytes(key, url: str | None, payload: bytes, digest: str, record_type: str, refers_to, date: str = DATE) -> bytes:
    """One record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if record_type == "revisit" else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: {page_urn(key)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if record_type == "revisit":
        head += [f"WARC-Refers-To: {page_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose extra field `SL` holds the length of the whole member."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(data) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"SL" + struct.pack("<HQ", 8, total)
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def write(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write records as from `with_revisits`; returns the files (file, records, bytes). Runs a job."""
    spark = records.sparkSession
    folder = folder or fresh_path(spark, "warc")
    fs, path = store(folder)
    fs.create_dir(path, recursive=True)

    def run(batches):
        name, out, count, size = None, None, 0, 0
        for batch in batches:
            for k in range(batch.num_rows):
                if out is None:
                    name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    where, at = store(name)
                    out, count, size = where.open_output_stream(at, compression=None), 0, 0
                size += out.write(data := member(record_bytes(*(c[k].as_py() for c in batch.columns)))) or len(data)
                count += 1
                if size > FILE_BYTES:
                    out.close()
                    yield listed(name, count, size)
                    out = None
        if out is not None:
            out.close()
            yield listed(name, count, size)

    def listed(name, count, size):
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], ["file", "records", "bytes"])

    return materialize(records.mapInArrow(run, "file string, records long, bytes long"), "warc-files")


# ---------------------------------------------------------------- reading


class FilePart(InputPartition):
    """Some files that one task reads."""

    def __init__(self, files: list[str]) -> None:
        self.files = files


class WarcSource(DataSource):
    """`spark.read.format("warc")` with the options

    path: a file, a folder, or a JSON list of [file, bytes]; payload: false leaves payloads out;
    verify: true checks digests; wanted: JSON of header column to accepted values; pushdown: true
    also takes the query's own filters. Spark keeps what a relation has taken over, so with
    pushdown every query needs a relation of its own, loaded anew.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        options = {k.lower(): v for k, v in dict(self.options).items()}
        return (PushingWarcReader if options.get("pushdown", "false") == "true" else WarcReader)(options)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options.get("path", "[]")
        self.payload = options.get("payload", "true") == "true"
        self.verify = options.get("verify", "false") == "true"
        self.wanted = {c: set(values) for c, values in json.loads(options.get("wanted", "{}")).items()}
        if not self.wanted.keys() <= HEADERS.keys():
            raise ValueError(f"only {', '.join(HEADERS)} can be tested before a payload is read")

    def partitions(self) -> list[FilePart]:
        parts, held, size = [], [], 0
        for name, length in sorted(self._files()):
            if held and size + length > PARTITION_BYTES:
                parts.append(FilePart(held))
                held, size = [], 0
            held.append(name)
            size += length
        return [*parts, FilePart(held)]

    def _files(self) -> list[tuple[str, int]]:
        if self.path.startswith("["):
            return [(f, n) for f, n in json.loads(self.path)]
        fs, path = store(self.path)
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [(self.path, info.size)]
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True))
        prefix = self.path.rstrip("/")
        return [(prefix + f.path[len(path.rstrip("/")) :], f.size) for f in found if f.path.endswith((".warc", ".warc.gz"))]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.split()[0], {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in SCHEMA.split(", ")])
        rows, size = [], 0
        for name in partition.files:
            for row in self.records(name):
                rows.append(row)
                size += len(row["payload"] or b"")
                if len(rows) >= 500 or size > 8_000_000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    def records(self, name: str) -> Iterator[dict]:
        fs, path = store(name)
        with fs.open_input_file(path) as f:
            gzipped = f.read(2) == b"\x1f\x8b"
            f.seek(0)
            for offset, head, rest in _gzipped(f) if gzipped else _plain(f):
                fields = _fields(head)
                row = {c: fields.get(h) for c, h in HEADERS.items()}
                row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:") or None
                if all(row[c] in values for c, values in self.wanted.items()):
                    yield row | self._body(fields, rest, row["payload_digest"]) | {"file": name, "offset": offset}

    def _body(self, fields: dict[str, str], rest, digest: str | None) -> dict:
        length = int(fields.get("content-length", 0))
        out = {"content_length": length, "payload": None, "payload_bytes": None}
        http = fields.get("content-type", "").startswith("application/http")
        if not (self.payload or self.verify or http):
            return out
        revisit = fields.get("warc-type") == "revisit"
        if not (self.payload or self.verify):
            block = b""
            while b"\r\n\r\n" not in block and (more := rest(4096)):
                block += more
        else:
            block = rest(length)
        body = block
        if http:
            head, gap, body = block.partition(b"\r\n\r\n")
            stated = _fields(head).get("content-length") if revisit else None
            out["payload_bytes"] = int(stated) if stated else length - len(head) - len(gap)
        else:
            out["payload_bytes"] = len(body)
        if not revisit and (self.payload or self.verify):
            if self.verify and digest and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                raise ValueError(f"the payload of {fields.get('warc-record-id')} has another digest than stated")
            if self.payload:
                out["payload"] = body
        return out


class PushingWarcReader(WarcReader):
    """Takes equality and IN on header columns from the query."""

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            name = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            values = [f.value] if isinstance(f, EqualTo) else f.value if name else []
            if name in HEADERS and all(isinstance(v, str) for v in values):
                self.wanted[name] = self.wanted.get(name, set(values)) & set(values)
            else:
                yield f


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def _length(head: bytes, offset: int) -> int:
    stated = _fields(head).get("content-length", "")
    if not head.startswith(b"WARC/") or not stated.isdigit():
        raise ValueError(f"no record begins at byte {offset}")
    return int(stated)


def _plain(f) -> Iterator:
    """(offset, headers, function that returns the next bytes of the block) of each record of a plain file."""
    end, offset = f.size(), 0
    while offset < end:
        f.seek(offset)
        head, more = b"", b"-"
        while b"\r\n\r\n" not in head.lstrip(b"\r\n") and more:
            more = f.read(4096)
            head += more
        blank = len(head) - len(head.lstrip(b"\r\n"))
        if blank == len(head):
            offset += len(head)
            continue
        offset, head = offset + blank, head[blank:]
        start = head.find(b"\r\n\r\n") + 4
        if start < 4:
            raise ValueError(f"the record at byte {offset} has no end of headers")
        length = _length(head[:start], offset)
        if offset + start + length > end:
            raise ValueError(f"the record at byte {offset} is cut")
        left = [offset + start, length]

        def rest(n, left=left):
            f.seek(left[0])
            data = f.read(min(n, left[1]))
            left[:] = left[0] + len(data), left[1] - len(data)
            return data

        yield offset, head[: start - 4], rest
        offset += start + length


class _Member:
    """The inflated bytes of a gzip member, as far as they are asked for."""

    def __init__(self, f, offset: int) -> None:
        self.f, self.offset, self.at = f, offset, offset
        self.inflate = zlib.decompressobj(16 + zlib.MAX_WBITS)
        self.raw, self.data = b"", bytearray()

    def fill(self, n: int) -> bool:
        """Hold at least n bytes; False if the member ends before."""
        while len(self.data) < n and not self.inflate.eof:
            if not self.raw:
                self.f.seek(self.at)
                self.raw = self.f.read(4096 if self.at == self.offset else 1 << 16)
                self.at += len(self.raw)
            ended = not self.raw
            try:
                more = self.inflate.decompress(self.raw, max(4096, n - len(self.data)))
            except zlib.error as error:
                raise ValueError(f"the member at byte {self.offset} is broken: {error}") from error
            self.raw = self.inflate.unconsumed_tail
            if ended and not more and not self.inflate.eof:
                raise ValueError(f"the member at byte {self.offset} is cut")
            self.data += more
        return len(self.data) >= n

    def head(self) -> bytes | None:
        """Headers of the next record, with the blank line; None at the end of the member."""
        while self.fill(1) and self.data[0] in b"\r\n":
            del self.data[0]
        while self.data:
            at = self.data.find(b"\r\n\r\n")
            if at >= 0:
                return self.take(at + 4)
            held = len(self.data)
            if not self.fill(held + 4096) and len(self.data) == held:
                raise ValueError(f"a record in the member at byte {self.offset} has no end of headers")
        return None

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError(f"a record in the member at byte {self.offset} is cut")
        data = bytes(self.data[:n])
        del self.data[:n]
        return data

    def end(self) -> int:
        """Where the next member begins; the member was read to its end."""
        return self.at - len(self.inflate.unused_data)


def _gzipped(f) -> Iterator:
    """The same for a file of gzip members, whose offset counts for each of their records.

    Members that state their length, as `member` writes them, hold one record and are skipped
    without being inflated. Others may hold any number of records.
    """
    end, offset = f.size(), 0
    while offset < end:
        f.seek(offset)
        first = f.read(24)
        if not first.strip(b"\0"):
            offset += len(first)
            continue
        total = struct.unpack("<Q", first[16:24])[0] if first[:4] == b"\x1f\x8b\x08\x04" and first[12:14] == b"SL" and len(first) == 24 else None
        if total is not None and offset + total > end:
            raise ValueError(f"the member at byte {offset} is cut")
        member = _Member(f, offset)
        while (head := member.head()) is not None:
            left = [_length(head, offset)]

            def rest(n, left=left, member=member):
                data = member.take(min(n, left[0]))
                left[0] -= len(data)
                return data

            yield offset, head[:-4], rest
            if total is not None:
                break
            while left[0]:
                rest(1 << 16)
        offset = member.end() if total is None else offset + total


def read(spark: SparkSession, files: DataFrame | str, payload: bool = True, verify: bool = False, **wanted: list[str]) -> DataFrame:
    """Records of the files that `write` returned, or of a path.

    `wanted` names header columns and the values to accept, as in record_type=["revisit"]; other
    records are skipped after their headers. The names of files go to the driver, as with any file
    source; their number follows from FILE_BYTES and the number of tasks that wrote.
    """
    spark.dataSource.register(WarcSource)
    if not isinstance(files, str):
        files = json.dumps([[r["file"], r["bytes"]] for r in files.toLocalIterator()])
    options = {"path": files, "payload": str(payload).lower(), "verify": str(verify).lower(), "wanted": json.dumps(wanted)}
    return spark.read.format("warc").options(**options).load()


def page_id(column: str) -> F.Column:
    """The page's id from a record id as `page_urn` makes it."""
    return F.regexp_extract(column, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


