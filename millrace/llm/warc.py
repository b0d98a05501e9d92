"""WARC archives as a PySpark data source, `spark.read.format("warc")`, and a writer of the same name.

Reading. `path` is a folder, one file or several (comma); files are dealt out in partitions of about
`split_bytes`. Records are read header first. Predicates on `record_type` and the other header
columns are given with the load (`read_archive`, or the option `predicates`) and tested on the header; the
payload of an unwanted record is neither inflated nor decoded: its length is skipped, by the member
size kept in the gzip extra field of our own files, or by Content-Length in plain ones. `decode`
names the record types whose payload is wanted (default all; empty: none).

With the option `pushdown` the predicates of a query's WHERE are taken as well (`register` allows it). It is
off unless asked for, as Spark 4.1 keeps the reader that was last given some: a frame so loaded serves one
query, a second one may be answered with the predicates of the first. Other frames serve any number.

Writing. One gzip member per record, files of at most `file_bytes`. Tasks write under names of their
own in a folder of the write job; the commit, which Spark runs once, moves the files of the tasks that won and
deletes that folder, so a lost or repeated task leaves nothing behind in the archive, and several jobs may
append at once. A job that overwrites deletes what was committed before its own commit.

Files are reached through `pyarrow.fs` (local, HDFS, S3, GCS), never by `open`.

Defined results: null payloads and texts are empty, a null URL is left out of the header and read as
null; line breaks inside header values become `%0D` and `%0A`; an archive without records reads as an
empty table; records of unknown type are read like any other. A record cut off by the end of its file
raises an error.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

SCHEMA = """record_type string, record_id string, target_uri string, date string, content_type string,
    payload_digest string, refers_to string, payload_length long, payload binary"""
#: Header columns and the fields they come from. `X-Payload-Length` is ours: the length before revisits drop the payload.
FIELDS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
    "payload_length": "X-Payload-Length",
}
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"
SUBFIELD = b"SL"  # gzip extra subfield: size of the whole member
READ_BYTES = 1 << 16
BATCH_BYTES = 8 << 20


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- records


def _member(record: bytes) -> bytes:
    """One gzip member that tells its own size."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = SUBFIELD + struct.pack("<HQ", 8, size)
    return (
        b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body
        + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    )


def _clean(value: object) -> str:
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(head: dict[str, object], block: bytes) -> bytes:
    lines = [VERSION.decode(), *(f"{k}: {_clean(v)}" for k, v in head.items() if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    found = {k.strip().lower(): v.strip() for k, _, v in pairs}
    return found


def _payload(fields: dict[str, str], block: bytes) -> bytes:
    """Without the HTTP head that a response carries."""
    if "msgtype=response" in fields.get("content-type", ""):
        return block.partition(b"\r\n\r\n")[2]
    return block


class _Input:
    """A file read forward, with bytes that are looked at and skipped."""

    def __init__(self, handle: pa.NativeFile):
        self.handle, self.rest = handle, b""

    def peek(self, n: int) -> bytes:
        while len(self.rest) < n:
            more = self.handle.read(max(READ_BYTES, n - len(self.rest)))
            if not more:
                break
            self.rest += more
        return self.rest[:n]

    def take(self, n: int) -> bytes:
        got = self.peek(n)
        if len(got) < n:
            raise EOFError("the file ends inside a record")
        self.rest = self.rest[n:]
        return got

    def skip(self, n: int) -> None:
        if n <= len(self.rest):
            self.rest = self.rest[n:]
        else:
            self.handle.seek(self.handle.tell() + n - len(self.rest))
            self.rest = b""


def _plain_records(source: _Input, wanted, decode) -> Iterator[tuple[dict, bytes | None]]:
    while source.peek(1):
        if source.peek(2) == b"\r\n":
            source.skip(2)
            continue
        n = READ_BYTES
        while b"\r\n\r\n" not in (seen := source.peek(n)):
            if len(seen) < n:
                raise EOFError("the file ends inside a record")
            n *= 2
        head = source.take(seen.index(b"\r\n\r\n") + 4)
        fields = _fields(head)
        length = int(fields["content-length"])
        if wanted(fields) and decode(fields):
            yield fields, _payload(fields, source.take(length))
        else:
            if wanted(fields):
                yield fields, None
            source.skip(length)


def _member_size(source: _Input) -> int | None:
    """From the extra field; None in files of other writers."""
    head = source.peek(12)
    if len(head) == 12 and head[3] & 4:
        extra = source.peek(12 + struct.unpack("<H", head[10:12])[0])[12:]
        while len(extra) >= 4:
            n = struct.unpack("<H", extra[2:4])[0]
            if extra[:2] == SUBFIELD and n == 8:
                return struct.unpack("<Q", extra[4:12])[0]
            extra = extra[4 + n :]
    return None


def _gzip_records(source: _Input, wanted, decode) -> Iterator[tuple[dict, bytes | None]]:
    while source.peek(1):
        size = _member_size(source)
        inflate, record, used = zlib.decompressobj(31), b"", 0
        while b"\r\n\r\n" not in record and not inflate.eof:  # the header only
            step = source.peek(min(size, used + 4096) if size else used + 4096)[used:]
            if not step:
                raise EOFError("the file ends inside a record")
            record += inflate.decompress(step)
            used += len(step)
        at = record.index(b"\r\n\r\n") + 4
        fields = _fields(record[:at])
        keep = wanted(fields)
        if size and not (keep and decode(fields)):
            source.skip(size)
            if keep:
                yield fields, None
            continue
        source.skip(used)
        parts = [record]
        while not inflate.eof:
            step = source.peek(min(READ_BYTES, size - used) if size else READ_BYTES)
            if not step:
                raise EOFError("the file ends inside a record")
            parts.append(inflate.decompress(step))
            source.skip(len(step))
            used += len(step)
        source.rest = inflate.unused_data + source.rest
        if keep:
            length = int(fields["content-length"])
            block = b"".join(parts)[at : at + length] if decode(fields) else None
            yield fields, None if block is None else _payload(fields, block)


def read_records(path: str, wanted=lambda f: True, decode=lambda f: True) -> Iterator[tuple[dict, bytes | None]]:
    fs, name = _place(path)
    with fs.open_input_file(name) as handle:
        source = _Input(handle)
        yield from (_gzip_records if source.peek(2) == b"\x1f\x8b" else _plain_records)(source, wanted, decode)


# ---------------------------------------------------------------- data source


def _column(fields: dict[str, str], name: str) -> str | int | None:
    value = fields.get(FIELDS[name].lower())
    if name in ("record_id", "refers_to") and value is not None:
        return value.strip("<>")
    return int(value) if name == "payload_length" and value is not None else value


_TESTS = {
    EqualTo: lambda a, b: a is not None and a == b, EqualNullSafe: lambda a, b: a == b,
    GreaterThan: lambda a, b: a is not None and a > b, GreaterThanOrEqual: lambda a, b: a is not None and a >= b,
    LessThan: lambda a, b: a is not None and a < b, LessThanOrEqual: lambda a, b: a is not None and a <= b,
    In: lambda a, b: a is not None and a in b, StringStartsWith: lambda a, b: a is not None and a.startswith(b),
    StringEndsWith: lambda a, b: a is not None and a.endswith(b), StringContains: lambda a, b: a is not None and b in a,
    IsNull: lambda a, b: a is None, IsNotNull: lambda a, b: a is not None,
}


def _supported(f: Filter) -> bool:
    if isinstance(f, Not):  # not over a null is null in SQL, so only tests that are never null are turned round
        return isinstance(f.child, (IsNull, IsNotNull, EqualNullSafe)) and _supported(f.child)
    return type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in FIELDS


def _holds(f: Filter, fields: dict[str, str]) -> bool:
    if isinstance(f, Not):
        return not _holds(f.child, fields)
    return _TESTS[type(f)](_column(fields, f.attribute[0]), getattr(f, "value", None))


@dataclass
class Files(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


def predicates_text(predicates: list[Filter]) -> str:
    """Predicates on header columns as the option `predicates`."""
    out = []
    for f in predicates:
        if not _supported(f):
            raise ValueError(f"no predicate on the header: {f}")
        turned = isinstance(f, Not)
        f = f.child if turned else f
        out.append([type(f).__name__, f.attribute[0], getattr(f, "value", None), turned])
    return json.dumps(out)


def _predicates(text: str) -> list[Filter]:
    kinds = {kind.__name__: kind for kind in _TESTS}
    found = []
    for name, column, value, turned in json.loads(text):
        kind = kinds[name]
        test = kind((column,)) if kind in (IsNull, IsNotNull) else kind((column,), tuple(value) if kind is In else value)
        found.append(Not(test) if turned else test)
    return found


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.paths = [p for p in options.get("path", "").split(",") if p]
        self.split_bytes = int(options.get("split_bytes", 64 << 20))
        self.decode = None if "decode" not in options else {x for x in options["decode"].split(",") if x}
        self.filters = _predicates(options.get("predicates", "[]"))
        self.names = [f.name for f in schema.fields]

    def partitions(self) -> list[Files]:
        files = []
        for path in self.paths:
            fs, name = _place(path)
            scheme = path[: len(path) - len(name)] if path.endswith(name) else ""
            info = fs.get_file_info(name)
            found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(name, recursive=False))
            files += [(scheme + x.path, x.size) for x in found if x.is_file and not x.base_name.startswith(("_", "."))]
        parts, room = [], 0
        for path, size in sorted(files):
            if not parts or room + size > self.split_bytes:
                parts.append(Files([]))
                room = 0
            parts[-1].paths.append(path)
            room += size
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kinds = {"payload": pa.binary(), "payload_length": pa.int64()}
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in self.names])
        rows: list[dict] = []
        held = 0
        for path in partition.paths:
            wanted = lambda fields: all(_holds(f, fields) for f in self.filters)
            decode = lambda fields: self.decode is None or fields.get("warc-type") in self.decode
            for fields, payload in read_records(path, wanted, decode):
                rows.append({n: payload if n == "payload" else _column(fields, n) for n in self.names})
                held += len(payload or b"") + 500
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)


class PushingReader(WarcReader):
    def pushFilters(self, filters: list[Filter]):
        self.filters = self.filters + [f for f in filters if _supported(f)]
        return [f for f in filters if not _supported(f)]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows of SCHEMA (any of its columns; `record_type` is needed)."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.file_bytes = int(options.get("file_bytes", 64 << 20))
        self.folder = f"_temporary-{uuid.uuid4().hex}"  # of this job; tasks and the commit get a copy of the writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _place(self.path)
        fs.create_dir(f"{root}/{self.folder}", recursive=True)
        names: list[str] = []
        out = None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or out.tell() >= self.file_bytes:
                    if out is not None:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = fs.open_output_stream(f"{root}/{self.folder}/{names[-1]}", compression=None)
                out.write(_member(self._record(row)))
        if out is not None:
            out.close()
        return Written(names)

    @staticmethod
    def _record(row: dict) -> bytes:
        head = {FIELDS[n]: row.get(n) for n in FIELDS}
        head["WARC-Date"] = head["WARC-Date"] or NO_DATE
        for name in ("WARC-Record-ID", "WARC-Refers-To"):
            head[name] = head[name] and f"<{head[name]}>"
        payload = row.get("payload") or b""
        if row["record_type"] == "response":
            head["Content-Type"] = "application/http; msgtype=response"
            lines = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            payload = lines.encode() + payload
        elif row["record_type"] == "revisit":
            head["WARC-Profile"] = REVISIT_PROFILE
            payload = b""
        return record_bytes(head, payload)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _place(self.path)
        if self.overwrite:
            old = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
            for x in old:
                if x.is_file:
                    fs.delete_file(x.path)
        names = [n for m in messages if m for n in m.names]
        for name in names:
            fs.move(f"{root}/{self.folder}/{name}", f"{root}/{name}")
        fs.create_dir(root, recursive=True)
        self._clear(fs, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_place(self.path))

    def _clear(self, fs: pafs.FileSystem, root: str) -> None:
        if fs.get_file_info(f"{root}/{self.folder}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/{self.folder}")


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        kind = PushingReader if self.options.get("pushdown", "false").lower() == "true" else WarcReader
        return kind(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archive(spark: SparkSession, path: str, predicates: list[Filter] = (), decode: list[str] | None = None) -> DataFrame:
    """The records that hold all `predicates`; only payloads of the types in `decode` (None: all) are decoded."""
    reader = spark.read.format("warc").option("predicates", predicates_text(list(predicates)))
    if decode is not None:
        reader = reader.option("decode", ",".join(decode))
    return reader.load(path)


def records_of(pages: DataFrame, revisit_bytes: int = 1000) -> DataFrame:
    """Records of `pages` (page_id, url, html), rows of SCHEMA; equal payloads of `revisit_bytes` or more are kept once.

    The row with the largest page_id is the response and the others revisit it. Rows that share this
    largest page_id are all responses; a null page_id is never revisited, unless all are null, and
    then each row is a response. Payloads are compared by digest and length. Only payloads that occur
    more than once take part in the choice; a payload that a third of all rows share meets in one
    group of counts only, and AQE splits its rows in the join.
    """
    rows = pages.select(
        "page_id", F.col("url").alias("target_uri"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    )
    rows = rows.withColumns({"digest": F.sha1("payload"), "payload_length": F.octet_length("payload").cast("long")})
    large = rows.where(F.col("payload_length") >= revisit_bytes)
    kept = large.groupBy("digest", F.col("payload_length").alias("same_length")).agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
    kept = kept.where((F.col("n") > 1) & F.col("kept").isNotNull()).withColumnRenamed("digest", "same").drop("n")
    both = rows.join(kept, (rows.digest == kept.same) & (rows.payload_length == kept.same_length), "left")
    again = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return both.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("record_id"),
        "target_uri", F.lit(NO_DATE).alias("date"), F.lit(None).cast("string").alias("content_type"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.when(again, F.concat(F.lit("urn:page:"), F.col("kept").cast("string"))).alias("refers_to"),
        "payload_length", F.when(~again, F.col("payload")).alias("payload"),
    )
