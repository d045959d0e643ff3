"""Web-archive files: records written, scanned, and read by the (file, offset, length) of an index.

An archive file is a sequence of gzip members of one record each, so that a byte range of the index is a record of its own. A
record is framed by its headers and ``Content-Length``; the body of an HTTP response by its own ``Content-Length`` or by chunks,
and unpacked where ``Content-Encoding`` says gzip or deflate.

* ``scan``: all records of the files of a folder, one task per file. A member's end is where its decompressor says, so bytes of a
  payload that look like a record or a member split nothing. Files that are not gzip, and members that hold several records, are
  framed the same way.
* ``read_index``: the records of index rows, range-partitioned by (file, offset): a task opens a file once and reads forward, and a
  file that owns most rows is many tasks.
* ``write``: rows as archive files with an index file beside each, by a Spark data source. Tasks write into a folder of the job; the
  commit moves whole files out of it, and it is removed on commit and on abort, so a failed task leaves nothing behind.

Both readers give COLUMNS: one row per record. What breaks a record is named in ``error`` and the rest is kept: ``short`` (fewer
bytes than declared), ``chunk`` (broken chunk sizes), ``encoding`` (the body does not unpack), ``header`` (no record at that place),
``missing`` (no such file). An empty payload is null. Null or empty file names and lengths below 1 in an index give a row with ``header``.
"""

from __future__ import annotations

import json
import posixpath
import sys
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from deckmill.sources.shards import opened

# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COLUMNS = ("filename string, offset bigint, length bigint, record_id string, record_type string, url string, archived_at string, "
           "status int, mime string, payload binary, error string")
_ARROW = pa.schema([("filename", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()),
                    ("record_type", pa.string()), ("url", pa.string()), ("archived_at", pa.string()), ("status", pa.int32()), ("mime", pa.string()),
                    ("payload", pa.binary()), ("error", pa.string())])
READ_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
SUFFIXES = (".warc", ".warc.gz")


def _headers(block: bytes) -> tuple[bytes, dict[str, str]]:
    """First line and headers of a block; names in lower case, the last of equal names stays."""
    first, *lines = block.split(b"\r\n")
    found = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if colon:
            found[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return first, found


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and text.isascii() and text.isdigit() else None


def unchunked(body: bytes) -> tuple[bytes, str]:
    """The bytes of a chunked body, and ``chunk`` where its sizes break off."""
    out, at = [], 0
    while True:
        line_end = body.find(b"\r\n", at)
        size_text = body[at:line_end].split(b";")[0].strip() if line_end >= 0 else b""
        try:
            size = int(size_text, 16) if size_text and not size_text.startswith((b"-", b"+")) else -1
        except ValueError:
            size = -1
        if size < 0:
            return b"".join(out), "chunk"
        if size == 0:
            return b"".join(out), ""
        part = body[line_end + 2:line_end + 2 + size]
        out.append(part)
        at = line_end + 2 + size
        if len(part) < size or body[at:at + 2] != b"\r\n":
            return b"".join(out), "chunk"
        at += 2


def unpacked(body: bytes, encoding: str) -> tuple[bytes, str]:
    """A body without its gzip or deflate encoding; as it is, with ``encoding``, where it does not unpack."""
    if encoding not in ("gzip", "x-gzip", "deflate"):
        return body, ""
    for bits in ((31,) if encoding != "deflate" else (15, -15)):
        opener = zlib.decompressobj(bits)
        try:
            out = opener.decompress(body) + opener.flush()
        except zlib.error:
            continue
        if opener.eof:
            return out, ""
    return body, "encoding"


def http_body(block: bytes) -> tuple[int | None, str | None, bytes, str]:
    """(status, mime, payload, error) of an HTTP response."""
    head, blank, body = block.partition(b"\r\n\r\n")
    first, headers = _headers(head)
    if not blank or not first.startswith(b"HTTP/"):
        return None, None, b"", "header"
    words = first.split()
    status = _number(words[1].decode("latin-1")) if len(words) > 1 else None
    error = ""
    if headers.get("transfer-encoding", "").lower() == "chunked":
        body, error = unchunked(body)
    else:
        declared = _number(headers.get("content-length"))
        if declared is not None:
            error = "short" if len(body) < declared else ""
            body = body[:declared]
    if not error:
        body, error = unpacked(body, headers.get("content-encoding", "").lower())
    mime = headers.get("content-type", "").split(";")[0].strip().lower() or None
    return status, mime, body, error


def records(data: bytes) -> Iterator[dict]:
    """The records of unpacked bytes, framed by their declared lengths."""
    at = 0
    while at < len(data):
        while data[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        head_end = data.find(b"\r\n\r\n", at)
        first, headers = _headers(data[at:head_end if head_end >= 0 else len(data)])
        if head_end < 0 or not first.startswith(b"WARC/"):
            yield {"error": "header"}
            return
        declared = _number(headers.get("content-length"))
        block = data[head_end + 4:None if declared is None else head_end + 4 + declared]
        error = "short" if declared is None or len(block) < declared else ""
        row = {"record_id": headers.get("warc-record-id"), "record_type": headers.get("warc-type"), "url": headers.get("warc-target-uri"),
               "archived_at": headers.get("warc-date"), "payload": block}
        if headers.get("content-type", "").replace(" ", "").lower().startswith("application/http") and row["record_type"] == "response":
            row["status"], row["mime"], row["payload"], http_error = http_body(block)
            error = error or http_error
        else:
            row["mime"] = headers.get("content-type")
        row["payload"], row["error"] = row["payload"] or None, error
        yield row
        at = head_end + 4 + len(block)


def members(stream: Iterable[bytes]) -> Iterator[tuple[int, int, bytes, str]]:
    """(offset, length, unpacked bytes, error) of every gzip member of a file that comes in pieces; a file that is no gzip is
    one member."""
    at, rest, pieces = 0, b"", iter(stream)
    while True:
        while len(rest) < 2 and (piece := next(pieces, None)) is not None:
            rest += piece
        if not rest:
            return
        if not rest.startswith(b"\x1f\x8b"):
            data = rest + b"".join(pieces)
            yield at, len(data), data, ""
            return
        opener, out, size, error = zlib.decompressobj(31), [], 0, ""
        while not opener.eof:
            if not rest:
                rest = next(pieces, b"")
                if not rest:
                    error = "short"
                    break
            try:
                out.append(opener.decompress(rest))
            except zlib.error:
                yield at, size + len(rest), b"".join(out), "encoding"
                return
            size += len(rest) - len(opener.unused_data)
            rest = opener.unused_data
        yield at, size, b"".join(out), error
        at += size


def _pieces(stream: pa.NativeFile) -> Iterator[bytes]:
    while piece := stream.read(READ_BYTES):
        yield piece


def _rows(filename: str | None, offset: int | None, length: int | None, data: bytes, error: str) -> Iterator[dict]:
    place = {"filename": filename, "offset": offset, "length": length}
    found = list(records(data)) or [{"error": "header"}]
    for row in found:
        yield {**place, **row, "error": error or row["error"]}


def _batches(rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("payload") or b"") + 500
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, _ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _ARROW)


class ArchiveFile(InputPartition):
    def __init__(self, name: str):
        self.name = name


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[ArchiveFile]:
        files, folder = opened(self.path)
        found = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return [ArchiveFile(f.base_name) for f in sorted(found, key=lambda f: -f.size) if f.is_file and f.base_name.endswith(SUFFIXES)]

    def read(self, partition: ArchiveFile | None) -> Iterator[pa.RecordBatch]:
        # a folder without archives is one empty partition
        if not isinstance(partition, ArchiveFile):
            return
        files, folder = opened(self.path)

        def rows() -> Iterator[dict]:
            with files.open_input_stream(posixpath.join(folder, partition.name), compression=None) as stream:
                for offset, length, data, error in members(_pieces(stream)):
                    yield from _rows(partition.name, offset, length, data, error)

        yield from _batches(rows())


def _safe(text: str | None) -> str:
    """Header text on one line."""
    return (text or "").replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict) -> bytes:
    """One response record as a gzip member. Bodies are chunked where ``chunked`` is true."""
    body, mime = row.get("payload") or b"", _safe(row.get("mime") or "text/html")
    if row.get("chunked"):
        parts = [body[i:i + 4096] for i in range(0, len(body), 4096)]
        framing = "Transfer-Encoding: chunked"
        body = b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"
    else:
        framing = f"Content-Length: {len(body)}"
    block = f"HTTP/1.1 {row.get('status') or 200} OK\r\nContent-Type: {mime}\r\n{framing}\r\n\r\n".encode() + body
    head = (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: {_safe(row.get('record_id'))}\r\nWARC-Target-URI: {_safe(row.get('url'))}\r\n"
            f"WARC-Date: {_safe(row.get('archived_at'))}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n")
    packer = zlib.compressobj(wbits=31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.job = path, f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = opened(self.path)
        name, offset, stream, index = f"part-{uuid.uuid4().hex}.warc.gz", 0, None, None
        work = posixpath.join(folder, self.job)
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if stream is None:
                        files.create_dir(work, recursive=True)
                        stream = files.open_output_stream(posixpath.join(work, name), compression=None)
                        index = files.open_output_stream(posixpath.join(work, f"{name}.index.json"), compression=None)
                    member = record_bytes(row)
                    stream.write(member)
                    entry = {"url": row.get("url"), "mime": row.get("mime"), "filename": name, "offset": str(offset), "length": str(len(member))}
                    index.write(json.dumps(entry).encode() + b"\n")
                    offset += len(member)
        finally:
            for file in (stream, index):
                if file is not None:
                    file.close()
        return Written(name if stream is not None else None)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = opened(self.path)
        files.create_dir(folder, recursive=True)
        for message in messages:
            if message is not None and message.name is not None:
                for name in (message.name, f"{message.name}.index.json"):
                    files.move(posixpath.join(folder, self.job, name), posixpath.join(folder, name))
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        files, folder = opened(self.path)
        work = posixpath.join(folder, self.job)
        if files.get_file_info(work).type == pafs.FileType.Directory:
            files.delete_dir(work)


class Archives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc_archive"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        if overwrite:
            raise ValueError("archives are appended to")
        return ArchiveWriter(self.options["path"])


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archive files of a folder."""
    spark.dataSource.register(Archives)
    return spark.read.format("warc_archive").load(path)


def write(rows: DataFrame, path: str) -> None:
    """Rows (record_id, url, archived_at, mime, payload and, if given, chunked and status) as archive files, one per partition,
    with an index of JSON lines beside each (see ``tables.crawl_index``)."""
    rows.sparkSession.dataSource.register(Archives)
    rows.write.format("warc_archive").mode("append").save(path)


def index(spark: SparkSession, path: str) -> DataFrame:
    """The index rows of the archives that ``write`` left in a folder."""
    from deckmill.sources import tables

    return tables.crawl_index(spark, f"{path.rstrip('/')}/*.index.json")


def read_index(entries: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """The records of index rows (filename, offset, length); file names are relative to ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = opened(path)

        def rows() -> Iterator[dict]:
            name, file = None, None
            for batch in batches:
                for filename, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                    if not filename or offset is None or offset < 0 or length is None or length < 1:
                        yield {"filename": filename, "offset": offset, "length": length, "error": "header"}
                        continue
                    if filename != name:
                        if file is not None:
                            file.close()
                        name, at = filename, posixpath.join(folder, filename)
                        file = files.open_input_file(at) if files.get_file_info(at).is_file else None
                    if file is None:
                        yield {"filename": filename, "offset": offset, "length": length, "error": "missing"}
                        continue
                    size = file.size()
                    raw = file.read_at(min(length, max(0, size - offset)), offset) if offset < size else b""
                    found = next(members([raw]), (0, 0, b"", ""))
                    yield from _rows(filename, offset, length, found[2], "short" if len(raw) < length else found[3])
            if file is not None:
                file.close()

        yield from _batches(rows())

    places = entries.select(F.col("filename").cast("string").alias("filename"), F.col("offset").cast("bigint").alias("offset"),
                            F.col("length").cast("bigint").alias("length"))
    order = ["filename", "offset"]
    spread = places.repartitionByRange(partitions, *order) if partitions else places.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order).mapInArrow(run, COLUMNS)
