"""Files of a folder as a stream that keeps what it has met in a list on disk.

Spark's file source holds the path of every file it has ever met in the driver's memory, and plans each file of a micro-batch
there, several kilobytes apiece. Here a listing is sorted in runs on the driver's disk and merged with the sorted list of
the paths met before; what is left is the next wave, a table of its own, and tasks read stretches of it. The driver
holds one run (``RUN`` files) and the number of the last wave, however many files there are.

    register(spark)
    files = (spark.readStream.format("arriving_files").option("path", folder).option("state", f"{out}/arrivals")
             .option("suffixes", ".ppt,.pptx").load())

Options: ``path``, a folder whose URI is spelled out, on any file system that pyarrow opens; it is searched with all folders below
it. ``state``, a folder for the waves and the list, on storage that executors see too; it belongs to one stream, as its checkpoint
does. ``suffixes`` of the names wanted, in their case (all names without it). ``content``: ``false`` leaves out the bytes, which
are not read then. Passed over as Spark does: names that begin with a dot or an underscore (but ``_a=b``) and files being
copied, with all that is below such a folder, and files without bytes, until they have some.

A path is handed on once, whatever becomes of the file later, and whatever its age (Spark's source leaves out files a week older than
the latest one). A wave is written before its number is given to Spark, and never
changes, so that a repeated micro-batch has the same files; a wave without a list that counts it is written anew. A new
checkpoint on a state that is there already starts from the first wave. A micro-batch takes all waves there are. A folder that is not there raises an error, an
empty one gives no rows.
"""

from __future__ import annotations

import heapq
import os
import posixpath
import re
import stat
import sys
import tempfile
from collections.abc import Iterable, Iterator
from operator import itemgetter

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from deckmill.sources import shards
from deckmill.sources.shards import opened

# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN = 200_000  # files sorted at a time
ROWS = 5_000  # rows of a run, or of the list, that are read at a time
FILES_PER_TASK, BYTES_PER_TASK = 4_000, 256 << 20
FILES_AT_ONCE, BYTES_AT_ONCE = 64, 32 << 20  # whose bytes leave a task together
FOUND = pa.schema([("path", pa.string()), ("modified", pa.int64()), ("length", pa.int64())])
MET = pa.schema([("path", pa.string())])
File = tuple[str, int, int]


def below(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder whose URI is spelled out, and its path there. Names in it are no URIs: nothing is decoded."""
    return (pafs.LocalFileSystem(), "/" + root[len("file:"):].lstrip("/")) if root.startswith("file:") else opened(root)


def hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(files: pafs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """(name, whether it is a folder, time in microseconds, length) of what stands in a folder; a local one is never held as a whole."""
    if isinstance(files, pafs.LocalFileSystem):
        with os.scandir(folder) as found:
            for entry in found:
                try:
                    facts = entry.stat()
                except FileNotFoundError:  # gone meanwhile
                    continue
                yield entry.name, stat.S_ISDIR(facts.st_mode), facts.st_mtime_ns // 1_000_000 * 1000, facts.st_size
    else:
        for info in files.get_file_info(pafs.FileSelector(folder)):
            if info.type != pafs.FileType.NotFound:
                yield info.base_name, info.type == pafs.FileType.Directory, (info.mtime_ns or 0) // 1_000_000 * 1000, info.size or 0


def listed(root: str, suffixes: tuple[str, ...]) -> Iterator[File]:
    """(path, time, length) of all files of the names wanted, in no order."""
    files, base = below(root)
    todo = [""]
    while todo:
        folder = todo.pop()
        try:
            for name, is_folder, modified, length in _entries(files, posixpath.join(base, folder)):
                if hidden(name):
                    continue
                if is_folder:
                    todo.append(posixpath.join(folder, name))
                elif length and name.endswith(suffixes):
                    yield posixpath.join(root, folder, name), modified, length
        except FileNotFoundError:
            if not folder:
                raise


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _read_run(path: str) -> Iterator[File]:
    with pa.OSFile(path) as source, pa.ipc.open_stream(source) as run:
        yield from _rows(run)


def in_order(found: Iterable[File], scratch: str, most: int = RUN) -> Iterator[File]:
    """The same by path: runs of ``most`` are sorted and put into the folder, then merged."""
    runs, held = [], []

    def spill() -> None:
        runs.append(os.path.join(scratch, f"run-{len(runs)}"))
        with pa.OSFile(runs[-1], "wb") as sink, pa.ipc.new_stream(sink, FOUND) as run:
            held.sort()
            for at in range(0, len(held), ROWS):
                run.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held[at:at + ROWS]), FOUND)], schema=FOUND))
        held.clear()

    for row in found:
        held.append(row)
        if len(held) == most:
            spill()
    if not runs:
        held.sort()
        return iter(held)
    if held:
        spill()
    return heapq.merge(*map(_read_run, runs), key=itemgetter(0))


def unmet(found: Iterable[File], met: Iterator[str]) -> Iterator[File]:
    """Those of the files whose path is not on the list; both are in order."""
    known = next(met, None)
    for row in found:
        while known is not None and known < row[0]:
            known = next(met, None)
        if row[0] != known:
            yield row


class State:
    """Waves of files, and after each the list of all paths so far, as Parquet tables of the state's folder."""

    def __init__(self, path: str):
        self.files, self.folder = opened(path)

    def path(self, kind: str, number: int) -> str:
        return posixpath.join(self.folder, f"{kind}-{number:09d}.parquet")

    def lists(self) -> list[int]:
        """Numbers of the waves that a list counts; the last one is the latest wave."""
        found = self.files.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True))
        return sorted(int(m[1]) for f in found if (m := re.fullmatch(r"met-(\d+)\.parquet", f.base_name)))

    def open(self, kind: str, number: int) -> pq.ParquetFile:
        return pq.ParquetFile(self.files.open_input_file(self.path(kind, number)))

    def paths(self, kind: str, number: int) -> Iterator[str]:
        if number:
            with self.open(kind, number) as table:
                for batch in table.iter_batches(ROWS, columns=["path"]):
                    yield from batch.column(0).to_pylist()

    def write(self, kind: str, number: int, groups: Iterable[list[tuple]], schema: pa.Schema) -> int:
        """Rows by groups of the table; how many there were. It takes its place when it is whole."""
        target, count = self.path(kind, number), 0
        with self.files.open_output_stream(target + ".new", compression=None) as sink, pq.ParquetWriter(sink, schema) as table:
            for rows in groups:
                table.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema), len(rows))
                count += len(rows)
        self.files.move(target + ".new", target)
        return count

    def advance(self, found: Iterator[File]) -> int:
        """The number of the latest wave, after one of the files that were not met before, if there are any."""
        lists = self.lists()
        last = lists[-1] if lists else 0
        first = next(new := unmet(found, self.paths("met", last)), None)
        if first is None:
            return last
        self.files.create_dir(self.folder, recursive=True)
        self.write("wave", last + 1, for_tasks(chained(first, new)), FOUND)
        paths = heapq.merge(self.paths("met", last), self.paths("wave", last + 1))
        self.write("met", last + 1, ([(p,) for p in some] for some in grouped(paths, 10 * ROWS)), MET)
        for old in lists:
            self.files.delete_file(self.path("met", old))
        return last + 1


def chained(first: File, rest: Iterator[File]) -> Iterator[File]:
    yield first
    yield from rest


def grouped(values: Iterable, most: int) -> Iterator[list]:
    some: list = []
    for value in values:
        some.append(value)
        if len(some) == most:
            yield some
            some = []
    if some:
        yield some


def by_size(files: Iterable[File], most: int, most_bytes: int) -> Iterator[list[File]]:
    """Some files at a time: so many, or as many as pass so many bytes together."""
    some, size = [], 0
    for file in files:
        some.append(file)
        size += file[2]
        if len(some) == most or size >= most_bytes:
            yield some
            some, size = [], 0
    if some:
        yield some


def for_tasks(files: Iterable[File]) -> Iterator[list[File]]:
    return by_size(files, FILES_PER_TASK, BYTES_PER_TASK)


class Stretch(InputPartition):
    """One row group of a wave's table."""

    def __init__(self, wave: int, group: int):
        self.wave, self.group = wave, group


class Arriving(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.root, self.state, self.schema = options["path"], options["state"], schema
        self.suffixes = tuple(options.get("suffixes", "").split(","))

    def initialOffset(self) -> dict:
        return {"wave": 0}

    def latestOffset(self) -> dict:
        with tempfile.TemporaryDirectory(prefix="arrivals-") as scratch:
            return {"wave": State(self.state).advance(in_order(listed(self.root, self.suffixes), scratch))}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        tasks = []
        for wave in range(start["wave"] + 1, end["wave"] + 1):
            with State(self.state).open("wave", wave) as table:
                tasks += [Stretch(wave, group) for group in range(table.num_row_groups)]
        return tasks

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        files, base = below(self.root)
        with State(self.state).open("wave", partition.wave) as table:
            rows = _rows(table.read_row_group(partition.group).to_batches())
        for some in by_size(rows, FILES_AT_ONCE, BYTES_AT_ONCE) if "content" in target.names else grouped(rows, ROWS):
            paths, modified, lengths = zip(*some)
            columns = {"path": pa.array(paths, pa.string()), "modificationTime": pa.array(modified, pa.timestamp("us", tz="UTC")), "length": pa.array(lengths, pa.int64())}
            if "content" in target.names:
                found = [self._bytes(files, base + path[len(self.root):]) for path in paths]
                columns["content"], columns["length"] = pa.array(found, pa.binary()), pa.array(map(len, found), pa.int64())
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in target], schema=target)

    @staticmethod
    def _bytes(files: pafs.FileSystem, path: str) -> bytes:
        with files.open_input_file(path) as source:
            return source.read()


class ArrivingFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arriving_files"

    def schema(self) -> str:
        content = ", content binary" if self.options.get("content", "true") == "true" else ""
        return f"path string, modificationTime timestamp, length bigint{content}"

    def streamReader(self, schema: StructType) -> Arriving:
        return Arriving(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    cloudpickle.register_pickle_by_value(shards)
    spark.dataSource.register(ArrivingFiles)
