"""One file per row: sidecars beside their decks, or deck files themselves.

A Python data source writer. Tasks write into a folder of the job's own; the files take their places only when all tasks are
done, and a job with a failed task leaves nothing behind. A task that ran twice wrote the same files twice under its own
attempts, of which the finished one counts. A file that is there already is replaced, so that a repeated job leaves one copy.
Files are moved one by one, some at a time: a driver lost while it moves them leaves some in place and the job's folder, whose name begins
with an underscore, so that scans pass over it; the repeated job completes them.

Rows are ``(name, content)``: a path below the folder, without ``..`` parts, and bytes; a null name is left out, a null
content is an empty file. Of one name given twice within a job, any one row stays.
"""

from __future__ import annotations

import posixpath
import sys
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from deckmill.sources import shards
from deckmill.sources.shards import opened


MOVERS = 16  # files that change places at a time


@dataclass
class Attempt(WriterCommitMessage):
    folder: str


class Folders:
    """Folders below one that is there: each is made once, not with each file, and none where that one is gone."""

    def __init__(self, files: pafs.FileSystem, top: str):
        self.files, self.made = files, {top.rstrip('/')}

    def add(self, folder: str) -> None:
        if folder not in self.made:
            self.add(posixpath.dirname(folder))
            self.files.create_dir(folder, recursive=False)
            self.made.add(folder)


class FileWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.job = path, f"_writing-{uuid.uuid4().hex}"
        files, folder = opened(path)
        files.create_dir(posixpath.join(folder, self.job), recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        files, folder = opened(self.path)
        attempt = posixpath.join(self.job, uuid.uuid4().hex)
        made = Folders(files, posixpath.join(folder, self.job))  # an aborted job's folder is gone, and its tasks end
        for batch in iterator:
            for row in batch.to_pylist():
                name = row["name"]
                if name is None:
                    continue
                if not name or name.startswith(("/", "_writing-")) or ".." in name.split("/"):
                    raise ValueError(f"not a name below the folder: {name}")
                target = posixpath.join(folder, attempt, name)
                made.add(posixpath.dirname(target))
                with files.open_output_stream(target, compression=None) as out:
                    out.write(row["content"] or b"")
        return Attempt(attempt)

    def commit(self, messages: list[Attempt | None]) -> None:
        files, folder = opened(self.path)
        files.create_dir(folder, recursive=True)
        made = Folders(files, folder)
        with ThreadPoolExecutor(MOVERS) as movers:
            for message in messages:
                # one task's files at a time, so that the driver never holds all names
                work = posixpath.join(folder, message.folder) if message else ""
                moves = []
                for found in files.get_file_info(pafs.FileSelector(work, allow_not_found=True, recursive=True)) if message else []:
                    if found.type == pafs.FileType.File:
                        target = posixpath.join(folder, found.path[found.path.index(message.folder) + len(message.folder) + 1:])
                        made.add(posixpath.dirname(target))
                        moves.append((found.path, target))
                # slices, since a call for each file would cost more than its move
                list(movers.map(lambda some: [files.move(*pair) for pair in some], [moves[i::MOVERS] for i in range(MOVERS)]))
        self._clear()

    def abort(self, messages: list[Attempt | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        files, folder = opened(self.path)
        work = posixpath.join(folder, self.job)
        for last in [False] * 50 + [True]:
            if files.get_file_info(work).type != pafs.FileType.Directory:
                return
            try:
                files.delete_dir(work)
            except OSError:  # a task that is being stopped still wrote there
                if last:
                    raise
                time.sleep(0.1)


class RowFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "row_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> FileWriter:
        if overwrite:
            raise ValueError("files are added to a folder")
        return FileWriter(self.options["path"])


def write_files(df: DataFrame, path: str, name: Column, content: Column) -> None:
    """A file for every row."""
    for module in (sys.modules[__name__], shards):
        cloudpickle.register_pickle_by_value(module)
    df.sparkSession.dataSource.register(RowFiles)
    rows = df.select(name.cast("string").alias("name"), content.cast("binary").alias("content"))
    rows.write.format("row_files").mode("append").option("path", path).save()


def write_sidecar_files(df: DataFrame, path: str, json: Column, name: Column, extension: str = ".meta.json") -> None:
    """One sidecar file per deck, named after it."""
    write_files(df, path, F.concat(name, F.lit(extension)), F.encode(json, "UTF-8"))
