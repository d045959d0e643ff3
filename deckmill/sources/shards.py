"""Rows of dataset shards as a stream whose offset is the cursor (shard, row).

A harvest over the parquet shards of a dataset can be stopped at any row and goes on from there: a micro-batch covers the
rows between two cursors, Spark's checkpoint holds the cursor, and a row belongs to exactly one micro-batch. A shard is never
read as a whole for its rest: row groups before the cursor are skipped by their counts in the footer.

    register(spark)
    rows = (spark.readStream.format("shard_rows").option("path", folder).option("cursor", f"{state}/cursor.json")
            .option("rows_per_batch", 1_000_000).option("columns", "id,title").load())

Options: ``path``, a folder on any file system that pyarrow opens (all its ``*.parquet`` files, in order of their names);
``cursor``, the file that shows how far the harvest has been planned, needed with ``rows_per_batch`` since only it tells a
restarted query where the next step starts; ``rows_per_batch``, the rows of one step (one micro-batch; a run that takes what is
available now makes one step), without which a step takes all there is; ``rows_per_task`` (100,000); ``columns``. The columns
``_shard`` and ``_row`` (from 0) are added.

Footers are read for the shards a step touches and no others. New shards are taken up if their names come after the cursor's
shard; a shard does not change once it is there. A cursor that stands beyond a shard's rows moves to the next shard. No shard at
all gives no rows, and needs a schema given to the reader.
"""

from __future__ import annotations

import json
import posixpath
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_TASK = 100_000
START = {"shard": "", "row": 0}


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


class Rows(InputPartition):
    """Rows ``first`` to ``end`` (exclusive) of one shard."""

    def __init__(self, shard: str, first: int, end: int):
        self.shard, self.first, self.end = shard, first, end


class Shards:
    """The shards of a folder and their row counts, from the footers of those that are asked for."""

    def __init__(self, path: str):
        self.files, self.folder = opened(path)
        self.counts: dict[str, int] = {}

    def names(self, since: str = "") -> list[str]:
        found = self.files.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True))
        return sorted(f.base_name for f in found if f.is_file and f.base_name.endswith(".parquet") and f.base_name >= since)

    def open(self, name: str) -> pq.ParquetFile:
        return pq.ParquetFile(self.files.open_input_file(posixpath.join(self.folder, name)))

    def count(self, name: str) -> int:
        if name not in self.counts:
            with self.open(name) as shard:
                self.counts[name] = shard.metadata.num_rows
        return self.counts[name]

    def ranges(self, start: dict, most: int | None = None, end: dict | None = None) -> Iterator[Rows]:
        """The rows after a cursor, shard by shard: at most so many, and up to another cursor."""
        for name in self.names(start["shard"]):
            if end is not None and name > end["shard"]:
                return
            first = start["row"] if name == start["shard"] else 0
            last = end["row"] if end is not None and name == end["shard"] else self.count(name)
            if most is not None:
                last = min(last, first + most)
                most -= max(0, last - first)
            if last > first:
                yield Rows(name, first, last)
            if most == 0:
                return


class ShardStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path = options["path"]
        self.rows_per_batch = int(options["rows_per_batch"]) if "rows_per_batch" in options else None
        self.rows_per_task = int(options.get("rows_per_task", ROWS_PER_TASK))
        self.cursor = options.get("cursor")
        if self.rows_per_batch is not None and (self.cursor is None or self.rows_per_batch < 1):
            raise ValueError("rows_per_batch needs to be positive and to have a cursor file")
        self.schema = schema
        self.planned: dict | None = None

    def initialOffset(self) -> dict:
        return START

    def latestOffset(self) -> dict:
        """The cursor one step after what has been planned."""
        at = self.planned or self._read_cursor() or START
        for rows in Shards(self.path).ranges(at, self.rows_per_batch):
            at = {"shard": rows.shard, "row": rows.end}
        self.planned = at
        return at

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        if (end["shard"], end["row"]) < (start["shard"], start["row"]):
            raise ValueError(f"the cursor file {self.cursor} is behind the checkpoint: {end} is before {start}")
        # Spark has logged this step already, so a restart goes on from its end or repeats it as it is.
        self._write_cursor(end)
        tasks = []
        for rows in Shards(self.path).ranges(start, end=end):
            tasks += [Rows(rows.shard, at, min(at + self.rows_per_task, rows.end)) for at in range(rows.first, rows.end, self.rows_per_task)]
        return tasks

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        names = [f.name for f in target if f.name not in ("_shard", "_row")]
        with Shards(self.path).open(partition.shard) as shard:
            groups, before, seen = [], None, 0
            for group in range(shard.metadata.num_row_groups):
                size = shard.metadata.row_group(group).num_rows
                if seen < partition.end and seen + size > partition.first:
                    groups.append(group)
                    before = seen if before is None else before
                seen += size
            at = before or 0
            for batch in shard.iter_batches(8192, groups, names):
                first, end = max(partition.first - at, 0), min(partition.end - at, batch.num_rows)
                if end > first:
                    part = batch.slice(first, end - first)
                    columns = {n: part.column(n) for n in names}
                    columns["_shard"] = pa.array([partition.shard] * part.num_rows, pa.string())
                    columns["_row"] = pa.array(range(at + first, at + end), pa.int64())
                    yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in target], schema=target)
                at += batch.num_rows

    def _read_cursor(self) -> dict | None:
        if self.cursor is None:
            return None
        files, path = opened(self.cursor)
        if files.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        with files.open_input_stream(path) as stream:
            return json.loads(stream.read())

    def _write_cursor(self, cursor: dict) -> None:
        """A cursor file never goes back: an older step that is repeated leaves it."""
        now = self._read_cursor() or START
        if self.cursor is None or (cursor["shard"], cursor["row"]) < (now["shard"], now["row"]):
            return
        files, path = opened(self.cursor)
        files.create_dir(posixpath.dirname(path), recursive=True)
        with files.open_output_stream(path + ".new") as stream:
            stream.write(json.dumps(cursor).encode())
        files.move(path + ".new", path)


class ShardRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shard_rows"

    def schema(self) -> StructType:
        shards = Shards(self.options["path"])
        names = shards.names()
        if not names:
            raise ValueError("no shard to take the schema from: give one to the reader")
        with shards.open(names[0]) as first:
            found = from_arrow_schema(first.schema_arrow)
        if "columns" in self.options:
            found = StructType([found[c.strip()] for c in self.options["columns"].split(",")])
        return StructType([*found.fields, StructField("_shard", StringType()), StructField("_row", LongType())])

    def streamReader(self, schema: StructType) -> ShardStream:
        return ShardStream(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ShardRows)
