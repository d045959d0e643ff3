"""Dataset shards as a stream: each row once, wherever the harvest is stopped."""

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from deckmill.sources import shards
from deckmill.sources.shards import Rows, Shards


def write(folder, name, ids, group=7):
    pq.write_table(pa.table({"id": pa.array(ids, pa.int64()), "title": [f"t{i}" for i in ids], "other": [0.5] * len(ids)}),
                   f"{folder}/{name}", row_group_size=group)


def step(spark, folder, state, rows, **options):
    """One run over what is available now: one step of the cursor."""
    reader = spark.readStream.format("shard_rows").option("path", str(folder)).option("cursor", f"{state}/cursor.json").option("columns", "id,title")
    for key, value in {"rows_per_batch": rows, **options}.items():
        reader = reader.option(key, value)
    query = (reader.load().writeStream.format("parquet").option("path", f"{state}/out").option("checkpointLocation", f"{state}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()


def harvested(spark, state):
    rows = spark.read.schema("id bigint, title string, _shard string, _row bigint").parquet(f"{state}/out").collect()
    return sorted((r["_shard"], r["_row"], r["id"], r["title"]) for r in rows)


def test_rows_come_once_over_steps_and_new_shards(spark, tmp_path):
    shards.register(spark)
    folder, state = tmp_path / "in", tmp_path / "state"
    folder.mkdir()
    want = []
    for name, ids in (("a.parquet", range(20)), ("b.parquet", []), ("c.parquet", range(100, 131))):
        write(folder, name, list(ids))
        want += [(name, row, i, f"t{i}") for row, i in enumerate(ids)]
    sizes = []
    for rows in (13, 13, 3):
        step(spark, folder, state, rows, rows_per_task=4)
        sizes.append(len(harvested(spark, state)))
    assert sizes == [13, 26, 29] and json.load(open(state / "cursor.json")) == {"shard": "c.parquet", "row": 9}
    write(folder, "d.parquet", [7, 8])
    want += [("d.parquet", 0, 7, "t7"), ("d.parquet", 1, 8, "t8")]
    for _ in range(3):
        step(spark, folder, state, 1000)
    assert harvested(spark, state) == sorted(want)


def test_a_lost_or_late_cursor_file_loses_and_repeats_nothing(spark, tmp_path):
    shards.register(spark)
    folder, state = tmp_path / "in", tmp_path / "state"
    folder.mkdir()
    write(folder, "a.parquet", list(range(50)))
    step(spark, folder, state, 10)
    earlier = (state / "cursor.json").read_text()
    step(spark, folder, state, 10)
    # as left by a crash between the log of a step and its planning
    (state / "cursor.json").write_text(earlier)
    step(spark, folder, state, 10)
    rows = [r[1] for r in harvested(spark, state)]
    assert rows == list(range(len(rows))) and len(rows) in (20, 30)
    (state / "cursor.json").write_text(json.dumps({"shard": "a.parquet", "row": len(rows)}))
    step(spark, folder, state, 100)
    assert [r[1] for r in harvested(spark, state)] == list(range(50))


def test_ranges_and_skipped_row_groups(tmp_path):
    write(tmp_path, "a.parquet", list(range(30)))
    write(tmp_path, "b.parquet", list(range(5)))
    found = Shards(str(tmp_path))
    spans = [(r.shard, r.first, r.end) for r in found.ranges({"shard": "a.parquet", "row": 28}, 4)]
    assert spans == [("a.parquet", 28, 30), ("b.parquet", 0, 2)]
    assert [(r.shard, r.first, r.end) for r in found.ranges(shards.START, end={"shard": "a.parquet", "row": 3})] == [("a.parquet", 0, 3)]
    assert not list(found.ranges({"shard": "b.parquet", "row": 9}))
    schema = shards.ShardRows({"path": str(tmp_path), "columns": "title"}).schema()
    reader = shards.ShardStream({"path": str(tmp_path)}, schema)
    rows = [(r["title"], r["_row"]) for b in reader.read(Rows("a.parquet", 6, 22)) for r in b.to_pylist()]
    assert rows == [(f"t{i}", i) for i in range(6, 22)]


def test_refused_options(tmp_path):
    with pytest.raises(ValueError):
        shards.ShardStream({"path": "x", "rows_per_batch": "5"}, None)
    with pytest.raises(ValueError):
        shards.ShardRows({"path": str(tmp_path)}).schema()
    with pytest.raises(ValueError):
        shards.ShardStream({"path": str(tmp_path)}, None).partitions({"shard": "b", "row": 1}, {"shard": "a", "row": 9})
