"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deckmill.llm.common import map_arrow, stored

# A table counted to hold at most this many edges (16 bytes each) is joined up in one task: rounds over many nearly empty
# partitions would cost more.
LOCAL_EDGES = 200_000


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = top(a), top(b)
                up[max(a, b)] = min(a, b)
        nodes = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())], ["node", "component"])

    return map_arrow(edges.select("a", "b").coalesce(1), run, "node long, component long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round on (a, b) with b < a: every node's neighbours are tied to the least of them and of the node itself.

    The large star moves the greater neighbours, the small star the lesser ones.
    """
    sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        sides = sides.unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    tied = sides.join(least, "u")
    if large:
        moved = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 40, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(node, component) of every node of (a, b) edges in any direction; ``component`` is the least node reachable.

    Rounds end when the edges no longer change, which takes a logarithmic number. A hub's edges are combined before the
    shuffle of the minimum, and the join that brings it back is one that adaptive execution may split.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if now.count() <= local_edges:
        return _in_one_task(now)
    mark = None
    for _ in range(most_rounds):
        now = stored(_star(_star(now, True), False), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
