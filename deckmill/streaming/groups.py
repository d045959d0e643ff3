"""Publishing in groups of a fixed number of rows, whatever the size of the micro-batches.

Rows that do not fill a group wait in a stored remainder. Each micro-batch puts the remainder of the last commit in front of
its own rows, writes the full groups and the new remainder under its own part, and then a commit record: its number, the
groups written so far and the part. A repeated micro-batch starts from the commit before it and replaces its own part, so
groups are the same; parts without a commit are never read. ``flush`` publishes what is left when a harvest ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deckmill.operators import scale
from deckmill.sinks import tables as sinks
from deckmill.streaming.watch import Batch, _part, _written

COMMIT = "seq bigint, groups bigint, part string"


def last_commit(spark: SparkSession, out: str, without_part: str = "") -> tuple[int, int, str | None]:
    """(number, groups so far, part) of the last commit, but for the part that is being repeated."""
    row = _written(spark, f"{out}/commits", COMMIT, without_part).agg(F.max_by(F.struct("seq", "groups", "part"), "seq").alias("c")).first().c
    return (row.seq, row.groups, row.part) if row else (0, 0, None)


def _publish(rows: DataFrame | None, out: str, part: str, size: int, order: Sequence[str], schema: str, spark: SparkSession, flush: bool) -> None:
    seq, groups, before = last_commit(spark, out, part)
    waiting = spark.read.schema(f"{schema}, __at bigint").parquet(f"{out}/remainder/part_id={before}") if before else spark.createDataFrame([], f"{schema}, __at bigint")
    if rows is not None:
        waiting = waiting.unionByName(rows.withColumn("__at", F.lit(None).cast("bigint")))
    # The remainder goes first, in its old order.
    numbered = scale.number_rows(waiting, [F.col("__at").asc_nulls_last(), *order], "__seq", 0).withColumn("__at", F.col("__seq")).drop("__seq")
    total = numbered.count()
    full = total if flush else total // size * size
    named = numbered.where(F.col("__at") < full).withColumn("group_no", F.lit(groups) + F.floor(F.col("__at") / size) + 1).drop("__at")
    sinks.append_json(named, f"{out}/groups", part)
    sinks.append_parquet(numbered.where(F.col("__at") >= full), f"{out}/remainder", part)
    commit = spark.createDataFrame([(seq + 1, groups + -(-full // size), part)], COMMIT)
    sinks.append_parquet(commit, f"{out}/commits", part)


def group_batch(out: str, size: int, order: Sequence[str], schema: str) -> Batch:
    """Micro-batch that publishes its rows, in ``order``, in groups of exactly ``size``."""

    def run(batch: DataFrame, epoch: int) -> None:
        _publish(batch, out, _part(batch.sparkSession, epoch), size, order, schema, batch.sparkSession, False)

    return run


def flush(spark: SparkSession, out: str, size: int, order: Sequence[str], schema: str) -> None:
    """Publish the remainder as a last, shorter group. Doing so again publishes nothing."""
    seq, _, _ = last_commit(spark, out)
    _publish(None, out, f"flush-{seq}", size, order, schema, spark, True)


def published(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """Rows of the committed groups, with ``group_no``."""
    done = _written(spark, f"{out}/commits", COMMIT, "").select(F.col("part").alias("part_id"))
    found = spark.read.schema(f"{schema}, group_no bigint, part_id string").option("basePath", f"{out}/groups").json(f"{out}/groups")
    return found.join(scale.broadcast_if_small(done), "part_id", "left_semi").drop("part_id")
