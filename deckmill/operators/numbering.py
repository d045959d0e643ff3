"""Sequential names and batch numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.functions import names
from deckmill.operators import scale


def renumber(files: DataFrame, name: str = "name", start: int = 1, width: int = 6) -> DataFrame:
    """Number files in name order; ``renamed`` is false where the name is right already."""
    placed = scale.number_rows(files, [name], "__n", start)
    new = F.concat(names.zero_padded(F.col("__n"), width), names.suffix(F.col(name)))
    return placed.withColumn("new_name", new).withColumn("renamed", F.col("new_name") != F.col(name)).drop("__n")


def rename_map(renumbered: DataFrame, name: str = "name") -> DataFrame:
    """Lines of the mapping log."""
    return renumbered.where("renamed").select("new_name", F.col(name).alias("old_name"))


def last_used(existing: DataFrame, batch: str) -> int:
    """Highest number given out for a batch, zero for none."""
    row = existing.where(F.col("batch_id") == batch).agg(F.max("sequence_number").alias("n")).first()
    return int(row.n or 0)


def batch_names(files: DataFrame, batch: str, order: Sequence[str], last: int = 0, name: str = "name") -> DataFrame:
    """``{batch}_names_{number}`` for files not named so yet; numbers continue after ``last``.

    One ranked write per batch replaces a shared counter.
    """
    pattern = rf"(?i)^{batch}_names_\d+\.(pptx|ppt)$"
    own = F.rlike(F.col(name), F.lit(pattern))
    keeps = files.where(own).withColumns({"sequence_number": F.lit(None).cast("bigint"), "dest_name": F.col(name)})
    numbered = scale.number_rows(files.where(~own), order, "sequence_number", last + 1)
    ext = F.coalesce(F.nullif(F.lower(names.suffix(F.col(name))), F.lit("")), F.lit(".pptx"))
    made = F.concat(F.lit(f"{batch}_names_"), names.zero_padded(F.col("sequence_number"), 6), ext)
    return keeps.unionByName(numbered.withColumn("dest_name", made))


def next_batch_ids(batches: DataFrame, day: str = "day") -> DataFrame:
    """Next batch id per day: number of batches of that day plus one."""
    counted = batches.groupBy(day).agg(F.count("*").alias("existing"))
    return counted.withColumn("next_batch_id", names.batch_id(F.col(day), F.col("existing") + 1))


def next_batch_number(batches: DataFrame, day: Column, now: Column) -> int:
    row = batches.where(F.to_date(day) == F.to_date(now)).agg(F.count("*").alias("n")).first()
    return int(row.n) + 1
