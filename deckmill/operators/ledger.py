"""Seen-tag, content-hash and delivered ledgers as one-column tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deckmill.functions import names
from deckmill.operators import scale


def flag_seen(df: DataFrame, ledger: DataFrame, keys: Sequence[str], spread_on: Sequence[str],
              name: str = "seen", small_rows: int = scale.SMALL_ROWS) -> DataFrame:
    """True for rows whose key stands in the ledger.

    A ledger checked to be small is broadcast. A larger one meets the distinct
    keys of ``df``, so that a key repeated very often crosses the shuffle once.
    """
    keys = list(keys)
    known = ledger.select(*keys).distinct()
    if scale.is_small(ledger, small_rows):
        marked = df.join(F.broadcast(known.withColumn("__known", F.lit(True))), keys, "left")
    else:
        sizes = df.groupBy(*keys).agg(F.count("*").alias("__n"))
        facts = sizes.join(known, keys, "left_semi").withColumn("__known", F.lit(True))
        marked = scale.attach(df, facts, keys, "__n", spread_on).drop("__n")
    return marked.withColumn(name, F.coalesce("__known", F.lit(False))).select(*df.columns, name)


def drop_seen(df: DataFrame, ledger: DataFrame, keys: Sequence[str], spread_on: Sequence[str],
              small_rows: int = scale.SMALL_ROWS) -> DataFrame:
    """Rows whose key is not in the ledger yet."""
    flagged = flag_seen(df, ledger, keys, spread_on, "__seen", small_rows)
    return flagged.where(~F.col("__seen")).drop("__seen")


def new_entries(scanned: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Distinct scanned values that the ledger lacks, ready to append."""
    return (scanned.select(key).where(F.col(key).isNotNull() & (F.col(key) != "")).distinct()
            .join(ledger.select(key).distinct(), key, "left_anti"))


def release(ledger: DataFrame, tags: DataFrame, key: str = "tag") -> DataFrame:
    """Ledger lines without the given tags; repeated lines stay repeated.

    A small tag list is broadcast. A large one is joined: ledger lines carry few
    repeats, so their keys are spread.
    """
    gone = tags.select(key).distinct()
    return ledger.join(scale.broadcast_if_small(gone), key, "left_anti")


def with_disk_tags(ledger: DataFrame, listing: DataFrame, name: str = "name") -> DataFrame:
    """Ledger tags and the tags found in the names of files at hand."""
    disk = listing.select(names.tag_of_name(F.col(name)).alias("tag")).where(F.col("tag").isNotNull())
    return ledger.select("tag").union(disk).distinct()


def rename_tags(rename_map: DataFrame) -> DataFrame:
    """``new name, tag`` pairs of a rename map; the last line of a name wins."""
    tagged = rename_map.withColumn("tag", names.tag_of_name(F.col("old_name"))).where(F.col("tag").isNotNull())
    return scale.last_per_key(tagged.select("new_name", "tag", "line_no"), ["new_name"], ["line_no"]).drop("line_no")


def tags_to_requeue(listing: DataFrame, rename_map: DataFrame, name: str = "name", size: str = "file_size") -> DataFrame:
    """Original tags of empty files, to be harvested again."""
    empty = listing.where(F.col(size) == 0).select(F.col(name).alias("new_name")).distinct()
    return rename_tags(rename_map).join(empty, "new_name", "left_semi").select("tag").distinct()
