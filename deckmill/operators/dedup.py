"""Duplicate detection by URL, name, bytes and normalised content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.functions import names
from deckmill.operators import scale
from deckmill.session import cut_lineage


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], keep: str = "first") -> DataFrame:
    """One row per key in arrival order: ``keep="first"`` or ``"last"``."""
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    pick = scale.first_per_key if keep == "first" else scale.last_per_key
    return pick(df, list(keys), list(order))


def keep_first_url(df: DataFrame, order: Sequence[str | Column], url: str = "url") -> DataFrame:
    return keep_one(df.where(F.coalesce(F.col(url), F.lit("")) != ""), [url], order, "first")


def mark_copies(df: DataFrame, keys: Sequence[str], order: Sequence[str], spread_on: Sequence[str],
                keeper: str = "keeper", flag: str = "is_copy", show: str | None = None) -> DataFrame:
    """Mark every row but the first of its key, and name the first.

    Null keys are never copies. ``show`` is the column reported for the keeper.
    """
    show = show or order[-1]
    facts = (df.where(" and ".join(f"`{k}` is not null" for k in keys)).groupBy(*keys)
             .agg(F.min(F.struct(*order)).alias("__first"),
                  F.min_by(show, F.struct(*order)).alias(keeper), F.count("*").alias("__n"))
             .where(F.col("__n") > 1))
    marked = scale.attach(df, facts, keys, "__n", spread_on)
    is_copy = F.coalesce(F.struct(*order) > F.col("__first"), F.lit(False))
    return marked.withColumn(flag, is_copy).drop("__first", "__n")


def size_group_counts(files: DataFrame, size: str = "file_size") -> DataFrame:
    """How many files have a size of their own, and how many share one."""
    groups = files.groupBy(size).agg(F.count("*").alias("n"))
    return groups.agg(
        F.count("*").alias("size_groups"),
        F.coalesce(F.sum(F.when(F.col("n") == 1, 1)), F.lit(0)).alias("unique_size_files"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("sharing_size_files"))


def with_size_peers(files: DataFrame, size: str = "file_size", spread_on: Sequence[str] = ("path",)) -> DataFrame:
    """Number of files with the same size. Needs the listing only, so no content is read."""
    peers = files.groupBy(size).agg(F.count("*").alias("size_peers"))
    return scale.attach(files, peers, [size], "size_peers", spread_on)


def exact_copies(files: DataFrame, digest: Column, *, size: str = "file_size",
                 order: Sequence[str] = ("mtime", "path"), payload: Sequence[str] = ("content",)) -> DataFrame:
    """Oldest file of each byte-identical group is kept.

    Only files that share their size with another are hashed. The bytes are
    read once: the digests are stored, without the ``payload``, before they are grouped.
    """
    peers = with_size_peers(files, size, list(order))
    hashed = stored_digests(peers.withColumn("binary_hash", F.when(F.col("size_peers") > 1, digest)), payload)
    return mark_copies(hashed, [size, "binary_hash"], order, list(order), "binary_keeper", "is_binary_copy")


def stored_digests(hashed: DataFrame, payload: Sequence[str] = ("content",)) -> DataFrame:
    """Digest rows on shared storage, the payload left out."""
    return cut_lineage(hashed.drop(*payload))


def content_hash(members: DataFrame, key: str = "path", member: str = "member", xml: str = "xml",
                 slides_only: bool = False) -> DataFrame:
    """Digest of the slide members of each deck, in name order, without volatile attributes.

    Layouts, masters and notes count as members; ``slides_only`` leaves them
    out. Members of one deck come from one file, so the gathered text is
    bounded by that file.
    """
    chosen = members.where(F.contains(F.col(member), F.lit("slide")) & F.endswith(F.col(member), F.lit(".xml")))
    if slides_only:
        chosen = chosen.where(F.startswith(F.col(member), F.lit("ppt/slides/slide")))
    cleaned = chosen.select(key, member, names.normalised_member(F.col(xml)).alias("__xml"))
    gathered = cleaned.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(member, "__xml"))).alias("__all"))
    return gathered.select(
        key, F.sha2(F.array_join(F.transform("__all", lambda m: m["__xml"]), ""), 256).alias("content_hash"))


def content_hash_of_parts(parts: Column) -> Column:
    """The same digest where a deck row already carries its ordered members."""
    return F.when(F.size(parts) > 0, F.sha2(
        F.array_join(F.transform(parts, names.normalised_member), ""), 256))


def content_copies(files: DataFrame, *, digest: str = "content_hash", extension: str = "extension",
                   already: str = "is_binary_copy", order: Sequence[str] = ("mtime", "path")) -> DataFrame:
    """Content twins among files that are no byte copies. Old-format files and empty digests stay."""
    key = F.when(~F.col(already) & (F.lower(extension) == ".pptx"), F.nullif(F.col(digest), F.lit("")))
    marked = mark_copies(files.withColumn("__key", key), ["__key"], order, list(order),
                         "content_keeper", "is_content_copy")
    return marked.drop("__key")


def dedup_summary(files: DataFrame, size: str = "file_size") -> DataFrame:
    binary, content = F.col("is_binary_copy"), F.col("is_content_copy")
    gone = binary | content
    return files.agg(
        F.count("*").alias("scanned"), F.count_if(binary).alias("binary_duplicates"),
        F.count_if(content).alias("content_duplicates"), F.count_if(gone).alias("moved"),
        F.count_if(~gone).alias("kept"),
        F.round(F.coalesce(F.sum(F.when(gone, F.col(size))), F.lit(0)) / F.lit(1024.0 * 1024.0), 4).alias("saved_mb"))


def folder_copies(files: DataFrame, digest: str = "md5", order: Sequence[str] = ("folder_rank", "path")) -> DataFrame:
    """Across folders, the first file of each digest in folder order stays."""
    return mark_copies(files, [digest], order, list(order), "original_kept", "is_copy")


def duplicate_groups(files: DataFrame, digest: str, order: Sequence[str]) -> DataFrame:
    """Digests with more than one file: size, kept file and number moved."""
    return (files.where(F.col(digest).isNotNull()).groupBy(digest)
            .agg(F.count("*").alias("members"), F.min_by(order[-1], F.struct(*order)).alias("kept"))
            .where(F.col("members") > 1).withColumn("moved", F.col("members") - 1))


def duplicate_log(files: DataFrame, digest: str = "md5", order: Sequence[str] = ("folder_rank", "path")) -> DataFrame:
    """One row per moved copy with its digest and the file kept for it.

    The group log of a digest is the set of its rows; it is kept in this long
    form because one group may hold a large part of the corpus.
    """
    marked = folder_copies(files, digest, order)
    return marked.where(F.col("is_copy")).select(digest, "original_kept", F.col(order[-1]).alias("moved_from"))


def group_totals(files: DataFrame, digest: str) -> DataFrame:
    groups = files.where(F.col(digest).isNotNull()).groupBy(digest).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return groups.agg(F.count("*").alias("duplicate_groups"),
                      F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_files"))


def resolve_collisions(df: DataFrame, name: str, order: Sequence[str], out: str = "dest_name",
                       taken: DataFrame | None = None) -> DataFrame:
    """First file keeps its name, later ones get ``_1``, ``_2`` … before the suffix.

    Names of ``taken`` (first column) are in use at the destination already. A made
    name may equal another file's own name; such rows go round again until all
    names differ, which one more round nearly always settles.
    """
    from deckmill.operators import ledger

    placed = df.withColumn(out, F.col(name)).withColumn("__made", F.lit(0))
    used = taken.select(F.col(taken.columns[0]).alias(out)).distinct() if taken is not None else None
    while True:
        placed = scale.number_in_group(placed, [out], ["__made", *order], "__n", order, start=0)
        if used is not None:
            placed = ledger.flag_seen(placed, used, [out], order, "__taken")
            placed = placed.withColumn("__n", F.col("__n") + F.col("__taken").cast("int")).drop("__taken")
        c = F.col(out)
        numbered = F.concat(names.stem(c), F.lit("_"), F.col("__n").cast("string"), names.suffix(c))
        placed = (placed.withColumn("__made", F.when(F.col("__n") > 0, F.col("__made") + 1).otherwise(F.col("__made")))
                  .withColumn(out, F.when(F.col("__n") == 0, c).otherwise(numbered)).drop("__n"))
        clash = placed.groupBy(out).agg(F.count("*").alias("n")).where(F.col("n") > 1)
        if used is not None:
            clash = clash.select(out).union(placed.where(F.col("__made") > 0).select(out).join(used, out, "left_semi"))
        if clash.isEmpty():
            return placed.drop("__made")
        used = None if used is None else used.join(placed.where(F.col("__made") == 0).select(out).distinct(), out, "left_anti")


def joint_url_name(df: DataFrame, order: Sequence[str], url: str = "url", filename: str = "filename") -> DataFrame:
    """URL first, then lower-cased file name among the rows left; the earliest wins."""
    by_url = keep_one(df, [url], order, "first")
    named = by_url.withColumn("__name", F.lower(filename))
    return keep_one(named, ["__name"], order, "first").drop("__name")


def aggregate_folders(incoming: DataFrame, joint: DataFrame, order: Sequence[str], name: str = "name") -> DataFrame:
    """Files to move into the joint folder: names new to it, first folder first."""
    from deckmill.operators import ledger

    fresh = ledger.drop_seen(incoming, joint, [name], order)
    return keep_one(fresh, [name], order, "first")
