"""Sinks: metadata, audit, manifests, quarantine, logs and ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _add_part(path: str, part: str | None) -> tuple[str, str]:
    """A named part is overwritten, so that a repeated write leaves one copy."""
    return (f"{path}/part_id={part}", "overwrite") if part is not None else (path, "append")


def append_json(df: DataFrame, path: str, part: str | None = None) -> None:
    target, mode = _add_part(path, part)
    df.write.mode(mode).json(target)


def append_parquet(df: DataFrame, path: str, part: str | None = None) -> None:
    target, mode = _add_part(path, part)
    df.write.mode(mode).parquet(target)


def write_sidecars(df: DataFrame, path: str, json: Column, name: str = "filename", extension: str = ".meta.json") -> None:
    """Sidecar name and JSON text of every file, as a table."""
    df.select(F.concat(F.col(name), F.lit(extension)).alias("sidecar"), json.alias("json")).write.mode("append").parquet(path)


def append_audit(rows: DataFrame, path: str, part: str | None = None) -> None:
    append_json(rows, path, part)


def export_manifest(cards: DataFrame, path: str, order: str = "sidecar_path") -> None:
    """All sidecars of a folder in name order: range-sorted part files, read in file order."""
    cards.orderBy(order).write.mode("overwrite").json(path)


def write_manifests(manifests: DataFrame, path: str, batch: str = "batch_id") -> None:
    manifests.withColumn("batch", F.col(batch)).write.mode("append").partitionBy("batch").json(path)


def quarantine(df: DataFrame, path: str, reason: str = "reason", dry_run: bool = True) -> DataFrame:
    """Rows with a reason, written by reason kind; a dry run only returns them.

    The kind is the reason up to the first bracket or name, so that the number
    of folders stays small.
    """
    flagged = df.where(F.col(reason).isNotNull()).withColumn("reason_kind", reason_kind(F.col(reason)))
    if not dry_run:
        flagged.write.mode("append").partitionBy("reason_kind").parquet(path)
    return flagged


def reason_kind(reason: Column) -> Column:
    text = F.regexp_replace(F.regexp_extract(reason, r"^(Duplicate of|[^(:]*)", 1), r"[^A-Za-z0-9]+", "_")
    return F.lower(F.regexp_replace(text, "^_+|_+$", ""))


def write_rename_map(pairs: DataFrame, path: str, session: str, part: str | None = None) -> None:
    target, mode = _add_part(path, part)
    line = F.concat(F.col("new_name"), F.lit(" | "), F.col("old_name"))
    pairs.orderBy("new_name").select(line.alias("value")).write.mode(mode).text(f"{target}/session={session}")


def append_rejects(df: DataFrame, path: str, part: str | None = None) -> None:
    append_json(df.select("file_id", "filename", "reason"), path, part)


def append_duplicate_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").json(path)


def append_ledger(df: DataFrame, path: str, columns: Sequence[str], part: str | None = None) -> None:
    append_parquet(df.select(*columns), path, part)
