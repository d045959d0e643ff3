"""Counts, funnels and dashboards. Every one is a combined aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.functions import names
from deckmill.functions import text as tx


def slide_summary(files: DataFrame, extension: str = "extension", slides: str = "slide_count") -> DataFrame:
    """Files, slides and zero-slide files per format, and in total."""
    return files.rollup(F.lower(extension).alias("extension")).agg(
        F.count("*").alias("files"), F.coalesce(F.sum(slides), F.lit(0)).alias("total_slides"),
        F.count_if(F.coalesce(F.col(slides), F.lit(0)) == 0).alias("zero_or_error")
    ).withColumn("extension", F.coalesce("extension", F.lit("TOTAL")))


def funnel_counts(df: DataFrame, reason: str = "reason", kept_label: str = "kept") -> DataFrame:
    """Rows per reason, rows kept, and all rows."""
    return df.withColumn("__r", F.coalesce(F.col(reason), F.lit(kept_label))).rollup("__r").agg(
        F.count("*").alias("n")).select(F.coalesce("__r", F.lit("total")).alias("reason"), "n")


def source_stats(df: DataFrame, source: str = "source", outcome: str = "outcome",
                 tier: str = "quality_classification") -> DataFrame:
    """Pipeline counters per source with a TOTAL row.

    ``outcome`` is delivered, review, rejected, skipped or failed; the first three were downloaded.
    """
    def n(value: str) -> Column:
        return F.count_if(F.col(outcome) == value)
    got = F.col(outcome).isin("delivered", "review", "rejected")
    rated = got & (F.coalesce(F.col(tier), F.lit("")) != "")
    return df.rollup(source).agg(
        F.count_if(got).alias("downloaded"), n("delivered").alias("delivered"), n("review").alias("review"),
        n("rejected").alias("rejected"), n("skipped").alias("skipped"), n("failed").alias("failed"),
        F.count_if(rated & (F.col(tier) == "HIGH")).alias("high_count"),
        F.count_if(rated & (F.col(tier) == "MEDIUM")).alias("medium_count"),
        F.count_if(rated & ~F.col(tier).isin("HIGH", "MEDIUM")).alias("low_count"),
    ).withColumn(source, F.coalesce(source, F.lit("TOTAL")))


def source_of_name(name: Column, markers: Sequence[tuple[str, str]] = tuple(fv.SOURCE_MARKERS)) -> Column:
    label = None
    for marker, source in markers:
        hit = F.contains(name, F.lit(marker))
        label = F.when(hit, source) if label is None else label.when(hit, source)
    return label.otherwise("Other")


def source_histogram(files: DataFrame, name: str = "name",
                     markers: Sequence[tuple[str, str]] = tuple(fv.SOURCE_MARKERS)) -> DataFrame:
    return (files.groupBy(source_of_name(F.col(name), markers).alias("source")).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "source"))


def country_results(df: DataFrame, country: str = "country", got: str = "got") -> DataFrame:
    """Files per country, most first, countries without any left out."""
    return (df.groupBy(country).agg(F.sum(got).alias("files")).where(F.col("files") > 0)
            .withColumn("label", F.initcap(F.replace(F.col(country), F.lit("_"), F.lit(" "))))
            .orderBy(F.desc("files"), country))


def stage_dashboard(raw: DataFrame, staged: DataFrame, source: str = "source") -> DataFrame:
    """Files at hand against files staged per source, with a TOTAL row."""
    both = raw.select(source, F.lit(1).alias("r"), F.lit(0).alias("s")).unionByName(
        staged.select(source, F.lit(0).alias("r"), F.lit(1).alias("s")))
    return both.rollup(source).agg(F.sum("r").alias("downloaded"), F.sum("s").alias("staged")).withColumn(
        source, F.coalesce(source, F.lit("TOTAL")))


def session_delta(before: DataFrame, now: DataFrame, key: str = "source") -> DataFrame:
    """New files per key since the start counts, never negative, with a TOTAL row."""
    counts = before.groupBy(key).agg(F.count("*").alias("b"), F.lit(0).cast("bigint").alias("n")).unionByName(
        now.groupBy(key).agg(F.lit(0).cast("bigint").alias("b"), F.count("*").alias("n")))
    delta = counts.groupBy(key).agg(F.greatest(F.sum("n") - F.sum("b"), F.lit(0)).alias("new_files"))
    return delta.rollup(key).agg(F.sum("new_files").alias("new_files")).withColumn(key, F.coalesce(key, F.lit("TOTAL")))


def corpus_size(files: DataFrame, size: str = "file_size") -> DataFrame:
    return files.agg(F.count("*").alias("files"),
                     F.round(F.coalesce(F.sum(size), F.lit(0)) / F.lit(1024.0 ** 3), 8).alias("gb"))


def ledger_count(lines: DataFrame, value: str = "value") -> DataFrame:
    """Non-blank ledger lines; repeats count."""
    return lines.where(tx.strip(F.col(value)) != "").agg(F.count("*").alias("entries"))
