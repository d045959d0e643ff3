"""Quotas, batch cut and manifests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deckmill.config import DeliveryRules
from deckmill.functions import names
from deckmill.operators import scale
from deckmill.session import cut_lineage


def medium_cap(high: int, rules: DeliveryRules = DeliveryRules()) -> int:
    """MEDIUM files that go with ``high`` HIGH files."""
    return int(high / rules.high_share * rules.medium_share)


def compose(files: DataFrame, order: Sequence[str], rules: DeliveryRules = DeliveryRules(),
            status: str = "delivery_status", tier: str = "quality_classification") -> DataFrame:
    """Deliverable files under the tier quota, numbered HIGH first.

    All HIGH files pass; MEDIUM files pass up to the cap that the number of HIGH
    files allows. ``seq`` runs over both, ``batch_no`` cuts it into batches.
    """
    fit = files.where((F.col(status) == "DELIVER") & F.col(tier).isin("HIGH", "MEDIUM"))
    ranked = fit.withColumn("__rank", F.when(F.col(tier) == "HIGH", 0).otherwise(1))
    numbered = scale.number_rows(ranked, ["__rank", *order], "seq", 1)
    # One number from the stored rows: how many HIGH files there are.
    high = numbered.where(F.col("__rank") == 0).count()
    return (numbered.where(F.col("seq") <= high + medium_cap(high, rules))
            .withColumn("batch_no", F.ceil(F.col("seq") / F.lit(rules.batch_size)).cast("int"))
            .drop("__rank"))


def name_in_batch(composed: DataFrame, day: Column, first_number: int = 1,
                  rules: DeliveryRules = DeliveryRules(), name: str = "name") -> DataFrame:
    """Batch id and delivery name of each composed file."""
    batch = names.batch_id(day, F.col("batch_no") + F.lit(first_number - 1))
    place = (F.col("seq") - 1) % rules.batch_size + 1
    return (composed.withColumn("batch_id", batch)
            .withColumn("delivery_name", F.concat(
                F.col("batch_id"), F.lit("_FILE"), names.zero_padded(place, 5), names.suffix(F.col(name)))))


def composition(batched: DataFrame, batch: str = "batch_id", tier: str = "quality_classification") -> DataFrame:
    """Counts and shares of the files actually cut into each batch."""
    rolled = batched.groupBy(batch).agg(
        F.count("*").alias("total_files"),
        F.count_if(F.col(tier) == "HIGH").alias("high_quality"),
        F.count_if(F.col(tier) == "MEDIUM").alias("medium_quality"))
    def pct(c: str) -> Column:
        return F.round(F.lit(100.0) * F.col(c) / F.col("total_files"), 1)
    return rolled.withColumn("high_pct", pct("high_quality")).withColumn("medium_pct", pct("medium_quality"))


def manifests(batched: DataFrame, now: Column, record: Sequence[str], batch: str = "batch_id",
              tier: str = "quality_classification") -> DataFrame:
    """Manifest row per batch. The file list is bounded by the batch size."""
    files = batched.groupBy(batch).agg(
        F.sort_array(F.collect_list(F.struct("seq", F.struct(*record).alias("record")))).alias("__files"))
    head = composition(batched, batch, tier)
    return head.join(files, batch).select(
        batch, now.alias("timestamp"), "total_files",
        F.struct("high_quality", "medium_quality", "high_pct", "medium_pct").alias("composition"),
        F.transform("__files", lambda f: f["record"]).alias("files"))


def source_allocation(available: Mapping[str, int], sources: Sequence[str], target: int) -> dict[str, int]:
    """How many files each source may contribute, in source order.

    Every source gets an equal share, at least one; the last gets what the
    others left of the target. Nothing is taken once the target is reached.
    """
    share = target // len(sources)
    taken: dict[str, int] = {}
    total = 0
    for i, source in enumerate(sources):
        if total >= target:
            break
        allowed = max(target - total if i == len(sources) - 1 else share, 1)
        taken[source] = min(allowed, available.get(source, 0))
        total += taken[source]
    return taken


def source_quota(candidates: DataFrame, sources: Sequence[str], target: int, order: Sequence[str],
                 source: str = "source") -> DataFrame:
    """Candidates kept under the per-source quota.

    No source gives more than ``target`` rows, so the first ``target`` of each are taken in slices, in one pass over the
    candidates; counts and numbers follow from these few rows. Only one count per listed source comes to the driver.
    """
    wanted = candidates.where(F.col(source).isin(list(sources)))
    first = cut_lineage(scale.top_per_key(wanted, [source], order, target, order))
    available = {r[source]: r["count"] for r in first.groupBy(source).count().collect()}
    taken = source_allocation(available, sources, target)
    cap = F.create_map(*[F.lit(x) for s in sources for x in (s, taken.get(s, 0))])
    place = F.row_number().over(Window.partitionBy(source).orderBy(*order)).cast("bigint")  # over at most ``target`` rows
    return first.withColumn("source_seq", place).where(F.col("source_seq") <= F.element_at(cap, F.col(source)))


def cap_per_query(results: DataFrame, cap: int, order: Sequence[str | Column], spread_on: Sequence[str],
                  query: str = "query") -> DataFrame:
    return scale.top_per_key(results, [query], order, cap, spread_on)


def page_window(results: DataFrame, page_size: int, max_pages: int, rank: str = "rank") -> DataFrame:
    """Rows that lie on the pages a client would read; ``rank`` counts from one."""
    page = F.ceil(F.col(rank) / F.lit(page_size)).cast("int")
    return results.withColumn("page", page).where(F.col("page") <= max_pages)


def take_target(df: DataFrame, order: Sequence[str | Column], target: int) -> DataFrame:
    return scale.first_rows(df, order, target)
