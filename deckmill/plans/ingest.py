"""Link-harvest ingest: index records to accepted files, one reason per row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.config import SizeFloors
from deckmill.functions import urls
from deckmill.operators import dedup, integrity, ledger, policy, scale, screens
from deckmill.session import cut_lineage


@dataclass(frozen=True)
class IngestRoute:
    """What one harvest route checks."""

    floor: int = SizeFloors().bulk
    blocked_words: Sequence[str] = tuple(fv.CHINA_URL_KEYWORDS)
    text_columns: Sequence[str] = ("url",)
    domains: policy.DomainPolicy | None = None
    hash_before_magic: bool = True
    cjk_pattern: str = fv.CJK_PATTERN
    cjk_limit: int = 50
    topic_terms: Sequence[str] | None = None
    # Crawl records are incomplete without these; an empty tuple skips the rule.
    required: Sequence[str] = ("url", "filename", "length")
    # Rows with a tag column of their own are no addresses: they are not reduced to
    # one per address, words are looked at before tags, and a tag accepted in
    # this run makes every later row with it a duplicate.
    tag: str | None = None


CRAWL_ROUTE = IngestRoute()
MULTI_SOURCE_ROUTE = IngestRoute(blocked_words=tuple(fv.KEYWORD_POLICIES["multi_source_url"]), required=("url",))
PARQUET_ROUTE = IngestRoute(blocked_words=tuple(fv.KEYWORD_POLICIES["parquet_title"]), text_columns=("title", "category"),
                            required=(), topic_terms=tuple(fv.US_CONTENT_TERMS), tag="tag")


def catalogue_route(domains: policy.DomainPolicy) -> IngestRoute:
    return IngestRoute(floor=SizeFloors().catalogue, blocked_words=(), domains=domains, hash_before_magic=False, required=("url",))


def ingest(candidates: DataFrame, seen_tags: DataFrame, content_seen: DataFrame, route: IngestRoute,
           order: Sequence[str], target: int | None = None) -> DataFrame:
    """Funnel over unique candidates; ``reason`` is null for accepted rows.

    Reads ``declared_length``, ``file_size`` (null when the bytes could not be
    fetched), ``magic_ok``, ``file_hash`` and ``parts`` (slide XML). The first
    row per address counts. Rows beyond the target are marked ``beyond_target``.
    """
    # The slides are judged in their own row and left behind before anything is shuffled.
    cjk = screens.cjk_dense(F.col("parts"), route.cjk_limit, route.cjk_pattern)
    topical = screens.topically_dense(F.col("parts"), route.topic_terms) if route.topic_terms else F.lit(False)
    slim = candidates.withColumns({"__cjk": cjk, "__topical": topical}).drop("parts")
    unique = dedup.keep_first_url(slim, list(order)) if route.tag is None else slim
    tag = F.col(route.tag) if route.tag else urls.url_tag(F.col("url"))
    flagged = ledger.flag_seen(unique.withColumn("tag", tag), seen_tags, ["tag"], order, "__tag_seen")
    flagged = ledger.flag_seen(flagged, content_seen, ["file_hash"], order, "__hash_seen")
    flagged = policy.keyword_policy(flagged, list(route.text_columns), list(route.blocked_words), "__word")
    blocked = F.col("__word")
    if route.domains is not None:
        blocked = blocked | ~policy.is_allowed(F.col("url"), route.domains)
    incomplete = ~integrity.is_complete(*[F.col(c) for c in route.required]) if route.required else F.lit(False)
    first, second = ((F.col("__tag_seen"), "dup"), (blocked, "blocked")) if route.tag is None else (
        (blocked, "blocked"), (F.col("__tag_seen"), "dup"))
    reason = (F.when(incomplete, "incomplete").when(*first).when(*second)
              .when(~integrity.declared_size_ok(F.col("declared_length"), route.floor), "small")
              .when(F.col("file_size").isNull(), "error").when(F.col("file_size") < route.floor, "small"))
    checks = [(F.col("__hash_seen"), "dup"), (~F.col("magic_ok"), "invalid")]
    for test, label in checks if route.hash_before_magic else reversed(checks):
        reason = reason.when(test, label)
    reason = reason.when(F.col("__cjk"), "china").when(F.col("__topical"), "blocked")
    judged = flagged.withColumn("reason", reason).drop("__tag_seen", "__hash_seen", "__word", "__cjk", "__topical")
    done = _first_of_run(judged, route, list(order))
    if target is None:
        return done
    done = cut_lineage(done)  # the funnel is evaluated once, then numbered and joined
    accepted = scale.number_rows(done.where(F.col("reason").isNull()).select(*order), list(order), "__n")
    late = accepted.where(F.col("__n") > target).drop("__n").withColumn("__late", F.lit(True))
    return (done.join(late, list(order), "left")
            .withColumn("reason", F.when(F.col("__late"), "beyond_target").otherwise(F.col("reason"))).drop("__late"))


def _first_of_run(judged: DataFrame, route: IngestRoute, order: list[str]) -> DataFrame:
    """Of equal contents, or equal tags, accepted in this run the first one stays."""
    if route.tag is None:
        keyed = judged.withColumn("__key", F.when(F.col("reason").isNull(), F.col("file_hash")))
        marked = dedup.mark_copies(keyed, ["__key"], order, order, "__keeper", "__copy")
        return marked.withColumn("reason", F.when(F.col("__copy"), "dup").otherwise(F.col("reason"))).drop("__key", "__keeper", "__copy")
    first = judged.where(F.col("reason").isNull()).groupBy("tag").agg(F.min(F.struct(*order)).alias("__first"))
    sizes = judged.groupBy("tag").agg(F.count("*").alias("__n"))
    marked = scale.attach(judged, first.join(sizes, "tag"), ["tag"], "__n", order)
    late = (F.struct(*order) > F.col("__first")) & ~F.coalesce(F.col("reason") == "blocked", F.lit(False))
    return marked.withColumn("reason", F.when(late, "dup").otherwise(F.col("reason"))).drop("__first", "__n")


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNull())


def ledger_rows(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New tag and content-hash entries of the accepted files."""
    fresh = accepted(judged)
    return fresh.select("tag"), fresh.select("file_hash")


