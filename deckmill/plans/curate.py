"""Decks to verdicts, batches and deliveries, composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.config import DeliveryRules, IntegrityRules, PersonalDataRules, QualityRules
from deckmill.functions import content as ct
from deckmill.functions import names
from deckmill.functions import records as rc
from deckmill.operators import batches, integrity, ledger, numbering, quality, scale, screens, verdict
from deckmill.sources import decks


def verify_decks(files: DataFrame, robots: DataFrame | None, pirate: Sequence[str], *,
                 integrity_rules: IntegrityRules = IntegrityRules(), quality_rules: QualityRules = QualityRules(),
                 pii: PersonalDataRules = PersonalDataRules(), skip_quality: bool = False) -> DataFrame:
    """Full verdict of deck files with bytes.

    Wants ``path``, ``name``, ``extension``, ``file_size``, ``content``,
    ``source_url`` and ``download_url``. Every step works on the deck's own row:
    the bytes are read and parsed once and nothing is shuffled.
    """
    from deckmill.operators import policy

    keep = ["path", "name", "extension", "file_size", "source_url", "download_url", "file_hash", "is_html"]
    hashed = files.withColumn("file_hash", F.sha2("content", 256)).withColumn("is_html", ct.is_html(F.col("content")))
    parsed = decks.parse_decks(hashed, keep)
    legacy = F.lower("extension") == ".ppt"
    facts = parsed.withColumns({
        "slide_text": F.when(legacy, "").otherwise(decks.deck_text(F.col("parts"))),
        "container_reason": decks.container_reason(F.col("extension")),
        "check_url": F.coalesce(F.nullif("source_url", F.lit("")), "download_url"),
    })
    checked = integrity.validate(facts, integrity_rules, slides="slide_members").drop("is_html")
    if robots is not None:
        checked = policy.with_robots(checked, "check_url", robots, ["path"], name="robots_in")
    screened = screens.compliance(checked, "check_url", "slide_text", pirate,
                                  "robots_in" if robots is not None else None, pii=pii).drop("slide_text")
    tiered = quality.with_tier(quality.rollup_parts(screened, rules=quality_rules).drop("parts"), "chart_files", quality_rules)
    tiered = tiered.withColumn("quality_classification", F.when(
        legacy, quality.legacy_tier(F.col("file_size"), quality_rules)).otherwise(F.col("quality_classification")))
    ready = tiered.withColumn("quality_summary", quality.summary_line()).withColumn("filename", F.col("name"))
    return verdict.verify(ready, quality_rules, skip_quality).drop("file_hash", "robots_in", "check_url")


def package(files: DataFrame, cards: DataFrame | None, day: Column, now: Column, first_number: int = 1,
            rules: DeliveryRules = DeliveryRules(), record: Sequence[str] = ("name", "delivery_name", "quality_classification"),
            order: Sequence[str] = ("path",)) -> tuple[DataFrame, DataFrame]:
    """Deliverable files in named batches, and the manifest of each batch.

    Files without a sidecar are left out when ``cards`` is given.
    """
    if cards is not None:
        from deckmill.sources import tables

        files = tables.with_sidecars(files, cards, how="inner")
    named = batches.name_in_batch(batches.compose(files, list(order), rules), day, first_number, rules)
    return named, batches.manifests(named, now, list(record))


def deck_facts(parsed: DataFrame, rules: DeliveryRules = DeliveryRules()) -> DataFrame:
    """Delivery facts of parsed decks: slides, drawn objects, tier, error."""
    ppt = F.lower("extension") == ".ppt"
    broken = ~ppt & (~F.col("is_zip") | (F.col("read_error") != "") | ~F.col("has_content_types"))
    reason = F.coalesce(F.nullif("read_error", F.lit("")), F.lit("not a readable deck"))
    slides = F.when(ppt, F.lit(rules.min_slides)).otherwise(F.col("slide_members"))
    facts = parsed.withColumn("error", F.when(broken, reason).otherwise("")).withColumn("slide_count", slides)
    share = F.round(quality.delivery_share(F.col("charts"), F.col("tables"), F.col("slide_count")), 1)
    return facts.withColumn("analytical_pct", share).withColumn(
        "quality", quality.delivery_tier(F.col("charts"), F.col("tables"), F.col("slide_count"), F.col("extension")))


def delivery_status(rules: DeliveryRules = DeliveryRules()) -> Column:
    """Why a file is skipped by the delivery run, or ``delivered``."""
    return (F.when(~F.lower("extension").isin(".ppt", ".pptx"), "other_type")
            .when(F.col("file_size") < rules.min_bytes, "small")
            .when(F.col("error") != "", "corrupt")
            .when(F.col("slide_count") < rules.min_slides, "few_slides").otherwise("delivered"))


def deliver(facts: DataFrame, delivered: DataFrame, batch: str, now: Column, last_number: int,
            order: Sequence[str] = ("path",), rules: DeliveryRules = DeliveryRules()) -> dict[str, DataFrame]:
    """One delivery run over files that no earlier run has dealt with.

    ``facts`` feeds several results; hand in a stored table, not a parse in waiting.

    ``metadata`` and ``audit`` hold the delivered files; ``ledger`` also enters
    the skipped ones, with their status, except files of another type.
    """
    fresh = ledger.drop_seen(facts.withColumn("filename", F.col("name")), delivered, ["filename"], list(order)).drop("filename")
    judged = fresh.withColumn("status", delivery_status(rules))
    named = numbering.batch_names(judged.where(F.col("status") == "delivered"), batch, list(order), last_number)
    metadata = named.select(*rc.delivery_metadata(batch, now))
    passed = [F.lit("PASS").alias(c) for c in ("public_availability", "pirate_site_screening", "robots_access",
                                               "rights_review", "personal_data_screening")]
    audit = named.select(F.lit(batch).alias("batch_id"), F.col("name").alias("filename"), now.alias("delivered_at"), "slide_count",
                         "quality", F.coalesce("sidecar.source_url", F.lit("")).alias("source_url"),
                         F.when(F.col("error") == "", "PASS").otherwise("FAIL").alias("file_integrity"), *passed)
    entries = judged.where(F.col("status") != "other_type").select(F.col("name").alias("filename"), "status")
    return {"metadata": metadata, "audit": audit, "ledger": entries}


def transfer(items: DataFrame, done: DataFrame, blocked: Sequence[str], batch: str, now: Column, last_number: int,
             order: Sequence[str] = ("file_id",), rules: DeliveryRules = DeliveryRules()) -> dict[str, DataFrame]:
    """Transfer run: items not done, validated, numbered; failed fetches stay open.

    ``fetched`` is false where the bytes could not be read.
    """
    open_items = ledger.drop_seen(items, done, ["file_id"], list(order))
    lenient = integrity.accept_unparsed(open_items, rules, error="error")
    reason = integrity.transfer_reason(F.col("error"), F.col("slide_count"), F.col("organization"), F.col("author"), blocked, rules)
    judged = lenient.withColumn("reason", F.when(~F.col("fetched"), "failed").otherwise(reason))
    named = scale.number_rows(judged.where(F.col("reason") == "PASS"), list(order), "sequence_number", last_number + 1)
    ext = F.coalesce(F.nullif(F.lower(names.suffix(F.col("name"))), F.lit("")), F.lit(".pptx"))
    named = named.withColumn("dest_name", F.concat(F.lit(f"{batch}_"), names.zero_padded(F.col("sequence_number"), 6), ext))
    rejected = judged.where(~F.col("reason").isin("PASS", "failed"))
    return {
        "metadata": named.select(*rc.transfer_metadata(batch, now)),
        "rejected": rejected.select("file_id", F.col("name").alias("filename"), "reason"),
        "failed": judged.where(F.col("reason") == "failed").select("file_id"),
        "done": named.select("file_id").unionByName(rejected.select("file_id")),
    }


def repair(listing: DataFrame, rename_map: DataFrame, tags: DataFrame, start: int = 35_915, width: int = 7) -> dict[str, DataFrame]:
    """Empty files go, their tags are released, the rest is renumbered."""
    requeue = ledger.tags_to_requeue(listing, rename_map)
    kept = listing.where(F.col("file_size") > 0)
    return {
        "deleted": listing.where(F.col("file_size") == 0),
        "requeued": requeue,
        "ledger": ledger.release(tags, requeue),
        "renamed": numbering.renumber(kept, "name", start, width),
    }
