"""Eleven-stage verdict, write-back and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.config import QualityRules
from deckmill.session import cut_lineage

STAGES = ["file_integrity", "source_verification", "public_availability", "pirate_screening",
          "robots_access", "rights_review", "personal_data", "coppa_screening",
          "prohibited_content", "quality_assessment", "reasoning_quality"]
HARD_CHECKS = [("pirate_site", "pirate_screening"), ("coppa_screening", "coppa_screening"),
               ("prohibited_content", "prohibited_content")]


def verify(df: DataFrame, rules: QualityRules = QualityRules(), skip_quality: bool = False,
           strict_public: bool = False) -> DataFrame:
    """Statuses, decision and reasons from the facts of earlier operators.

    Reads ``validation``, the seven compliance statuses with their details, the
    tier columns and ``source_url``. An integrity failure leaves every later
    stage PENDING; a hard compliance failure leaves the quality stages PENDING.
    ``strict_public`` also rejects unreachable sources.
    """
    valid = F.col("validation.is_valid")
    has_source = F.coalesce(F.col("source_url"), F.lit("")) != ""
    hard = None
    for check, _ in HARD_CHECKS:
        text = F.concat(F.lit(f"{check}: "), F.coalesce(F.col(f"{check}_detail"), F.lit("FAIL")))
        hard = F.when(F.col(check) == "FAIL", text) if hard is None else hard.when(F.col(check) == "FAIL", text)
    staged = df.withColumn("__hard", F.when(valid, hard))
    judged = valid & F.col("__hard").isNull()
    tier = F.lit("MEDIUM") if skip_quality else F.col("quality_classification")

    def later(value: Column, when: Column) -> Column:
        return F.when(when, value).otherwise(F.lit("PENDING"))

    if skip_quality:
        quality, reasoning = F.lit("PASS"), F.lit("PASS")
    else:
        quality = F.when(tier == "LOW", "FAIL").otherwise("PASS")
        reasoning = F.when((F.col("reasoning_score") >= rules.reasoning_pass) | (tier == "HIGH"), "PASS").otherwise("REVIEW")

    statuses = {
        "file_integrity": F.when(valid, "PASS").otherwise("FAIL"),
        "source_verification": later(F.when(has_source, "PASS").otherwise("REVIEW"), valid),
        "public_availability": later(F.col("public_source"), valid),
        "pirate_screening": later(F.col("pirate_site"), valid),
        "robots_access": later(F.col("robots_txt"), valid),
        "rights_review": later(F.col("third_party_rights"), valid),
        "personal_data": later(F.col("personal_data"), valid),
        "coppa_screening": later(F.col("coppa_screening"), valid),
        "prohibited_content": later(F.col("prohibited_content"), valid),
        "quality_assessment": later(quality, judged),
        "reasoning_quality": later(reasoning, judged),
    }
    done = staged.withColumns({f"__{k}": v for k, v in statuses.items()})

    def s(stage: str) -> Column:
        return F.col(f"__{stage}")

    review = F.lit(False)
    for stage in ["source_verification", "robots_access", "rights_review", "personal_data", "reasoning_quality"]:
        review = review | (s(stage) == "REVIEW")
    reject = ~valid | F.col("__hard").isNotNull() | (s("quality_assessment") == "FAIL")
    if strict_public:
        reject = reject | (s("public_availability") == "FAIL")
    reasons = F.array_compact(F.array(
        F.when(~valid, F.concat(F.lit("Integrity: "), F.col("validation.rejection_reason"))),
        F.when(valid & ~has_source, F.lit("Missing source URL")),
        F.col("__hard"),
        F.when(s("quality_assessment") == "FAIL", F.concat(F.lit("Quality: LOW ("), F.col("quality_summary"), F.lit(")"))
               if not skip_quality else F.lit(None).cast("string"))))
    out = done.withColumn("decision", F.when(reject, "REJECT").when(review, "REVIEW").otherwise("DELIVER"))
    out = out.withColumn("rejection_reasons", reasons)
    out = out.withColumn("quality_classification", F.when(judged, tier).otherwise(F.lit("")))
    out = out.withColumns({stage: s(stage) for stage in STAGES})
    out = out.withColumn("all_stages_pass", F.forall(F.array(*STAGES), lambda x: x == "PASS"))
    return out.drop("__hard", *[f"__{k}" for k in STAGES])


def write_back(df: DataFrame) -> DataFrame:
    """Facts of the verdict copied onto the file metadata."""
    return df.withColumns({
        "file_size": F.col("validation.file_size"),
        "slide_count": F.col("validation.slide_count"),
        "file_hash": F.col("validation.file_hash"),
        "delivery_status": F.col("decision"),
    })


def route(df: DataFrame) -> dict[str, DataFrame]:
    """Rejected files, and the kept ones that get a sidecar.

    The verdicts are stored first: a filter on a verdict that is still an
    expression would be pushed down to the scan and screen every text again.
    """
    stored = cut_lineage(df)
    return {"all": stored, "rejected": stored.where(F.col("decision") == "REJECT"),
            "kept": stored.where(F.col("decision") != "REJECT")}


def audit_rows(df: DataFrame, now: Column, batch: Column | None = None) -> DataFrame:
    """Audit record of every file, rejected ones included."""
    source = F.coalesce(F.nullif(F.col("source_url"), F.lit("")), F.col("download_url"), F.lit(""))
    return df.select(
        now.alias("timestamp"), F.col("filename"), F.col("validation.file_hash").alias("file_hash"),
        source.alias("source_url"), (batch if batch is not None else F.lit("")).alias("batch_id"),
        F.col("validation.slide_count").alias("slide_count"),
        F.col("validation.file_size").alias("file_size_bytes"),
        *STAGES, "quality_classification", "decision", "rejection_reasons")
