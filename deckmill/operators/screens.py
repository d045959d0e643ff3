"""Text screens and the compliance bundle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.config import PersonalDataRules
from deckmill.functions import text as tx
from deckmill.functions import urls

CHECKS = ["pirate_site", "robots_txt", "third_party_rights", "personal_data",
          "coppa_screening", "prohibited_content", "public_source"]


def personal_data_detail(emails: Column, ssns: Column, phones: Column,
                         rules: PersonalDataRules = PersonalDataRules()) -> Column:
    """Findings joined by ``; ``; empty when no count exceeds its limit."""
    def part(n: Column, limit: int, label: str) -> Column:
        return F.when(n > limit, F.concat(n.cast("string"), F.lit(f" {label}")))
    return F.concat_ws("; ",
                       part(emails, rules.emails_allowed, "email addresses"),
                       part(ssns, rules.ssns_allowed, "SSN-like patterns"),
                       part(phones, rules.phones_allowed, "phone numbers"))


def screen_personal_data(df: DataFrame, text_col: str, rules: PersonalDataRules = PersonalDataRules()) -> DataFrame:
    text = F.col(text_col)
    counted = df.withColumns({
        "n_emails": tx.email_count(text), "n_ssns": tx.ssn_count(text), "n_phones": tx.phone_count(text),
    })
    detail = personal_data_detail(F.col("n_emails"), F.col("n_ssns"), F.col("n_phones"), rules)
    return counted.withColumn("pii_detail", detail).withColumn("has_pii", F.col("pii_detail") != "")


def screen_keywords(df: DataFrame, text_col: str, keywords: Sequence[str], name: str, lead: str) -> DataFrame:
    """Hits, flag and detail line for one keyword list."""
    hits = df.withColumn("__low", F.lower(text_col)).withColumn("__hits", tx.keyword_line(F.col("__low"), keywords))
    return (hits.withColumn(f"has_{name}", F.col("__hits") != "")
            .withColumn(f"{name}_detail",
                        F.when(F.col("__hits") != "", F.concat(F.lit(f"{lead}: "), "__hits")).otherwise(F.lit("")))
            .drop("__low", "__hits"))


def screen_minors(df: DataFrame, text_col: str, keywords: Sequence[str] = tuple(fv.MINORS_KEYWORDS)) -> DataFrame:
    return screen_keywords(df, text_col, keywords, "minors", "COPPA keywords found")


def screen_prohibited(df: DataFrame, text_col: str,
                      keywords: Sequence[str] = tuple(fv.PROHIBITED_KEYWORDS)) -> DataFrame:
    return screen_keywords(df, text_col, keywords, "prohibited", "Prohibited content keywords")


def compliance(df: DataFrame, url_col: str, text_col: str, pirate: Sequence[str],
               robots_col: str | None = None, accessible_col: str | None = None,
               pii: PersonalDataRules = PersonalDataRules(),
               minors: Sequence[str] = tuple(fv.MINORS_KEYWORDS),
               prohibited: Sequence[str] = tuple(fv.PROHIBITED_KEYWORDS)) -> DataFrame:
    """The seven checks as status columns, a detail map and the failed list.

    Empty or missing text skips the three text checks, which then read PASS;
    ``text_screened`` tells such rows apart.
    """
    url = F.col(url_col)
    low = df.withColumn("__low", F.lower(text_col))
    facts = low.withColumns({
        "text_screened": F.length(F.coalesce(F.col(text_col), F.lit(""))) > 0,
        "__pii": personal_data_detail(tx.email_count(F.col(text_col)), tx.ssn_count(F.col(text_col)),
                                      tx.phone_count(F.col(text_col)), pii),
        "__minors": tx.keyword_line(F.col("__low"), minors),
        "__prohibited": tx.keyword_line(F.col("__low"), prohibited),
        "is_known_open_source": urls.under_any(urls.authority(url), fv.OPEN_SOURCE_HOSTS),
        "__pirate": urls.under_any(urls.authority(url), pirate),
    })

    def status(bad: Column, value: str) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), F.lit(value)).otherwise(F.lit("PASS"))

    unreachable = ~F.col(accessible_col) if accessible_col else F.lit(False)
    robots = F.coalesce(F.col(robots_col), F.lit("PASS")) if robots_col else F.lit("PASS")
    done = facts.withColumns({
        "pirate_site": status(F.col("__pirate"), "FAIL"),
        "robots_txt": robots,
        "third_party_rights": F.lit("PASS"),
        "personal_data": status(F.col("__pii") != "", "REVIEW"),
        "coppa_screening": status(F.col("__minors") != "", "FAIL"),
        "prohibited_content": status(F.col("__prohibited") != "", "FAIL"),
        "public_source": status(unreachable, "FAIL"),
    })
    details = {
        "pirate_site": F.concat(F.lit("Source is a blacklisted piracy domain: "), url),
        "robots_txt": F.lit("Robots.txt may disallow access"),
        "personal_data": F.col("__pii"),
        "coppa_screening": F.concat(F.lit("COPPA keywords found: "), F.col("__minors")),
        "prohibited_content": F.concat(F.lit("Prohibited content keywords: "), F.col("__prohibited")),
        "public_source": F.lit("Source URL is not publicly accessible"),
    }
    # One column per detail; the map over them is dropped by the optimizer where nobody reads it.
    lined = done.withColumns({f"{c}_detail": F.when(F.col(c) != "PASS", d) for c, d in details.items()})
    entries = F.array(*[F.when(F.col(c) != "PASS", F.struct(F.lit(c).alias("key"), F.col(f"{c}_detail").alias("value")))
                        for c in details])
    failed = F.array_compact(F.array(*[F.when(F.col(c) != "PASS", F.lit(c)) for c in CHECKS]))
    passed = F.lit(True)
    for c in CHECKS:
        passed = passed & (F.col(c) == "PASS")
    return (lined.withColumn("compliance_details", F.map_from_entries(F.array_compact(entries)))
            .withColumn("failed_checks", failed)
            .withColumn("all_pass", passed)
            .drop("__low", "__pii", "__minors", "__prohibited", "__pirate"))


def cjk_dense(parts: Column, threshold: int = 50, pattern: str = fv.CJK_PATTERN,
              first_only: bool = False) -> Column:
    """More than ``threshold`` CJK characters in one slide, or in the first one."""
    if first_only:
        return F.coalesce(F.regexp_count(F.get(parts, F.lit(0)), F.lit(pattern)), F.lit(0)) > threshold
    return F.coalesce(tx.max_pattern_count(parts, pattern), F.lit(0)) > threshold


def topical_hits(parts: Column, terms: Sequence[str] = tuple(fv.US_CONTENT_TERMS), stop_after: int | None = 50_000) -> Column:
    """How many terms the joined slide text contains; joining stops once it is long enough, or never for None."""
    if stop_after is None:
        return tx.count_contained(F.array_join(F.transform(parts, F.lower), ""), terms)
    return tx.count_contained(tx.bounded_concat(F.transform(parts, F.lower), stop_after), terms)


def topically_dense(parts: Column, terms: Sequence[str] = tuple(fv.US_CONTENT_TERMS),
                    needed: int = 3, stop_after: int | None = 50_000) -> Column:
    return topical_hits(parts, terms, stop_after) >= needed
