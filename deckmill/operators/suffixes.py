"""Public suffixes by rules with wildcards and exceptions.

A rule is a name (``co.uk``), a wildcard over one label (``*.ck``) or an exception to one (``!www.ck``). An exception wins
over all; otherwise the rule of most labels does; a host that no rule covers has its last label as suffix. The suffix of an
exception lacks its first label. A host that is itself a suffix has no registered domain.

Lists that fit into the query are literal sets, one hashed IN per label count (``SuffixRules``); a table of any length is
joined by the parents of the distinct hosts (``with_suffix``). Both give the same results: an empty or null host has an
empty suffix, ports and a closing dot are the caller's to remove.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.functions.urls import by_label_count
from deckmill.operators import scale


@dataclass(frozen=True)
class SuffixRules:
    names: frozenset[str]
    wildcards: frozenset[str]  # what follows the star
    exceptions: frozenset[str]

    @classmethod
    def of(cls, lines: Iterable[str]) -> "SuffixRules":
        """Rules of a list file: comments after ``//`` and blank lines are left out."""
        rules = {line.split("//")[0].strip().lower() for line in lines} - {""}
        stars = frozenset(r[2:] for r in rules if r.startswith("*."))
        nots = frozenset(r[1:] for r in rules if r.startswith("!"))
        return cls(frozenset(r for r in rules if not r.startswith(("*", "!"))), stars, nots)


def label_count(host: Column) -> Column:
    return F.when(host == "", 0).otherwise(F.length(host) - F.length(F.replace(host, F.lit("."))) + 1)


def tail(host: Column, labels: Column) -> Column:
    return F.call_function("substring_index", host, F.lit("."), -labels)


def suffix_labels(host: Column, rules: SuffixRules) -> Column:
    """Number of labels of the public suffix."""
    total = label_count(host)
    most = F.least(total, F.lit(1))
    for labels, group in sorted(by_label_count(rules.names).items()):
        most = F.when((total >= labels) & F.substring_index(host, ".", -labels).isin(group), F.greatest(most, F.lit(labels))).otherwise(most)
    for labels, group in sorted(by_label_count(rules.wildcards).items()):
        most = F.when((total > labels) & F.substring_index(host, ".", -labels).isin(group), F.greatest(most, F.lit(labels + 1))).otherwise(most)
    for labels, group in sorted(by_label_count(rules.exceptions).items()):
        most = F.when((total >= labels) & F.substring_index(host, ".", -labels).isin(group), F.lit(labels - 1)).otherwise(most)
    return most


def suffix_and_domain(host: Column, labels: Column) -> tuple[Column, Column]:
    """Public suffix, and registered domain or null, of a host whose suffix has so many labels."""
    total = label_count(host)
    return tail(host, labels), F.when(total > labels, tail(host, labels + F.lit(1)))


def with_suffix(df: DataFrame, host: str, rules: DataFrame, spread_on: Sequence[str],
                suffix: str = "public_suffix", domain: str = "registered_domain") -> DataFrame:
    """Suffix and registered domain by a table of rules (``rule`` column) of any length."""
    rule = F.lower(F.trim(F.split_part("rule", F.lit("//"), F.lit(1))))
    listed = rules.select(rule.alias("__rule")).where(F.col("__rule") != "")
    entries = (listed.select(F.regexp_replace("__rule", r"^(\*\.|!)", "").alias("__tail"), F.startswith("__rule", F.lit("*.")).alias("__star"),
                             F.startswith("__rule", F.lit("!")).alias("__not"))
               .groupBy("__tail").agg(F.bool_or("__star").alias("__star"), F.bool_or("__not").alias("__not"),
                                      F.bool_or(~F.col("__star") & ~F.col("__not")).alias("__name")))
    hosts = df.where(F.col(host).isNotNull() & (F.col(host) != "")).groupBy(F.col(host).alias("__host")).agg(F.count("*").alias("__n"))
    keys = hosts.select("__host", F.explode(F.sequence(F.lit(1), label_count(F.col("__host")))).alias("__k"))
    keys = keys.select("__host", "__k", tail(F.col("__host"), F.col("__k")).alias("__tail"))
    # A parent such as "com" belongs to very many hosts: attach keeps it from one task.
    met = keys.groupBy("__tail").agg(F.count("*").alias("__m")).join(entries, "__tail")
    hits = scale.attach(keys, met, ["__tail"], "__m", ["__host"]).where(F.col("__name").isNotNull())
    total = label_count(F.col("__host"))
    found = hits.groupBy("__host").agg(
        F.max(F.when(F.col("__not"), F.col("__k") - 1)).alias("__except"),
        F.max(F.when(F.col("__star") & (total > F.col("__k")), F.col("__k") + 1).when(F.col("__name"), F.col("__k"))).alias("__most"))
    facts = hosts.join(found, "__host").select("__host", "__n", F.coalesce("__except", "__most").alias("__labels"))
    staged = df.withColumn("__host", F.coalesce(F.col(host), F.lit("")))
    joined = scale.attach(staged, facts, ["__host"], "__n", spread_on)
    labels = F.coalesce("__labels", F.least(label_count(F.col("__host")), F.lit(1)))
    parts = suffix_and_domain(F.col("__host"), labels)
    return joined.withColumns({suffix: parts[0], domain: parts[1]}).drop("__host", "__n", "__labels")
