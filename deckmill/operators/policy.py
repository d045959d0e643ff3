"""Domain and keyword policies over URLs and titles."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.functions import terms
from deckmill.functions import text as tx
from deckmill.functions import urls
from deckmill.operators import scale

# Rules in the order in which the first match names the reason.
RULES = ["pirate", "corporate", "tld", "institution", "research", "commercial", "edu"]
US_RULES = ["tld", "institution", "research", "commercial", "edu"]


@dataclass(frozen=True)
class DomainPolicy:
    """Lists small enough to be written into the query as literal sets."""

    pirate: Sequence[str] = ()
    corporate: Sequence[str] = ()
    tld: Sequence[str] = field(default_factory=lambda: tuple(fv.DEFAULT_US_TLDS))
    institution: Sequence[str] = field(default_factory=lambda: tuple(fv.DEFAULT_US_INSTITUTIONS))
    research: Sequence[str] = ()
    commercial: Sequence[str] = ()
    exclude_us: bool = True

    @classmethod
    def from_table(cls, policy: DataFrame, exclude_us: bool = True) -> "DomainPolicy | None":
        """Read a ``(rule, value)`` table; None when it is too long for literals."""
        rows = scale.small_table(policy.select("rule", F.lower("value").alias("value")).where("value <> ''").distinct())
        if rows is None:
            return None
        lists: dict[str, list[str]] = {}
        for row in rows:
            if row.rule in RULES:
                lists.setdefault(row.rule, []).append(row.value)
        # the two lists with built-in defaults fall back when the table has none
        return cls(**{k: tuple(sorted(v)) for k, v in lists.items()}, exclude_us=exclude_us)


def block_reason(url: Column, policy: DomainPolicy, strip_port: bool = False) -> Column:
    """First rule that blocks the URL, null when it is allowed.

    A URL without authority is allowed. The authority keeps its port, as the
    lists are compared with it verbatim; ``strip_port`` drops it.
    """
    host = urls.authority(url)
    if strip_port:
        host = F.split_part(host, F.lit(":"), F.lit(1))
    reason = F.when(host == "", F.lit(None).cast("string"))
    reason = reason.when(urls.under_any(host, policy.pirate), F.lit("pirate"))
    reason = reason.when(urls.under_any(host, policy.corporate), F.lit("corporate"))
    if policy.exclude_us:
        reason = reason.when(urls.ends_with_any(host, policy.tld), F.lit("tld"))
        reason = reason.when(urls.under_any(host, policy.institution), F.lit("institution"))
        reason = reason.when(urls.under_any(host, policy.research), F.lit("research"))
        reason = reason.when(urls.under_any(host, policy.commercial), F.lit("commercial"))
        reason = reason.when(F.endswith(host, F.lit(".edu")), F.lit("edu"))
    return reason


def completed(policy: DataFrame) -> DataFrame:
    """The policy without empty values, and with the built-in suffixes and institutions where it lists none."""
    listed = policy.select("rule", "value").where(F.col("value") != "")
    defaults = {"tld": fv.DEFAULT_US_TLDS, "institution": fv.DEFAULT_US_INSTITUTIONS}
    own = {r.rule for r in listed.where(F.col("rule").isin(list(defaults))).select("rule").distinct().collect()}
    rows = [(rule, value) for rule, values in defaults.items() if rule not in own for value in values]
    return listed.unionByName(policy.sparkSession.createDataFrame(rows, "rule string, value string")) if rows else listed


def with_block_reason(df: DataFrame, url_col: str, policy: DomainPolicy | DataFrame,
                      spread_on: Sequence[str] | None = None, exclude_us: bool = True,
                      name: str = "block_reason") -> DataFrame:
    """Add the blocking rule of each URL.

    A ``(rule, value)`` table below the small-set limit is turned into literal
    sets; a longer one is joined. Built-in lists stand in for missing ones either way.
    """
    if isinstance(policy, DataFrame):
        policy = completed(policy)
        literal = DomainPolicy.from_table(policy, exclude_us)
        if literal is None:
            return block_reason_by_join(df, url_col, policy, spread_on or [url_col], exclude_us, name)
        policy = literal
    return df.withColumn(name, block_reason(F.col(url_col), policy))


def block_reason_by_join(df: DataFrame, url_col: str, policy: DataFrame, spread_on: Sequence[str],
                         exclude_us: bool = True, name: str = "block_reason") -> DataFrame:
    """Policy of any length.

    Authorities are reduced to distinct ones before anything is joined; each is
    expanded to its parent domains and matched by equality.
    """
    rules = [r for r in RULES if exclude_us or r not in US_RULES]
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r, i)])
    staged = df.withColumn("__host", urls.authority(F.col(url_col)))
    hosts = staged.where(F.col("__host") != "").groupBy("__host").agg(F.count("*").alias("__n"))
    listed = policy.select("rule", F.lower("value").alias("value")).where(F.col("rule").isin(rules) & (F.col("value") != ""))
    suffixes = listed.where(F.col("rule") == "tld").select("value").distinct()
    suffix_rows = scale.small_table(suffixes)
    entries = (listed.where(F.col("rule") != "tld").groupBy("value")
               .agg(F.min(F.element_at(order, F.col("rule"))).alias("__order")))
    labels = F.split(F.col("__host"), r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + F.lit(1)), "."))
    keys = hosts.select("__host", F.explode(parents).alias("value"))
    # A parent such as "com" belongs to very many hosts: attach keeps it from one task.
    met = keys.groupBy("value").agg(F.count("*").alias("__m")).join(entries, "value")
    hits = (scale.attach(keys, met, ["value"], "__m", ["__host"]).where(F.col("__order").isNotNull())
            .select("__host", "__order"))
    if suffix_rows is None:
        hits = hits.unionByName(_hosts_ending_so(hosts, suffixes).select("__host", F.lit(rules.index("tld")).alias("__order")))
    tests = []
    if suffix_rows:
        tests.append((urls.ends_with_any(F.col("__host"), [r.value for r in suffix_rows]), "tld"))
    if "edu" in rules:
        tests.append((F.endswith("__host", F.lit(".edu")), "edu"))
    for test, rule in tests:
        hits = hits.unionByName(hosts.where(test).select("__host", F.lit(rules.index(rule)).alias("__order")))
    first = hits.groupBy("__host").agg(F.min("__order").alias("__order"))
    facts = (hosts.join(first, "__host")
             .select("__host", "__n", F.get(F.array(*[F.lit(r) for r in rules]), F.col("__order")).alias(name)))
    return scale.attach(staged, facts, ["__host"], "__n", spread_on).drop("__host", "__n")


def _hosts_ending_so(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Hosts that end with one of many suffixes: equality on the ends of a host, for each length that suffixes have. A host
    has no more ends than characters, so the lengths that matter are few."""
    longest = hosts.agg(F.max(F.length("__host"))).first()[0] or 0
    sized = suffixes.select("value", F.length("value").alias("__len")).where(F.col("__len") <= longest)
    lengths = sorted(r[0] for r in sized.select("__len").distinct().collect())  # at most the length of a host
    if not lengths:
        return hosts.select("__host").limit(0)
    ends = F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.when(n <= F.length("__host"), F.right(F.col("__host"), n)))
    keys = hosts.select("__host", F.explode(F.array_compact(ends)).alias("value"))
    met = keys.groupBy("value").agg(F.count("*").alias("__m")).join(sized.select("value", F.lit(True).alias("__hit")), "value")
    return scale.attach(keys, met, ["value"], "__m", ["__host"]).where(F.col("__hit")).select("__host").distinct()


def is_allowed(url: Column, policy: DomainPolicy) -> Column:
    return block_reason(url, policy).isNull()


def is_blocked_legacy(url: Column, domains: Iterable[str], tlds: Iterable[str],
                      public_suffixes: Sequence[str],
                      trusted: Sequence[str] = tuple(fv.TRUSTED_HOSTS)) -> Column:
    """Older rule: no host is blocked, trusted hosts pass, then suffix, then list."""
    host = urls.bare_host(url)
    suffix = urls.public_suffix(host, public_suffixes)
    return (F.when(host == "", F.lit(True))
            .when(urls.under_any(host, trusted), F.lit(False))
            .when(F.concat(F.lit("."), suffix).isin(sorted({t.lower() for t in tlds})), F.lit(True))
            .otherwise(urls.registered_domain(host, public_suffixes).isin(sorted({d.lower() for d in domains}))
                       | urls.under_any_parent(host, domains)))


def priority(url: Column, target_tlds: Sequence[str] = tuple(fv.TARGET_TLDS)) -> Column:
    return F.when(urls.ends_with_any(urls.authority(url), target_tlds), F.lit(10)).otherwise(F.lit(5))


def geo_allowed(lowered: Column, exclude_us: bool = True, require_english: bool = True,
                us_keywords: Sequence[str] = tuple(fv.US_KEYWORDS)) -> Column:
    """Jurisdiction and language rule on lower-cased title and abstract."""
    allowed = F.lit(True)
    contains = tx.contains_any if len(set(us_keywords)) <= terms.FEW_TERMS else terms.contains_any_term
    if exclude_us:
        allowed = allowed & ~contains(lowered, us_keywords)
    if require_english:
        allowed = allowed & tx.looks_english(lowered)
    return allowed


def keyword_policy(df: DataFrame, columns: Sequence[str], keywords: Sequence[str],
                   name: str = "keyword_hit") -> DataFrame:
    """Flag rows where any of the columns contains any keyword, ignoring case. A long list is one automaton."""
    contains = tx.contains_any if len(set(keywords)) <= terms.FEW_TERMS else terms.contains_any_term
    lowered = df.withColumns({f"__low_{c}": F.lower(F.coalesce(F.col(c), F.lit(""))) for c in columns})
    hit = F.lit(False)
    for c in columns:
        hit = hit | contains(F.col(f"__low_{c}"), keywords)
    return lowered.withColumn(name, hit).drop(*[f"__low_{c}" for c in columns])


def site_url_allowed(url: Column, reject: str = fv.SITE_REJECT_PATTERN, cjk: str = fv.CJK_PATTERN) -> Column:
    return ~F.rlike(url, F.lit(reject)) & ~F.rlike(url, F.lit(cjk))


def robots_denies(text: Column, mode: str = "strict") -> Column:
    """Stored robots text denies the whole site.

    ``strict`` looks for an ``allow:`` line. ``reference`` looks for the letters
    ``allow:`` anywhere, which every ``disallow:`` contains, so it never denies.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    exempt = F.contains(low, F.lit("allow:")) if mode == "reference" else F.rlike(low, F.lit(r"(?m)^\s*allow:"))
    return F.contains(low, F.lit("disallow: /")) & ~exempt


def with_robots(df: DataFrame, url_col: str, robots: DataFrame, spread_on: Sequence[str],
                mode: str = "strict", name: str = "robots_txt",
                exempt: Sequence[str] = tuple(fv.API_SOURCE_HOSTS)) -> DataFrame:
    """Left-join stored robots text by authority. API hosts are exempt; no text allows."""
    host = urls.authority(F.col(url_col))
    rules = robots.select(F.lower("domain").alias("__host"), robots_denies(F.col("text"), mode).alias("__deny"))
    rules = rules.groupBy("__host").agg(F.max("__deny").alias("__deny"))
    staged = df.withColumn("__host", host)
    if scale.is_small(robots):
        joined = staged.join(F.broadcast(rules), "__host", "left")
    else:
        sizes = staged.groupBy("__host").agg(F.count("*").alias("__n"))
        joined = scale.attach(staged, rules.join(sizes, "__host"), ["__host"], "__n", spread_on).drop("__n")
    deny = F.coalesce("__deny", F.lit(False)) & ~urls.under_any(F.col("__host"), exempt)
    return joined.withColumn(name, F.when(deny, F.lit("REVIEW")).otherwise(F.lit("PASS"))).drop("__host", "__deny")


def is_api_source(url: Column, hosts: Sequence[str] = tuple(fv.API_SOURCE_HOSTS)) -> Column:
    return urls.under_any(urls.authority(url), hosts)


def rights_review(url: Column, hosts: Sequence[str] = tuple(fv.OPEN_SOURCE_HOSTS)) -> tuple[Column, Column]:
    """Status, which is always PASS, and whether the host is a known open one."""
    return F.lit("PASS"), urls.under_any(urls.authority(url), hosts)
