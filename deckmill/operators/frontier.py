"""Search-query frontier, link harvest and candidate selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.functions import urls
from deckmill.operators import dedup, ledger, scale


def _seeded(key: Column, seed: int) -> Column:
    return F.md5(F.encode(F.concat(key, F.lit(f"|{seed}")), "UTF-8"))


def drawn(key: Column, seed: int, percent: int) -> Column:
    """Repeatable draw of about ``percent`` of the keys."""
    return F.conv(F.substring(_seeded(key, seed), 1, 8), 16, 10).cast("bigint") % F.lit(100) < F.lit(percent)


def shuffled_rank(key: Column, seed: int) -> Column:
    """Repeatable shuffle order."""
    return F.substring(_seeded(key, seed), 1, 16)


def _explode_literals(df: DataFrame, values: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def build_frontier(domains: DataFrame, topics: Sequence[str] | Mapping[str, Sequence[str]],
                   broad: DataFrame | None = None, broad_phrases: Sequence[str] = (), *,
                   ppt_percent: int = 20, seed: int = 0, shuffle: bool = True) -> DataFrame:
    """Search queries from ``(country, domain)`` rows and topic lists.

    ``topics`` is one list for all countries or a list per country; it is a
    parameter, so the rows grow linearly with ``domains`` and nothing is joined.
    Broad queries come first (priority 0); the topic queries (priority 1) get
    a repeatable shuffle rank. The ``.ppt`` variant is drawn for a share of them.
    """
    if isinstance(topics, Mapping):
        lists = F.create_map(*[x for c, ts in topics.items() for x in (F.lit(c), F.array(*[F.lit(t) for t in ts]))])
        expanded = domains.withColumn("topic", F.explode(F.try_element_at(lists, F.col("country"))))
    else:
        expanded = _explode_literals(domains, topics, "topic")
    return _matrix(expanded, broad, broad_phrases, ppt_percent=ppt_percent, seed=seed, shuffle=shuffle)


def _matrix(expanded: DataFrame, broad: DataFrame | None, broad_phrases: Sequence[str], *, ppt_percent: int, seed: int,
            shuffle: bool) -> DataFrame:
    """Queries of ``(country, domain, topic)`` rows, broad ones in front."""
    quoted = F.concat(F.lit('"'), F.col("topic"), F.lit('"'))
    key = F.concat_ws("|", "country", "topic", "domain")
    both = expanded.withColumn("kind", F.explode(F.when(
        drawn(key, seed, ppt_percent), F.array(F.lit("pptx"), F.lit("ppt"))).otherwise(F.array(F.lit("pptx")))))
    matrix = both.select("country", F.lit(1).alias("priority"),
                         F.concat(quoted, F.lit(" filetype:"), F.col("kind"), F.lit(" "), F.col("domain")).alias("query"))
    parts = [matrix]
    if broad is not None:
        heads = ["filetype:pptx", "filetype:ppt", *[f"{p} filetype:pptx" for p in broad_phrases]]
        parts.insert(0, _explode_literals(broad, heads, "head").select(
            "country", F.lit(0).alias("priority"), F.concat_ws(" ", "head", "domain").alias("query")))
    rank = shuffled_rank(F.col("query"), seed) if shuffle else F.lit("")
    return scale.union_all(parts).withColumn(
        "shuffle_rank", F.when(F.col("priority") == 0, F.lit(None).cast("string")).otherwise(rank))


def frontier_from_seed(seed: DataFrame, extra_topics: Sequence[str] = (), broad_phrases: Sequence[str] = (), *,
                       ppt_percent: int = 20, shuffle_seed: int = 0) -> DataFrame:
    """Frontier of all countries of a ``(country, kind, value)`` seed table.

    ``kind`` is topic, domain or broad; every country also gets ``extra_topics``.
    Repeated topics give repeated queries. Topic lists checked to be small are
    written into the query; longer ones are joined by country.
    """
    def of(kind: str, name: str) -> DataFrame:
        return seed.where(F.col("kind") == kind).select("country", F.col("value").alias(name))
    domains, broad = of("domain", "domain"), of("broad", "domain")
    rows = scale.small_table(of("topic", "topic"))
    countries = scale.small_table(domains.select("country").distinct()) if extra_topics else []
    options = dict(broad=broad, broad_phrases=broad_phrases, ppt_percent=ppt_percent, seed=shuffle_seed)
    if rows is None or countries is None:
        topics = of("topic", "topic")
        if extra_topics:
            topics = topics.unionByName(_explode_literals(domains.select("country").distinct(), extra_topics, "topic"))
        return _matrix(domains.join(topics, "country"), **options, shuffle=True)
    lists: dict[str, list[str]] = {}
    for row in rows:
        lists.setdefault(row.country, []).append(row.topic)
    if extra_topics:
        for row in countries:
            lists.setdefault(row.country, [])
        lists = {c: [*ts, *extra_topics] for c, ts in lists.items()}
    return build_frontier(domains, lists, **options)


def fixed_and_sampled(domains: DataFrame, topics: Sequence[str], main_domain: str,
                      main_topics_percent: int = 20, few_topics: Sequence[str] = ("lecture slides", "presentation", "course notes"),
                      seed: int = 0) -> DataFrame:
    """Variant with one main domain for all topics and a few topics for the others."""
    main = domains.where(F.col("domain") == main_domain)
    rest = domains.where(F.col("domain") != main_domain)
    return scale.union_all([
        build_frontier(main, topics, ppt_percent=main_topics_percent, seed=seed, shuffle=False).withColumn("priority", F.lit(0)),
        build_frontier(rest, few_topics, ppt_percent=0, seed=seed)])


def sample_frontier(domains: DataFrame, topics: Sequence[str], n_topics: int = 20, n_domains: int = 3,
                    seed: int = 0) -> DataFrame:
    """Notebook variant: all plain domain queries, and a seeded sample of topics by domains per country."""
    plain = _explode_literals(domains, ["filetype:pptx", "filetype:ppt"], "head").select(
        "country", F.concat_ws(" ", "head", "domain").alias("query"))
    few = scale.top_per_key(domains, ["country"], [shuffled_rank(F.col("domain"), seed), "domain"],
                            n_domains, ["domain"])
    # Topics are ranked once per country by a hash of both.
    options = F.array(*[F.struct(shuffled_rank(F.concat(F.col("country"), F.lit(f"|{t}")), seed).alias("r"), F.lit(t).alias("topic"))
                        for t in sorted(set(topics))])
    picked = few.withColumn("__t", F.explode(F.slice(F.array_sort(options), F.lit(1), F.lit(n_topics))))
    topical = picked.select("country", F.concat(
        F.lit('"'), F.col("__t.topic"), F.lit('" filetype:pptx '), F.col("domain")).alias("query"))
    return plain.unionByName(topical)


def keyword_queries(disciplines: DataFrame, tokens: Sequence[str] = tuple(fv.PRESENTATION_TOKENS),
                    site_prefix: str = "site:edu ", site_first: int = 20) -> DataFrame:
    """Disciplines with each token, alone, and the first ones under a site prefix.

    Repeated disciplines give repeated queries.
    """
    d = F.col("discipline")
    forms = [F.concat(d, F.lit(f" {t}")) for t in tokens] + [d]
    site = F.when(F.col("position") < site_first, F.concat(F.lit(site_prefix), d))
    return disciplines.withColumn("query", F.explode(F.array_compact(F.array(*forms, site)))).select("query")


def page_links(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               link_pattern: str = fv.DECK_URL_PATTERN, raw_pattern: str | None = fv.RAW_DECK_URL_PATTERN,
               repository_pattern: str | None = fv.BITSTREAM_PATTERN) -> DataFrame:
    """Distinct deck links of each page: raw addresses, repository paths, anchors.

    Relative links are resolved against the page address. Pages are unique by id.
    """
    text = F.col(html)
    hrefs = F.filter(urls.anchor_targets(text), lambda h: F.rlike(h, F.lit(link_pattern)))
    groups = [hrefs]
    for pattern in (raw_pattern, repository_pattern):
        if pattern:
            groups.append(F.regexp_extract_all(text, F.lit(pattern), 0))
    # Links are made distinct inside the page's own row, so nothing is shuffled.
    resolved = F.transform(F.array_distinct(F.concat(*groups)), lambda ref: urls.resolve_url(F.col(url), ref))
    return pages.select(page_id, F.explode(F.array_distinct(resolved)).alias("link"))


def select_candidates(results: DataFrame, links: DataFrame, seen_tags: DataFrame, order: Sequence[str], *,
                      url: str = "url", page_id: str = "page_id", link_pattern: str = fv.DECK_URL_PATTERN,
                      skip: Sequence[str] = tuple(fv.SKIP_EXTENSIONS)) -> DataFrame:
    """Addresses to fetch from search results.

    Results seen before are dropped. A result that is a deck address passes
    itself; any other, unless its extension is skipped, stands for the links of
    its page. The earliest occurrence of an address wins.
    """
    tagged = results.withColumn("tag", urls.url_tag(F.col(url)))
    fresh = dedup.keep_one(ledger.drop_seen(tagged, seen_tags, ["tag"], order), [url], order)
    direct = urls.is_deck_link(F.col(url), link_pattern)
    own = fresh.where(direct).select(*order, F.lit(0).alias("hop"), F.col(url).alias("candidate"))
    pages = fresh.where(~direct & ~urls.has_skipped_extension(F.col(url), skip))
    linked = (pages.join(links, page_id).select(*order, F.lit(1).alias("hop"), F.col("link").alias("candidate"))
              .withColumn("tag", urls.url_tag(F.col("candidate"))))
    linked = ledger.drop_seen(linked, seen_tags, ["tag"], ["candidate", *order]).drop("tag")
    return dedup.keep_one(own.unionByName(linked), ["candidate"], [*order, "hop"]).withColumn(
        "tag", urls.url_tag(F.col("candidate")))
