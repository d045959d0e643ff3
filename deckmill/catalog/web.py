"""Registered queries over URLs, policies, links and the query frontier."""

from __future__ import annotations

from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.catalog.common import (AUTHORITY, Catalog, q, sql_any, sql_ends, sql_list, sql_under, table)
from deckmill.functions import names, urls
from deckmill.operators import batches, dedup, frontier, integrity, ledger, policy, scale
from deckmill.operators.ledger_index import LedgerIndex
from deckmill.session import scratch_path

CATALOG = Catalog()

SUFFIXES = ["com", "org", "net", "example.net"]
POLICY = policy.DomainPolicy(
    pirate=("spam-farm.example.org", "free-bets.example.com"),
    corporate=("cheap-pills.example.com", "therti.example.org"),
    tld=(".gov", ".mil", ".ththan.example.net"),
    institution=("tionsh.example.net", "mit.edu"),
    research=("ththly.example.org", "theres.example.com", "mit.edu/lincoln"),
    commercial=("tionble.example.com",))
DENIED_PAGE = r"(?i)/fr/|utm_source"
# Links of the given pages carry no deck suffix, so the suffix is a parameter.
PAGE_PATTERN = r"(?i)\.html?($|[?#&\s])"
LINK_PATTERN = r"^/[a-z]{3,}$"
REPOSITORY_PATTERN = r"/(?:the|der|los)[a-z]+"


def pages(spark, d):
    return table(spark, d, "pages")


@CATALOG.add("url_hosts", rf"""
SELECT page_id, a AS authority, regexp_replace(split_part(a, ':', 1), '^www\.', '') AS bare_host,
       CASE WHEN regexp_replace(split_part(a, ':', 1), '^[w.]+', '') = '' THEN 'unknown'
            ELSE regexp_replace(split_part(a, ':', 1), '^[w.]+', '') END AS display_host
FROM (SELECT page_id, {AUTHORITY} AS a FROM pages) t""")
def url_hosts(spark, d):
    u = F.col("url")
    return pages(spark, d).select("page_id", urls.authority(u).alias("authority"),
                                  urls.bare_host(u).alias("bare_host"), urls.display_host(u).alias("display_host"))


@CATALOG.add("url_registered_domain", rf"""
SELECT page_id, s AS public_suffix,
       string_split(CASE WHEN s = '' THEN h WHEN h = s THEN '' ELSE left(h, length(h) - length(s) - 1) END, '.')[-1]
       || '.' || s AS registered_domain
FROM (SELECT page_id, h, CASE WHEN {sql_under('h', ['example.net'])} THEN 'example.net'
             WHEN {sql_under('h', ['com'])} THEN 'com' WHEN {sql_under('h', ['org'])} THEN 'org'
             WHEN {sql_under('h', ['net'])} THEN 'net' ELSE '' END AS s
      FROM (SELECT page_id, regexp_replace(split_part({AUTHORITY}, ':', 1), '^www\.', '') AS h FROM pages) a) b""")
def url_registered_domain(spark, d):
    h = urls.bare_host(F.col("url"))
    return pages(spark, d).select("page_id", urls.public_suffix(h, SUFFIXES).alias("public_suffix"),
                                  urls.registered_domain(h, SUFFIXES).alias("registered_domain"))


@CATALOG.add("url_tags", """
SELECT page_id, substr(sha1(url), 1, 10) AS url_tag,
       substr(sha1(url), 1, 10) || '_' || regexp_replace(n, '[^\\p{L}\\p{N}_.\\-]', '_', 'g') || '.pptx' AS tagged_name,
       substr(sha1(url), 1, 10) || '_cc_' || regexp_replace(substr(split_part(string_split(url, '/')[-1], '?', 1), 1, 40),
         '[^\\p{L}\\p{N}_]', '_', 'g') || '.pptx' AS bulk_name
FROM (SELECT page_id, url, string_split(rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/')[-1] AS n
      FROM pages) t""".replace("\\\\", "\\"))
def url_tags(spark, d):
    u = F.col("url")
    return pages(spark, d).select(
        "page_id", urls.url_tag(u).alias("url_tag"), names.tagged_name(u, require_suffix=False).alias("tagged_name"),
        names.bulk_name(u, "cc", 40, urls.deck_extension(u)).alias("bulk_name"))


@CATALOG.add("url_predicates", rf"""
SELECT page_id, regexp_matches(url, '(?i)\.html?($|[?#&\s])') AS is_link,
       regexp_matches(url, '(?i)\.pptx?($|[?#&\s])') AS is_deck,
       {sql_ends('lower(url)', ['.html', '.pdf', 'feed'])} AS skipped,
       {sql_ends("lower(split_part(url, '?', 1))", ['.html', '/'])} AS ends_so,
       CASE WHEN ends_with(lower(split_part(url, '?', 1)), '.ppt') THEN '.ppt' ELSE '.pptx' END AS extension
FROM pages""")
def url_predicates(spark, d):
    u = F.col("url")
    return pages(spark, d).select(
        "page_id", urls.is_deck_link(u, PAGE_PATTERN).alias("is_link"), urls.is_deck_link(u).alias("is_deck"),
        urls.has_skipped_extension(u, [".html", ".pdf", "feed"]).alias("skipped"),
        urls.ends_with_deck_suffix(u, [".html", "/"]).alias("ends_so"),
        urls.deck_extension(u, unquote=True).alias("extension"))


_REASON = f"""CASE WHEN h = '' THEN NULL
  WHEN {sql_under('h', POLICY.pirate)} THEN 'pirate' WHEN {sql_under('h', POLICY.corporate)} THEN 'corporate'
  WHEN {sql_ends('h', POLICY.tld)} THEN 'tld' WHEN {sql_under('h', POLICY.institution)} THEN 'institution'
  WHEN {sql_under('h', POLICY.research)} THEN 'research' WHEN {sql_under('h', POLICY.commercial)} THEN 'commercial'
  WHEN ends_with(h, '.edu') THEN 'edu' END"""
_POLICY_SQL = f"SELECT page_id, {_REASON} AS block_reason FROM (SELECT page_id, {AUTHORITY} AS h FROM pages) t"


@CATALOG.add("domain_policy", _POLICY_SQL)
def domain_policy(spark, d):
    return policy.with_block_reason(pages(spark, d), "url", POLICY).select("page_id", "block_reason")


@CATALOG.add("domain_policy_joined", _POLICY_SQL)
def domain_policy_joined(spark, d):
    rows = [(rule, v) for rule in policy.RULES[:-1] for v in getattr(POLICY, rule)]
    listed = spark.createDataFrame(rows, "rule string, value string")
    return policy.block_reason_by_join(pages(spark, d), "url", listed, ["page_id"]).select("page_id", "block_reason")


@CATALOG.add("domain_policy_counts", f"""
SELECT coalesce({_REASON}, 'allowed') AS reason, count(*) AS n
FROM (SELECT {AUTHORITY} AS h FROM pages) t GROUP BY 1""")
def domain_policy_counts(spark, d):
    reason = F.coalesce(policy.block_reason(F.col("url"), POLICY), F.lit("allowed"))
    return pages(spark, d).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


_LEGACY_LIST = ["cheap-pills.example.com", "thther.org", "spam-farm.example.org"]
_TRUSTED = ["tionble.example.com", "ththed.example.org"]


@CATALOG.add("domain_policy_legacy", rf"""
SELECT page_id, CASE WHEN h = '' THEN TRUE WHEN {sql_under('h', _TRUSTED)} THEN FALSE
  WHEN ends_with(h, '.net') OR h = 'net' THEN TRUE
  ELSE regexp_extract(h, '([^.]+\.[^.]+)$', 1) IN ({', '.join(q(x) for x in _LEGACY_LIST)})
       OR {' OR '.join(f"ends_with(h, {q('.' + x)})" for x in _LEGACY_LIST)} END AS blocked
FROM (SELECT page_id, regexp_replace(split_part({AUTHORITY}, ':', 1), '^www\.', '') AS h FROM pages) t""")
def domain_policy_legacy(spark, d):
    return pages(spark, d).select("page_id", policy.is_blocked_legacy(
        F.col("url"), _LEGACY_LIST, [".net", ".us"], ["com", "org", "net"], _TRUSTED).alias("blocked"))


@CATALOG.add("source_priority", f"""
SELECT page_id, CASE WHEN {sql_ends('h', ['.example.org', '.eu'])} THEN 10 ELSE 5 END AS priority,
       CASE WHEN {sql_ends('h', fv.TARGET_TLDS)} THEN 10 ELSE 5 END AS default_priority
FROM (SELECT page_id, {AUTHORITY} AS h FROM pages) t""")
def source_priority(spark, d):
    return pages(spark, d).select("page_id", policy.priority(F.col("url"), [".example.org", ".eu"]).alias("priority"),
                                  policy.priority(F.col("url")).alias("default_priority"))


@CATALOG.add("site_url_screen", rf"""
SELECT page_id, NOT regexp_matches(url, '{fv.SITE_REJECT_PATTERN}') AND NOT regexp_matches(url, '[一-鿿]') AS allowed,
       NOT regexp_matches(url, '(?i)/fr/|utm_source') AS allowed_by_parameter
FROM pages""")
def site_url_screen(spark, d):
    u = F.col("url")
    return pages(spark, d).select("page_id", policy.site_url_allowed(u).alias("allowed"),
                                  policy.site_url_allowed(u, DENIED_PAGE).alias("allowed_by_parameter"))


_ROBOTS = f"""robots AS (SELECT domain, CASE WHEN substr(md5(domain), 1, 1) < '6' THEN 'User-agent: *' || chr(10) || 'Disallow: /'
    WHEN substr(md5(domain), 1, 1) < 'a' THEN 'Disallow: /' || chr(10) || 'Allow: /open' ELSE 'Disallow:' END AS text
  FROM (SELECT DISTINCT {AUTHORITY} AS domain FROM pages) t WHERE substr(md5(domain), 1, 1) < 'e')"""


@CATALOG.add("robots_review", f"""WITH {_ROBOTS}
SELECT page_id, CASE WHEN r.domain IS NOT NULL AND contains(lower(r.text), 'disallow: /')
    AND NOT regexp_matches(lower(r.text), '(?m)^\\s*allow:') AND NOT {sql_under('p.h', ['ththan.example.net'])}
    THEN 'REVIEW' ELSE 'PASS' END AS robots_txt, 'PASS' AS robots_txt_reference
FROM (SELECT page_id, {AUTHORITY} AS h FROM pages) p LEFT JOIN robots r ON r.domain = p.h""")
def robots_review(spark, d):
    p = pages(spark, d)
    first = F.substring(F.md5(F.encode(F.col("domain"), "UTF-8")), 1, 1)
    robots = p.select(urls.authority(F.col("url")).alias("domain")).distinct().where(first < "e").withColumn(
        "text", F.when(first < "6", "User-agent: *\nDisallow: /").when(first < "a", "Disallow: /\nAllow: /open")
        .otherwise("Disallow:"))
    strict = policy.with_robots(p, "url", robots, ["page_id"], exempt=["ththan.example.net"])
    both = policy.with_robots(strict, "url", robots, ["page_id"], "reference", "robots_txt_reference")
    return both.select("page_id", "robots_txt", "robots_txt_reference")


@CATALOG.add("rights_and_api_hosts", f"""
SELECT page_id, 'PASS' AS third_party_rights, {sql_under('h', ['example.org', 'zenodo.org'])} AS is_known_open_source,
       {sql_under('h', ['ththly.example.org'])} AS is_api_source
FROM (SELECT page_id, {AUTHORITY} AS h FROM pages) t""")
def rights_and_api_hosts(spark, d):
    status, known = policy.rights_review(F.col("url"), ["example.org", "zenodo.org"])
    return pages(spark, d).select("page_id", status.alias("third_party_rights"), known.alias("is_known_open_source"),
                                  policy.is_api_source(F.col("url"), ["ththly.example.org"]).alias("is_api_source"))


_ALL_BLOCKED = fv.KEYWORD_POLICIES["multi_source_url"]


@CATALOG.add("keyword_policies", f"""
SELECT page_id, {sql_any('u', ['/fr/', 'tion', '#top'])} OR {sql_any('h', ['worthless', 'shsh'])} AS by_parameter,
       {", ".join(f"{sql_any('u', ks)} AS {name}" for name, ks in fv.KEYWORD_POLICIES.items())}
FROM (SELECT page_id, lower(url) AS u, lower(html) AS h FROM pages) t""")
def keyword_policies(spark, d):
    out = policy.keyword_policy(pages(spark, d), ["url"], ["/fr/", "tion", "#top"], "a")
    out = policy.keyword_policy(out, ["html"], ["worthless", "shsh"], "b").withColumn("by_parameter", F.col("a") | F.col("b"))
    for name, keywords in fv.KEYWORD_POLICIES.items():
        out = policy.keyword_policy(out, ["url"], keywords, name)
    return out.select("page_id", "by_parameter", *fv.KEYWORD_POLICIES)


# ---- links -------------------------------------------------------------------
_BASE = r"regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
_LINKS = rf"""links AS (
  SELECT DISTINCT page_id, {_BASE} || r AS link FROM (
    SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1)) AS r, TRUE AS anchor FROM pages
    UNION ALL
    SELECT page_id, url, unnest(regexp_extract_all(html, '/(?:the|der|los)[a-z]+', 0)), FALSE FROM pages) t
  WHERE NOT anchor OR regexp_matches(r, '^/[a-z]{{3,}}$'))"""


def links_of(spark, d):
    return frontier.page_links(pages(spark, d), link_pattern=LINK_PATTERN, raw_pattern=None,
                               repository_pattern=REPOSITORY_PATTERN)


@CATALOG.add("page_links", f"WITH {_LINKS} SELECT page_id, link FROM links")
def page_links(spark, d):
    return links_of(spark, d)


@CATALOG.add("relative_links", rf"""
SELECT page_id, 'https:' || '//cdn.example.org/a' AS protocol_relative, {_BASE} || '/x/y?z=1' AS rooted,
       {_BASE} || p || '?page=9' AS query_only,
       {_BASE} || regexp_replace(p, '[^/]*$', '') || 'deck%20one.pptx#s2' AS sibling,
       {_BASE} || '/up.pptx' AS parent, 'http://other.example.com/z' AS absolute
FROM (SELECT page_id, replace(url, 'http:', 'https:') AS url,
             regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p FROM pages) t""")
def relative_links(spark, d):
    base = F.replace(F.col("url"), F.lit("http:"), F.lit("https:"))

    def go(ref):
        return urls.resolve_url(base, F.lit(ref))
    return pages(spark, d).select(
        "page_id", go("//cdn.example.org/a").alias("protocol_relative"), go("/x/y?z=1").alias("rooted"),
        go("?page=9").alias("query_only"), go("deck%20one.pptx#s2").alias("sibling"),
        go("../../../up.pptx").alias("parent"), go("http://other.example.com/z").alias("absolute"))


@CATALOG.add("download_links", rf"""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://f.example.org/download/' || page_id || '.pptx'
    WHEN 1 THEN '/export/' || page_id || '.PPT' WHEN 2 THEN 'https://s.example.org/download/' || page_id END AS link
FROM pages""")
def download_links(spark, d):
    i = F.col("page_id").cast("string")
    kind = F.col("page_id") % 4
    extra = F.when(kind == 0, F.concat(F.lit('<a class="b" href="https://f.example.org/download/'), i, F.lit('.pptx">')))
    extra = extra.when(kind == 1, F.concat(F.lit("<a href='/export/"), i, F.lit(".PPT'>"))).otherwise("")
    address = F.when(kind == 3, F.col("url")).otherwise(F.concat(F.lit("https://s.example.org/a-title-"), i))
    return pages(spark, d).select("page_id", urls.download_link(
        F.concat("html", extra), address, "https://s.example.org").alias("link"))


@CATALOG.add("snapshot_urls", """
SELECT event_id, 'https://web.archive.org/web/' || strftime(ts, '%Y%m%d%H%M%S') || 'id_/https://a.example.org/' || user_id AS link,
       date_trunc('second', ts) AS captured
FROM events""")
def snapshot_urls(spark, d):
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    target = F.concat(F.lit("https://a.example.org/"), F.col("user_id").cast("string"))
    return table(spark, d, "events").select("event_id", urls.snapshot_url(stamp, target).alias("link"),
                                            urls.stamp_to_time(stamp).cast("timestamp_ntz").alias("captured"))


@CATALOG.add("code_host_urls", """
SELECT page_id, 'https://raw.githubusercontent.com/o/r' || page_id || '/main/a.pptx' AS link FROM pages""")
def code_host_urls(spark, d):
    page = F.concat(F.lit("https://github.com/o/r"), F.col("page_id").cast("string"), F.lit("/blob/main/a.pptx"))
    return pages(spark, d).select("page_id", urls.raw_code_host_url(page).alias("link"))


# ---- index records -------------------------------------------------------------
_INDEX = """idx AS (
  SELECT page_id, url, CASE WHEN page_id % 5 = 0 THEN 'application/vnd.ms-powerpoint' ELSE 'text/html' END AS mime,
         CASE WHEN page_id % 7 = 0 THEN 'Application/PowerPoint' END AS detected,
         CASE WHEN page_id % 11 = 0 THEN '-' WHEN page_id % 13 = 0 THEN '0' ELSE CAST(strlen(html) AS VARCHAR) END AS length,
         CASE WHEN page_id % 17 = 0 THEN '' ELSE 'warc-' || page_id END AS filename
  FROM pages)"""


def index_records(spark, d):
    i = F.col("page_id")
    return pages(spark, d).select(
        "page_id", "url", F.when(i % 5 == 0, "application/vnd.ms-powerpoint").otherwise("text/html").alias("mime"),
        F.when(i % 7 == 0, "Application/PowerPoint").alias("detected"),
        F.when(i % 11 == 0, "-").when(i % 13 == 0, "0").otherwise(F.octet_length("html").cast("string")).alias("length"),
        F.when(i % 17 == 0, "").otherwise(F.concat(F.lit("warc-"), i.cast("string"))).alias("filename"))


@CATALOG.add("index_record_rules", f"""WITH {_INDEX}
SELECT page_id, mime = 'application/vnd.ms-powerpoint' OR coalesce(lower(detected), '') = 'application/powerpoint'
         OR ends_with(lower(split_part(url, '?', 1)), '.html') AS is_deck,
       NOT (coalesce(TRY_CAST(length AS BIGINT), 0) > 0 AND coalesce(TRY_CAST(length AS BIGINT), 0) < 15000) AS size_open,
       filename <> '' AND length <> '0' AS complete
FROM idx""")
def index_record_rules(spark, d):
    return index_records(spark, d).select(
        "page_id", integrity.is_deck_record(F.col("mime"), F.col("detected"), F.col("url"), suffixes=[".html"]).alias("is_deck"),
        integrity.declared_size_ok(F.col("length"), 15000).alias("size_open"),
        integrity.is_complete(F.col("url"), F.col("filename"), F.col("length")).alias("complete"))


@CATALOG.add("catalogue_resource_rule", """
SELECT page_id, ends_with(lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)), '.html')
       OR upper(trim(CASE WHEN page_id % 6 = 0 THEN ' pptx ' ELSE 'PDF' END)) IN ('PPT', 'PPTX') AS is_deck
FROM pages""")
def catalogue_resource_rule(spark, d):
    declared = F.when(F.col("page_id") % 6 == 0, " pptx ").otherwise("PDF")
    return pages(spark, d).select("page_id", integrity.is_deck_resource(F.col("url"), declared, [".html"]).alias("is_deck"))


@CATALOG.add("content_type_rules", """
SELECT page_id, c LIKE '%vnd.ms-powerpoint%' OR ((c LIKE '%octet-stream%' OR c LIKE '%binary%' OR c = '')
         AND (ends_with(f, '.ppt') OR ends_with(f, '.pptx'))) AS admissible,
       c = '' OR c LIKE '%vnd.ms-powerpoint%' OR c LIKE '%stream%' AS expected
FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'application/vnd.ms-powerpoint; charset=x' WHEN 1 THEN 'application/octet-stream'
                      WHEN 2 THEN 'text/html' ELSE '' END AS c,
             CASE WHEN page_id % 3 = 0 THEN 'https://a/b.pptx' ELSE 'https://a/b' END AS f FROM pages) t""")
def content_type_rules(spark, d):
    i = F.col("page_id")
    header = (F.when(i % 4 == 0, "application/vnd.ms-powerpoint; charset=x").when(i % 4 == 1, "Application/Octet-Stream")
              .when(i % 4 == 2, "text/html").otherwise(""))
    final = F.when(i % 3 == 0, "https://a/B.PPTX?x=1").otherwise("https://a/b")
    return pages(spark, d).select(
        "page_id", integrity.content_type_admissible(header, final, F.col("url")).alias("admissible"),
        integrity.content_type_expected(header).alias("expected"))


_ARRIVALS = f"""arrivals AS (SELECT page_id AS seq, {AUTHORITY} AS host, url FROM pages)"""


@CATALOG.add("first_and_last_per_url", f"""WITH {_ARRIVALS}
SELECT host, min_by(url, seq) AS first_url, max_by(url, seq) AS last_url FROM arrivals GROUP BY host""")
def first_and_last_per_url(spark, d):
    a = pages(spark, d).select(F.col("page_id").alias("seq"), urls.authority(F.col("url")).alias("host"), "url")
    first = dedup.keep_one(a, ["host"], ["seq"], "first").select("host", F.col("url").alias("first_url"))
    last = dedup.keep_one(a, ["host"], ["seq"], "last").select("host", F.col("url").alias("last_url"))
    return first.join(last, "host")


@CATALOG.add("unseen_candidates", """
SELECT page_id FROM pages WHERE page_id NOT IN (
  SELECT p.page_id FROM pages p JOIN pages s ON substr(sha1(p.url), 1, 10) = substr(sha1(s.url), 1, 10)
  WHERE s.page_id % 3 = 0)""")
def unseen_candidates(spark, d):
    tagged = pages(spark, d).withColumn("tag", urls.url_tag(F.col("url")))
    seen = tagged.where(F.col("page_id") % 3 == 0).select("tag")
    return ledger.drop_seen(tagged, seen, ["tag"], ["page_id"]).select("page_id")


@CATALOG.add("unseen_candidates_large_ledger", """
SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 50)""")
def unseen_candidates_large_ledger(spark, d):
    e = table(spark, d, "events")
    seen = e.where((F.col("event_type") == "error") & (F.col("value") > 50)).select("user_id")
    return ledger.drop_seen(e, seen, ["user_id"], ["event_id"], small_rows=0).select("event_id")


@CATALOG.add("unseen_candidates_indexed_ledger", """
SELECT page_id FROM pages WHERE substr(sha1(url), 1, 10) NOT IN (
  SELECT substr(sha1(url), 1, 10) FROM pages WHERE page_id % 3 = 0 OR page_id % 7 = 1)""")
def unseen_candidates_indexed_ledger(spark, d):
    """The ledger of two earlier runs as a stored index, asked for every page."""
    tagged = pages(spark, d).withColumn("tag", urls.url_tag(F.col("url")))
    index = LedgerIndex(spark, scratch_path(spark, "ledger-index"), "tag string", buckets=64)
    index.append(tagged.where(F.col("page_id") % 3 == 0), "first")
    index.add_new(tagged.where(F.col("page_id") % 7 == 1), "second")
    return index.drop_seen(tagged, ["page_id"]).select("page_id")


@CATALOG.add("completed_units", """
SELECT event_type, user_id, count(*) AS n FROM events WHERE (event_type, user_id) NOT IN (
  SELECT event_type, user_id FROM events WHERE value > 60) GROUP BY ALL""")
def completed_units(spark, d):
    e = table(spark, d, "events")
    done = e.where(F.col("value") > 60).select("event_type", "user_id")
    left = ledger.drop_seen(e, done, ["event_type", "user_id"], ["event_id"])
    return left.groupBy("event_type", "user_id").agg(F.count("*").alias("n"))


@CATALOG.add("candidate_selection", rf"""WITH {_LINKS},
res AS (SELECT page_id, url, substr(sha1(url), 1, 10) AS tag FROM pages),
fresh AS (SELECT page_id, url FROM res WHERE tag NOT IN (SELECT substr(sha1(url), 1, 10) FROM pages WHERE page_id % 4 = 0)),
cand AS (
  SELECT page_id, 0 AS hop, url AS candidate FROM fresh WHERE regexp_matches(url, '(?i)\.html?($|[?#&\s])')
  UNION ALL
  SELECT f.page_id, 1, l.link FROM fresh f JOIN links l USING (page_id)
  WHERE NOT regexp_matches(f.url, '(?i)\.html?($|[?#&\s])') AND NOT ends_with(lower(f.url), 'feed'))
SELECT candidate, min_by(page_id, page_id * 2 + hop) AS page_id, min_by(hop, page_id * 2 + hop) AS hop,
       substr(sha1(candidate), 1, 10) AS tag
FROM cand WHERE hop = 0 OR substr(sha1(candidate), 1, 10) NOT IN (SELECT substr(sha1(url), 1, 10) FROM pages WHERE page_id % 4 = 0)
GROUP BY candidate""")
def candidate_selection(spark, d):
    p = pages(spark, d)
    seen = p.where(F.col("page_id") % 4 == 0).select(urls.url_tag(F.col("url")).alias("tag"))
    return frontier.select_candidates(p.select("page_id", "url"), links_of(spark, d), seen, ["page_id"],
                                      link_pattern=PAGE_PATTERN, skip=["feed"])


# ---- frontier -------------------------------------------------------------------
_TOPICS = ["lecture slides", "physics", "economics"]
_DOMAINS = f"""domains AS (SELECT DISTINCT regexp_extract(h, '([^.]+)$', 1) AS country, 'site:' || h AS domain
  FROM (SELECT {AUTHORITY} AS h FROM pages) t)"""
_DRAW = "('0x' || substr(md5({key} || '|{seed}'), 1, 8))::BIGINT % 100 < {pct}"


def seed_domains(spark, d):
    host = urls.authority(F.col("url"))
    return pages(spark, d).select(F.substring_index(host, ".", -1).alias("country"),
                                  F.concat(F.lit("site:"), host).alias("domain")).distinct()


@CATALOG.add("query_frontier", f"""WITH {_DOMAINS},
b AS (SELECT country, domain, unnest(['filetype:pptx', 'filetype:ppt', 'lecture filetype:pptx']) AS head
      FROM (SELECT DISTINCT country, 'site:' || country AS domain FROM domains) x),
m AS (SELECT country, domain, unnest({sql_list(_TOPICS)}) AS topic FROM domains),
k AS (SELECT *, 'pptx' AS kind FROM m UNION ALL
      SELECT *, 'ppt' FROM m WHERE {_DRAW.format(key="country || '|' || topic || '|' || domain", seed=7, pct=20)})
SELECT country, 0 AS priority, head || ' ' || domain AS query, NULL AS shuffle_rank FROM b
UNION ALL
SELECT country, 1, '"' || topic || '" filetype:' || kind || ' ' || domain,
       substr(md5('"' || topic || '" filetype:' || kind || ' ' || domain || '|7'), 1, 16) FROM k""")
def query_frontier(spark, d):
    domains = seed_domains(spark, d)
    broad = domains.select("country", F.concat(F.lit("site:"), F.col("country")).alias("domain")).distinct()
    return frontier.build_frontier(domains, _TOPICS, broad, ["lecture"], seed=7)


@CATALOG.add("query_frontier_from_seed", f"""WITH {_DOMAINS},
t AS (SELECT DISTINCT CASE WHEN lang = 'en' THEN 'com' WHEN lang = 'de' THEN 'net' ELSE 'org' END AS country, source AS topic FROM documents
      UNION ALL SELECT DISTINCT country, unnest(['law', 'history']) FROM domains)
SELECT country, 1 AS priority, '"' || topic || '" filetype:pptx ' || domain AS query FROM domains JOIN t USING (country)
UNION ALL SELECT country, 0, unnest(['filetype:pptx', 'filetype:ppt']) || ' site:' || country FROM (SELECT DISTINCT country FROM domains) x""")
def query_frontier_from_seed(spark, d):
    domains = seed_domains(spark, d).select("country", F.lit("domain").alias("kind"), F.col("domain").alias("value"))
    broad = domains.select("country", F.lit("broad").alias("kind"), F.concat(F.lit("site:"), "country").alias("value")).distinct()
    lang = F.col("lang")
    topics = table(spark, d, "documents").select(F.when(lang == "en", "com").when(lang == "de", "net").otherwise("org").alias("country"),
                                                 F.lit("topic").alias("kind"), F.col("source").alias("value")).distinct()
    seed = domains.unionByName(broad).unionByName(topics)
    return frontier.frontier_from_seed(seed, ["law", "history"], ppt_percent=0).drop("shuffle_rank")


@CATALOG.add("query_frontier_per_country", f"""WITH {_DOMAINS},
m AS (SELECT country, domain, unnest(CASE country WHEN 'com' THEN ['law', 'optics'] WHEN 'org' THEN ['algebra'] END) AS topic FROM domains)
SELECT country, 1 AS priority, '"' || topic || '" filetype:' || kind || ' ' || domain AS query
FROM (SELECT *, unnest(['pptx', 'ppt']) AS kind FROM m) t""")
def query_frontier_per_country(spark, d):
    lists = {"com": ["law", "optics"], "org": ["algebra"]}
    return frontier.build_frontier(seed_domains(spark, d), lists, ppt_percent=100, shuffle=False).drop("shuffle_rank")


@CATALOG.add("query_frontier_main_domain", f"""WITH {_DOMAINS}
SELECT priority, count(*) AS n, count(DISTINCT query) AS distinct_queries FROM (
  SELECT 0 AS priority, topic || domain AS query FROM (SELECT domain, unnest({sql_list(_TOPICS)}) AS topic FROM domains
    WHERE domain = (SELECT max(domain) FROM domains)) a
  UNION ALL
  SELECT 1, topic || domain FROM (SELECT domain, unnest(['lecture slides', 'presentation', 'course notes']) AS topic FROM domains
    WHERE domain <> (SELECT max(domain) FROM domains)) b) c GROUP BY priority""")
def query_frontier_main_domain(spark, d):
    domains = seed_domains(spark, d)
    main = domains.agg(F.max("domain")).first()[0]
    f = frontier.fixed_and_sampled(domains, _TOPICS, main, main_topics_percent=0)
    return f.groupBy("priority").agg(F.count("*").alias("n"), F.count_distinct("query").alias("distinct_queries"))


@CATALOG.add("query_frontier_sampled", f"""WITH {_DOMAINS},
few AS (SELECT country, domain FROM domains
        QUALIFY row_number() OVER (PARTITION BY country ORDER BY substr(md5(domain || '|3'), 1, 16), domain) <= 3),
t AS (SELECT c.country, topic FROM (SELECT DISTINCT country FROM domains) c, (SELECT unnest({sql_list(sorted(fv.ENGLISH_TOPICS))}) AS topic) x
      QUALIFY row_number() OVER (PARTITION BY c.country ORDER BY substr(md5(c.country || '|' || topic || '|3'), 1, 16)) <= 5)
SELECT country, unnest(['filetype:pptx', 'filetype:ppt']) || ' ' || domain AS query FROM domains
UNION ALL
SELECT few.country, '"' || topic || '" filetype:pptx ' || domain FROM few JOIN t USING (country)""")
def query_frontier_sampled(spark, d):
    return frontier.sample_frontier(seed_domains(spark, d), fv.ENGLISH_TOPICS, n_topics=5, n_domains=3, seed=3)


@CATALOG.add("keyword_queries", """
SELECT query FROM (SELECT unnest([k || ' presentation', k || ' lecture', k || ' slides', k,
    CASE WHEN page_id < 20 THEN 'site:edu ' || k END]) AS query
  FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS k FROM pages) t) u WHERE query IS NOT NULL""")
def keyword_queries(spark, d):
    k = pages(spark, d).select(F.col("page_id").alias("position"),
                               F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("discipline"))
    return frontier.keyword_queries(k)


@CATALOG.add("results_capped_per_query", """
SELECT event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 40""")
def results_capped_per_query(spark, d):
    e = table(spark, d, "events")
    return batches.cap_per_query(e, 40, [F.desc("value"), "event_id"], ["event_id"], "event_type").select("event_type", "event_id")


@CATALOG.add("results_page_window", """
SELECT user_id, CAST(ceil(r / 5.0) AS INTEGER) AS page, count(*) AS n
FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) t
WHERE r <= 20 GROUP BY ALL""")
def results_page_window(spark, d):
    ranked = scale.number_in_group(table(spark, d, "events").select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], "rank", ["event_id"])
    return batches.page_window(ranked, 5, 4).groupBy("user_id", "page").agg(F.count("*").alias("n"))


@CATALOG.add("first_results_to_target", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 500")
def first_results_to_target(spark, d):
    return batches.take_target(table(spark, d, "events").select("event_id", "ts"), ["ts", "event_id"], 500).withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))


@CATALOG.add("skipped_identifiers", """
SELECT user_id, count(*) AS n FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id < 50) GROUP BY 1""")
def skipped_identifiers(spark, d):
    e = table(spark, d, "events")
    skip = e.where(F.col("event_id") < 50).select("user_id")
    return ledger.drop_seen(e, skip, ["user_id"], ["event_id"]).groupBy("user_id").agg(F.count("*").alias("n"))
