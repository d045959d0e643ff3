"""Registered queries over document text: screens, slides, tiers and verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.catalog.common import (FILES, SLIDES, Catalog, files, heavy_files, lines, longs, q, slide_rows, spread_table, sql_any, sql_count, sql_hits,
                                     sql_under, table)
from deckmill.config import IntegrityRules, PersonalDataRules, QualityRules
from deckmill.functions import content as ct
from deckmill.functions import names
from deckmill.functions import text as tx
from deckmill.operators import integrity, policy, quality, screens, verdict

CATALOG = Catalog()

# The given texts hold none of the screened phrases, so each screen is also
# registered with phrases that do occur.
MINORS = ["thereon", "ndhe", "license"]
PROHIBITED = ["worthless", "all rights", "released under"]
REASONING = ["tion", "ment", "keit", "whst", "eaea", "that", "with", "und", "los", "que", "shsh"]
MARKERS = quality.SlideMarkers(chart=("eaea", "ment"), diagram=("whst", "keit"), image=("shsh", "aux"),
                               shape=r"[.?!]", table=("|",))
PIRATE = ["src3.example.org", "src11.example.org"]


def docs(spark, d):
    return spread_table(spark, d, "documents", "doc_id")


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all(text, {q(pattern)}))"


_COUNTS = f"""counts AS (SELECT doc_id, {_count(fv.EMAIL_PATTERN)} AS e, {_count(fv.SSN_PATTERN)} AS s,
  {_count(fv.PHONE_PATTERN)} AS p FROM documents)"""


def _pii_detail(emails: int, ssns: int, phones: int) -> str:
    return (f"concat_ws('; ', CASE WHEN e > {emails} THEN e || ' email addresses' END, "
            f"CASE WHEN s > {ssns} THEN s || ' SSN-like patterns' END, CASE WHEN p > {phones} THEN p || ' phone numbers' END)")


def _pii_sql(emails: int, ssns: int, phones: int) -> str:
    detail = _pii_detail(emails, ssns, phones)
    return (f"WITH {_COUNTS} SELECT doc_id, e AS n_emails, s AS n_ssns, p AS n_phones, {detail} AS pii_detail, "
            f"{detail} <> '' AS has_pii FROM counts")


_PII_COLUMNS = ["doc_id", "n_emails", "n_ssns", "n_phones", "pii_detail", "has_pii"]


@CATALOG.add("personal_data_screen", _pii_sql(2, 0, 3))
def personal_data_screen(spark, d):
    return longs(screens.screen_personal_data(docs(spark, d), "text").select(*_PII_COLUMNS))


@CATALOG.add("personal_data_screen_strict", _pii_sql(0, 0, 0))
def personal_data_screen_strict(spark, d):
    rules = PersonalDataRules(emails_allowed=0, phones_allowed=0)
    return longs(screens.screen_personal_data(docs(spark, d), "text", rules).select(*_PII_COLUMNS))


def _kw_sql(keywords, name, lead):
    hits = sql_hits("t", keywords)
    return (f"SELECT doc_id, {hits} <> '' AS has_{name}, CASE WHEN {hits} <> '' THEN '{lead}: ' || {hits} ELSE '' END AS {name}_detail "
            "FROM (SELECT doc_id, lower(text) AS t FROM documents) x")


@CATALOG.add("minors_screen", _kw_sql(fv.MINORS_KEYWORDS, "minors", "COPPA keywords found"))
def minors_screen(spark, d):
    return screens.screen_minors(docs(spark, d), "text").select("doc_id", "has_minors", "minors_detail")


@CATALOG.add("minors_screen_by_parameter", _kw_sql(MINORS, "minors", "COPPA keywords found"))
def minors_screen_by_parameter(spark, d):
    return screens.screen_minors(docs(spark, d), "text", MINORS).select("doc_id", "has_minors", "minors_detail")


@CATALOG.add("prohibited_screen", _kw_sql(fv.PROHIBITED_KEYWORDS, "prohibited", "Prohibited content keywords"))
def prohibited_screen(spark, d):
    return screens.screen_prohibited(docs(spark, d), "text").select("doc_id", "has_prohibited", "prohibited_detail")


@CATALOG.add("prohibited_screen_by_parameter", _kw_sql(PROHIBITED, "prohibited", "Prohibited content keywords"))
def prohibited_screen_by_parameter(spark, d):
    return screens.screen_prohibited(docs(spark, d), "text", PROHIBITED).select("doc_id", "has_prohibited", "prohibited_detail")


@CATALOG.add("geo_and_language_filter", f"""
SELECT doc_id, NOT {sql_any('t', fv.US_KEYWORDS)} AND eng AS allowed, eng AS english, NOT {sql_any('t', fv.US_KEYWORDS)} AS foreign_text
FROM (SELECT doc_id, t, {sql_any('t', fv.ENGLISH_MARKERS)} OR (NOT regexp_matches(t, '[^\\x00-\\x7F]')
        AND CASE WHEN trim(t, chr(10) || ' ') = '' THEN 0 ELSE len(regexp_split_to_array(trim(t, chr(10) || ' '), '\\s+')) END <= 5) AS eng
      FROM (SELECT doc_id, lower(source || ' ' || text) AS t FROM documents) a) b""")
def geo_and_language_filter(spark, d):
    low = docs(spark, d).withColumn("t", F.lower(F.concat_ws(" ", "source", "text")))
    return low.select("doc_id", policy.geo_allowed(F.col("t")).alias("allowed"), tx.looks_english(F.col("t")).alias("english"),
                      policy.geo_allowed(F.col("t"), require_english=False).alias("foreign_text"))


@CATALOG.add("script_density", f"""WITH {SLIDES}
SELECT doc_id, max(len(regexp_extract_all(text, '[éèê]'))) > 10 AS dense,
       max(CASE WHEN slide_number = 1 THEN len(regexp_extract_all(text, '[éèê]')) END) > 10 AS dense_first,
       max(len(regexp_extract_all(text, '[一-鿿]'))) > 50 AS cjk
FROM slides GROUP BY doc_id""")
def script_density(spark, d):
    parts = lines(F.col("text"))
    return docs(spark, d).select(
        "doc_id", screens.cjk_dense(parts, 10, "[éèê]").alias("dense"),
        screens.cjk_dense(parts, 10, "[éèê]", first_only=True).alias("dense_first"), screens.cjk_dense(parts).alias("cjk"))


_TERMS = ["tion", "whst", "keit", "eaea"]


@CATALOG.add("topical_density", f"""WITH {SLIDES},
run AS (SELECT doc_id, slide_number, lower(text) AS t, sum(length(lower(text))) OVER w - length(lower(text)) AS before
        FROM slides WINDOW w AS (PARTITION BY doc_id ORDER BY slide_number)),
txt AS (SELECT doc_id, string_agg(CASE WHEN before <= 1500 THEN t END, '' ORDER BY slide_number) AS t,
               string_agg(CASE WHEN before <= 50000 THEN t END, '' ORDER BY slide_number) AS full_t FROM run GROUP BY doc_id)
SELECT doc_id, {sql_count('t', _TERMS)} AS hits, {sql_count('t', _TERMS)} >= 3 AS dense,
       {sql_count('full_t', fv.US_CONTENT_TERMS)} >= 3 AS us_dense FROM txt""")
def topical_density(spark, d):
    parts = lines(F.col("text"))
    hits = screens.topical_hits(parts, _TERMS, 1500)
    return docs(spark, d).select("doc_id", hits.alias("hits"), (hits >= 3).alias("dense"),
                                 screens.topically_dense(parts).alias("us_dense"))


@CATALOG.add("topical_density_whole", f"""WITH {SLIDES},
txt AS (SELECT doc_id, string_agg(lower(text), '' ORDER BY slide_number) AS t FROM slides GROUP BY doc_id)
SELECT doc_id, {sql_count('t', _TERMS)} AS hits, {sql_count('t', _TERMS)} >= 3 AS dense,
       {sql_count('t', fv.US_CONTENT_TERMS)} >= 3 AS us_dense FROM txt""")
def topical_density_whole(spark, d):
    """The same over the whole text."""
    parts = lines(F.col("text"))
    hits = screens.topical_hits(parts, _TERMS, None)
    return docs(spark, d).select("doc_id", hits.alias("hits"), (hits >= 3).alias("dense"),
                                 screens.topically_dense(parts, stop_after=None).alias("us_dense"))


# ---- compliance ---------------------------------------------------------------
_COMPLIANCE = f"""comp AS (
  SELECT f.doc_id, f.source_url, c.e, c.s, c.p,
    CASE WHEN {sql_under('f.host', PIRATE)} THEN 'FAIL' ELSE 'PASS' END AS pirate_site,
    CASE WHEN f.doc_id % 9 = 0 THEN 'REVIEW' ELSE 'PASS' END AS robots_txt, 'PASS' AS third_party_rights,
    CASE WHEN {_pii_detail(0, 0, 0)} <> '' THEN 'REVIEW' ELSE 'PASS' END AS personal_data,
    CASE WHEN {sql_any('f.t', MINORS)} THEN 'FAIL' ELSE 'PASS' END AS coppa_screening,
    CASE WHEN {sql_any('f.t', PROHIBITED)} THEN 'FAIL' ELSE 'PASS' END AS prohibited_content,
    CASE WHEN f.doc_id % 25 = 1 THEN 'FAIL' ELSE 'PASS' END AS public_source,
    {_pii_detail(0, 0, 0)} AS pii_detail, {sql_hits('f.t', MINORS)} AS minor_hits, {sql_hits('f.t', PROHIBITED)} AS prohibited_hits
  FROM (SELECT *, lower(text) AS t, lower(regexp_extract(source_url, '^https://([^/]*)', 1)) AS host FROM files) f JOIN counts c USING (doc_id))"""


def screened(spark, d):
    base = heavy_files(spark, d).withColumns({
        "robots_in": F.when(F.col("doc_id") % 9 == 0, "REVIEW").otherwise("PASS"),
        "reachable": F.col("doc_id") % 25 != 1})
    return screens.compliance(base, "source_url", "text", PIRATE, "robots_in", "reachable",
                              PersonalDataRules(emails_allowed=0, phones_allowed=0), MINORS, PROHIBITED)


@CATALOG.add("compliance_checks", f"""WITH {FILES}, {_COUNTS}, {_COMPLIANCE}
SELECT doc_id, pirate_site, robots_txt, third_party_rights, personal_data, coppa_screening, prohibited_content, public_source,
  concat_ws(',', CASE WHEN pirate_site <> 'PASS' THEN 'pirate_site' END, CASE WHEN robots_txt <> 'PASS' THEN 'robots_txt' END,
    CASE WHEN personal_data <> 'PASS' THEN 'personal_data' END, CASE WHEN coppa_screening <> 'PASS' THEN 'coppa_screening' END,
    CASE WHEN prohibited_content <> 'PASS' THEN 'prohibited_content' END, CASE WHEN public_source <> 'PASS' THEN 'public_source' END) AS failed,
  pirate_site = 'PASS' AND robots_txt = 'PASS' AND personal_data = 'PASS' AND coppa_screening = 'PASS'
    AND prohibited_content = 'PASS' AND public_source = 'PASS' AS all_pass,
  CASE WHEN pirate_site = 'FAIL' THEN 'Source is a blacklisted piracy domain: ' || source_url END AS pirate_detail,
  CASE WHEN prohibited_hits <> '' THEN 'Prohibited content keywords: ' || prohibited_hits END AS prohibited_detail
FROM comp""")
def compliance_checks(spark, d):
    out = screened(spark, d)
    return out.select("doc_id", *screens.CHECKS, F.array_join("failed_checks", ",").alias("failed"), "all_pass",
                      F.try_element_at("compliance_details", F.lit("pirate_site")).alias("pirate_detail"),
                      F.try_element_at("compliance_details", F.lit("prohibited_content")).alias("prohibited_detail"))


# ---- slides and tiers ------------------------------------------------------------
_FLAGS = f"""flags AS (SELECT *, NOT ana AND text_length > 120 AS heavy, img AND NOT ana AND text_length < 400 AS photo FROM (
  SELECT doc_id, slide_number, t, text_length, {sql_any('t', MARKERS.chart)} AS chart, {sql_any('t', MARKERS.table)} AS tbl,
    {sql_any('t', MARKERS.diagram)} AS dia, {sql_any('t', MARKERS.image)} AS img, len(regexp_extract_all(t, '[.?!]')) AS shapes,
    {sql_any('t', [*MARKERS.chart, *MARKERS.table, *MARKERS.diagram])} AS ana
  FROM (SELECT *, lower(text) AS t FROM slides) s) x)"""
RULES = QualityRules(text_heavy_chars=120, photo_heavy_chars=400)


def flagged(spark, d):
    return quality.slide_flags(slide_rows(docs(spark, d)), "text", "text_length", None, None, MARKERS, RULES)


@CATALOG.add("slide_flags", f"""WITH {SLIDES}, {_FLAGS}
SELECT doc_id, slide_number, chart AS has_chart, tbl AS has_table, dia AS has_diagram, FALSE AS has_smartart, img AS has_image,
  text_length, shapes AS shape_count, ana AS is_analytical, heavy AS is_text_heavy, photo AS is_photo_heavy FROM flags""")
def slide_flags(spark, d):
    return longs(flagged(spark, d).select("doc_id", "slide_number", "has_chart", "has_table", "has_diagram", "has_smartart",
                                    "has_image", "text_length", "shape_count", "is_analytical", "is_text_heavy", "is_photo_heavy"))


_REASONING_HITS = " + ".join(f"CAST(bool_or(contains(t, {q(k)})) AS INTEGER)" for k in sorted(set(REASONING)))
_DECKS = f"""decks AS (SELECT *, CAST(ana_n AS DOUBLE) / n AS ana_pct, CAST(heavy_n AS DOUBLE) / n AS heavy_pct,
    CAST(photo_n AS DOUBLE) / n AS photo_pct, least(1.0::DOUBLE, hits / 5.0::DOUBLE) AS score FROM (
  SELECT doc_id, count(*) AS n, count(CASE WHEN ana THEN 1 END) AS ana_n, count(CASE WHEN chart THEN 1 END) AS chart_n, count(CASE WHEN tbl THEN 1 END) AS tbl_n, count(CASE WHEN dia THEN 1 END) AS dia_n,
    count(CASE WHEN heavy THEN 1 END) AS heavy_n, count(CASE WHEN photo THEN 1 END) AS photo_n, {_REASONING_HITS} AS hits FROM flags GROUP BY doc_id) x),
tiers AS (SELECT *, CASE WHEN heavy_pct >= 0.75::DOUBLE THEN 'LOW' WHEN photo_pct >= 0.5::DOUBLE THEN 'LOW'
    WHEN ana_pct >= 0.5::DOUBLE AND chart_n + dia_n >= 3 THEN 'HIGH' WHEN ana_pct >= 0.4::DOUBLE AND chart_n + dia_n >= 1 THEN 'MEDIUM'
    WHEN ana_pct >= 0.2::DOUBLE AND chart_n + dia_n >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM decks)"""


def tiered(spark, d):
    rolled = quality.deck_rollup(flagged(spark, d), ["doc_id"], "text", REASONING, RULES)
    return quality.with_tier(rolled, rules=RULES)


@CATALOG.add("deck_quality_tiers", f"""WITH {SLIDES}, {_FLAGS}, {_DECKS}
SELECT doc_id, n AS slide_count, ana_n AS analytical_slides, chart_n AS chart_slides, tbl_n AS table_slides, dia_n AS diagram_slides,
  heavy_n AS text_heavy_slides, photo_n AS photo_heavy_slides, round(ana_pct, 6) AS analytical_pct, round(heavy_pct, 6) AS text_heavy_pct,
  round(photo_pct, 6) AS photo_heavy_pct, round(score, 6) AS reasoning_score, tier AS quality_classification FROM tiers""")
def deck_quality_tiers(spark, d):
    t = tiered(spark, d)
    return longs(t.select("doc_id", "slide_count", "analytical_slides", "chart_slides", "table_slides", "diagram_slides",
                    "text_heavy_slides", "photo_heavy_slides",
                    *[F.round(c, 6).alias(c) for c in ("analytical_pct", "text_heavy_pct", "photo_heavy_pct", "reasoning_score")],
                    "quality_classification"))


@CATALOG.add("tiers_against_labels", f"""WITH {SLIDES}, {_FLAGS}, {_DECKS}
SELECT tier, quality, toxic, count(*) AS n FROM tiers JOIN labels USING (doc_id) GROUP BY ALL""")
def tiers_against_labels(spark, d):
    judged = tiered(spark, d).select("doc_id", F.col("quality_classification").alias("tier"))
    return judged.join(table(spark, d, "labels"), "doc_id").groupBy("tier", "quality", "toxic").agg(F.count("*").alias("n"))


@CATALOG.add("legacy_tiers", f"""WITH {FILES}
SELECT doc_id, CASE WHEN file_size > 2000 THEN 'MEDIUM' ELSE 'LOW' END AS tier, 'LOW' AS default_tier FROM files WHERE extension = '.ppt'""")
def legacy_tiers(spark, d):
    f = files(spark, d).where(F.col("extension") == ".ppt")
    return f.select("doc_id", quality.legacy_tier(F.col("file_size"), QualityRules(legacy_medium_bytes=2000)).alias("tier"),
                    quality.legacy_tier(F.col("file_size")).alias("default_tier"))


@CATALOG.add("delivery_tiers", f"""WITH {FILES}, {SLIDES}, {_FLAGS},
o AS (SELECT f.doc_id, f.extension, count(CASE WHEN chart THEN 1 END) AS charts, count(CASE WHEN tbl THEN 1 END) AS tables, count(*) AS n
      FROM flags JOIN files f USING (doc_id) GROUP BY ALL)
SELECT doc_id, round((charts + tables) * 100.0::DOUBLE / n, 1) AS analytical_pct,
  CASE WHEN extension = '.ppt' THEN 'UNKNOWN' WHEN (charts + tables) / n::DOUBLE * 100 >= 50 AND charts + tables >= 3 THEN 'HIGH'
       WHEN (charts + tables) / n::DOUBLE * 100 >= 40 OR charts + tables >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS quality FROM o""")
def delivery_tiers(spark, d):
    per = flagged(spark, d).groupBy("doc_id").agg(F.count_if("has_chart").alias("charts"), F.count_if("has_table").alias("tables"),
                                                  F.count("*").alias("n"))
    both = per.join(files(spark, d).select("doc_id", "extension"), "doc_id")
    c, t, n = F.col("charts"), F.col("tables"), F.col("n")
    return both.select("doc_id", F.round(quality.delivery_share(c, t, n), 1).alias("analytical_pct"),
                       quality.delivery_tier(c, t, n, F.col("extension")).alias("quality"))


@CATALOG.add("conversation_rollup", """
SELECT conv_id, count(*) AS slide_count, count(CASE WHEN contains(lower(text), 'tion') THEN 1 END) AS analytical_slides,
       round(count(CASE WHEN contains(lower(text), 'tion') THEN 1 END) / count(*)::DOUBLE, 6) AS analytical_pct
FROM conversations GROUP BY conv_id""")
def conversation_rollup(spark, d):
    c = table(spark, d, "conversations").withColumn("text_length", F.length("text"))
    m = quality.SlideMarkers(chart=("tion",), diagram=(), image=(), table=())
    rolled = quality.deck_rollup(quality.slide_flags(c, "text", "text_length", None, None, m), ["conv_id"])
    return longs(rolled.select("conv_id", "slide_count", "analytical_slides", F.round("analytical_pct", 6).alias("analytical_pct")))


# ---- integrity ----------------------------------------------------------------------
INTEGRITY = IntegrityRules(min_bytes=400, min_slides=3, max_slides=30)
_VALID = """facts AS (SELECT f.*, CASE WHEN contains(substr(lower(text), 1, 1024), 'license') THEN TRUE ELSE FALSE END AS html,
    CASE WHEN contains(text, 'worthless') THEN 'No slide XML found' ELSE '' END AS container, len(string_split(text, chr(10))) AS slides FROM files f),
valid AS (SELECT *, CASE WHEN file_size < 400 THEN 'Below min size (' || file_size || ' < 400B)' WHEN html THEN 'HTML content detected (likely error page)'
    WHEN container <> '' THEN container WHEN slides < 3 THEN 'Insufficient slides (' || slides || ' < 3)'
    WHEN slides > 30 THEN 'Exceeds max slides (' || slides || ' > 30)' ELSE '' END AS reason FROM facts)"""


def validated(df, rules=INTEGRITY):
    facts = df.withColumns({
        "is_html": F.contains(F.substring(F.lower("text"), 1, 1024), F.lit("license")),
        "container_reason": F.when(F.contains("text", F.lit("worthless")), "No slide XML found").otherwise(""),
        "slide_count": F.size(lines(F.col("text"))), "file_hash": F.sha2("text", 256)})
    return integrity.validate(facts, rules).drop("slide_count", "file_hash")


@CATALOG.add("integrity_chain", f"""WITH {FILES}, {_VALID}
SELECT doc_id, reason = '' AS is_valid, reason AS rejection_reason, CASE WHEN reason LIKE 'Below%' THEN '' ELSE sha256(text) END AS file_hash,
  CASE WHEN reason = '' OR reason LIKE 'Insuff%' OR reason LIKE 'Exceeds%' THEN slides ELSE 0 END AS slide_count,
  reason NOT LIKE 'Below%' AS size_ok, NOT (reason LIKE 'HTML%' OR reason LIKE 'No slide%') AS format_ok FROM valid""")
def integrity_chain(spark, d):
    v = validated(files(spark, d))
    return longs(v.select("doc_id", *[F.col(f"validation.{c}").alias(c) for c in (
        "is_valid", "rejection_reason", "file_hash", "slide_count", "size_ok", "format_ok")]))


@CATALOG.add("byte_signatures", """
SELECT page_id, TRUE AS html_page, page_id % 2 = 0 AS zip_magic, page_id % 3 = 0 AND page_id % 2 <> 0 AS ole_magic,
       page_id % 2 = 0 OR page_id % 3 = 0 AS deck_magic FROM pages""")
def byte_signatures(spark, d):
    i = F.col("page_id")
    lead = F.when(i % 2 == 0, F.unhex(F.lit(fv.ZIP_MAGIC_HEX + "0304"))).when(i % 3 == 0, F.unhex(F.lit(fv.OLE_MAGIC_HEX))).otherwise(
        F.encode(F.lit("<"), "UTF-8"))
    page = F.encode("html", "UTF-8")
    body = F.concat(lead, page)
    return table(spark, d, "pages").select("page_id", ct.is_html(page).alias("html_page"), ct.has_zip_magic(body).alias("zip_magic"),
                                           ct.has_ole_magic(body).alias("ole_magic"), ct.has_deck_magic(body).alias("deck_magic"))


@CATALOG.add("content_digests", """
SELECT doc_id, substr(sha1(CAST(doc_id AS VARCHAR) || '.pptx'), 1, 10) AS name_tag, substr(sha1(text), 1, 12) AS content_tag,
       md5(text) AS md5, sha256(text) AS sha256, CAST(NULL AS VARCHAR) AS short_tag, substr(sha1(text), 1, 10) AS long_tag FROM documents""")
def content_digests(spark, d):
    body = F.encode("text", "UTF-8")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".pptx"))
    tagged = F.concat(F.substring(F.sha1(body), 1, 10), F.lit("_"), name)
    return docs(spark, d).select("doc_id", names.file_name_tag(name).alias("name_tag"), names.content_tag(body).alias("content_tag"),
                                 names.content_md5(body).alias("md5"), names.content_sha256(body).alias("sha256"),
                                 names.tag_of_name(F.concat(F.lit("x_"), name)).alias("short_tag"), names.tag_of_name(tagged).alias("long_tag"))


@CATALOG.add("head_bytes_tag", "SELECT page_id, substr(sha1(encode(left(h, 1000))), 1, 10) AS tag FROM (SELECT page_id, regexp_replace(html, '[^\\x00-\\x7F]', '', 'g') AS h FROM pages) t")
def head_bytes_tag(spark, d):
    ascii_html = F.regexp_replace("html", r"[^\x00-\x7F]", "")
    return table(spark, d, "pages").select("page_id", names.head_bytes_tag(F.encode(ascii_html, "UTF-8")).alias("tag"))


@CATALOG.add("head_bytes_tag_raw", "SELECT page_id, substr(sha1(unhex(left(hex(encode(html)), 2000))), 1, 10) AS tag FROM pages")
def head_bytes_tag_raw(spark, d):
    """The first 1,000 bytes as they are, wherever a character is cut."""
    return table(spark, d, "pages").select("page_id", names.head_bytes_tag(F.encode("html", "UTF-8")).alias("tag"))


@CATALOG.add("safe_names", r"""
SELECT doc_id, regexp_replace(substr(text, 1, 60), '[^\p{L}\p{N}_\-]', '_', 'g') AS slug,
  CASE WHEN length('dv_' || substr(text, 1, 240) || '.ppt') > 200 THEN substr('dv_' || substr(text, 1, 240) || '.ppt', 1, 190) || '.ppt'
       ELSE 'dv_' || substr(text, 1, 240) || '.ppt' END AS capped
FROM documents""")
def safe_names(spark, d):
    long = F.concat(F.lit("dv_"), F.substring("text", 1, 240), F.lit(".ppt"))
    return docs(spark, d).select("doc_id", names.title_slug(F.col("text"), 60).alias("slug"), names.capped_name(long, F.lit("a.ppt")).alias("capped"))


@CATALOG.add("legacy_safe_names", r"""
SELECT doc_id, substr(s, 1, 160) || '.pptx' AS name FROM (
  SELECT doc_id, CASE WHEN regexp_matches(c, '(?s)^.+\.[^.]+$') THEN regexp_replace(c, '(?s)\.[^.]+$', '') ELSE c END AS s FROM (
    SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[<>:"/\\|?*\x00-\x1f]', '_', 'g'), '_+', '_', 'g'), '^[_. ]+|[_. ]+$', '', 'g') AS c
    FROM documents) a) b""")
def legacy_safe_names(spark, d):
    return docs(spark, d).select("doc_id", names.legacy_safe_name(F.col("text")).alias("name"))


# ---- verdict ------------------------------------------------------------------------
_STAGES = """stages AS (
  SELECT v.doc_id, v.source, v.reason, v.reason = '' AS valid, v.doc_id % 40 <> 0 AS has_source, c.*, t.tier, t.score, t.ana_n, t.n, t.chart_n, t.tbl_n, t.dia_n, t.ana_pct,
    CASE WHEN v.reason <> '' THEN NULL WHEN c.pirate_site = 'FAIL' THEN 'pirate_site: Source is a blacklisted piracy domain: ' || c.source_url
      WHEN c.coppa_screening = 'FAIL' THEN 'coppa_screening: COPPA keywords found: ' || c.minor_hits
      WHEN c.prohibited_content = 'FAIL' THEN 'prohibited_content: Prohibited content keywords: ' || c.prohibited_hits END AS hard
  FROM valid v JOIN comp c ON c.doc_id = v.doc_id JOIN tiers t ON t.doc_id = v.doc_id),
judged AS (SELECT *, CASE WHEN valid AND hard IS NULL THEN CASE WHEN tier = 'LOW' THEN 'FAIL' ELSE 'PASS' END ELSE 'PENDING' END AS quality_assessment,
    CASE WHEN valid AND hard IS NULL THEN CASE WHEN score >= 0.3::DOUBLE OR tier = 'HIGH' THEN 'PASS' ELSE 'REVIEW' END ELSE 'PENDING' END AS reasoning_quality
  FROM stages),
verdicts AS (SELECT *, CASE WHEN NOT valid OR hard IS NOT NULL OR quality_assessment = 'FAIL' THEN 'REJECT'
    WHEN NOT has_source OR robots_txt = 'REVIEW' OR personal_data = 'REVIEW' OR reasoning_quality = 'REVIEW' THEN 'REVIEW' ELSE 'DELIVER' END AS decision FROM judged)"""
_VERDICT_CTES = f"WITH {FILES}, {_COUNTS}, {_COMPLIANCE}, {SLIDES}, {_FLAGS}, {_DECKS}, {_VALID}, {_STAGES}"


def verified(spark, d, skip_quality=False):
    """The verdict in the document's own row: one scan, no join, no shuffle."""
    slides = F.transform(lines(F.col("text")), lambda t: F.struct(
        F.lit(True).alias("is_slide"), t.alias("xml"), t.alias("text"), F.length(t).alias("text_length"),
        F.contains(t, F.lit("|")).alias("has_table"), F.lit(True).alias("parsed")))
    rolled = quality.rollup_parts(validated(screened(spark, d)).withColumn("parts", slides), "parts", REASONING, MARKERS, RULES)
    facts = quality.with_tier(rolled.drop("parts", "text"), rules=RULES).withColumn("quality_summary", quality.summary_line())
    named = facts.withColumns({"source_url": F.when(F.col("doc_id") % 40 == 0, "").otherwise(F.col("source_url")),
                               "download_url": F.col("source_url"), "filename": F.col("name")})
    return verdict.verify(named, RULES, skip_quality)


@CATALOG.add("verdict", f"""{_VERDICT_CTES}
SELECT doc_id, CASE WHEN valid THEN 'PASS' ELSE 'FAIL' END AS file_integrity,
  CASE WHEN NOT valid THEN 'PENDING' WHEN has_source THEN 'PASS' ELSE 'REVIEW' END AS source_verification,
  CASE WHEN valid THEN public_source ELSE 'PENDING' END AS public_availability, CASE WHEN valid THEN pirate_site ELSE 'PENDING' END AS pirate_screening,
  CASE WHEN valid THEN robots_txt ELSE 'PENDING' END AS robots_access, CASE WHEN valid THEN third_party_rights ELSE 'PENDING' END AS rights_review,
  CASE WHEN valid THEN personal_data ELSE 'PENDING' END AS personal_data, CASE WHEN valid THEN coppa_screening ELSE 'PENDING' END AS coppa_screening,
  CASE WHEN valid THEN prohibited_content ELSE 'PENDING' END AS prohibited_content, quality_assessment, reasoning_quality, decision,
  CASE WHEN valid AND hard IS NULL THEN tier ELSE '' END AS quality_classification,
  concat_ws(' / ', CASE WHEN NOT valid THEN 'Integrity: ' || reason END, CASE WHEN valid AND NOT has_source THEN 'Missing source URL' END, hard,
    CASE WHEN quality_assessment = 'FAIL' THEN 'Quality: LOW (LOW: ' || ana_n || '/' || n || ' analytical (' || CAST(round_even(ana_pct * 100, 0) AS INTEGER)
      || '%), ' || chart_n || ' charts, ' || tbl_n || ' tables, ' || dia_n || ' diagrams)' END) AS reasons
FROM verdicts""")
def full_verdict(spark, d):
    return verified(spark, d).select("doc_id", *verdict.STAGES, "decision", "quality_classification",
                                     F.array_join("rejection_reasons", " / ").alias("reasons"))


@CATALOG.add("verdict_by_source", f"""{_VERDICT_CTES}
SELECT source, decision, count(*) AS n, count(CASE WHEN valid AND hard IS NULL AND tier = 'HIGH' THEN 1 END) AS high FROM verdicts GROUP BY source, decision""")
def verdict_by_source(spark, d):
    v = verified(spark, d)
    return v.groupBy("source", "decision").agg(F.count("*").alias("n"), F.count_if(F.col("quality_classification") == "HIGH").alias("high"))


@CATALOG.add("verdict_without_quality", f"""{_VERDICT_CTES}
SELECT doc_id, CASE WHEN NOT valid OR hard IS NOT NULL THEN 'REJECT' WHEN NOT has_source OR robots_txt = 'REVIEW' OR personal_data = 'REVIEW' THEN 'REVIEW'
    ELSE 'DELIVER' END AS decision, CASE WHEN valid AND hard IS NULL THEN 'MEDIUM' ELSE '' END AS quality_classification FROM verdicts""")
def verdict_without_quality(spark, d):
    return verified(spark, d, skip_quality=True).select("doc_id", "decision", "quality_classification")


@CATALOG.add("verdict_routing", f"""{_VERDICT_CTES}
SELECT CASE WHEN decision = 'REJECT' THEN 'rejected' ELSE 'kept' END AS route, decision, count(*) AS n,
  CAST(sum(CASE WHEN reason = '' OR reason LIKE 'Insuff%' OR reason LIKE 'Exceeds%' THEN v.slides ELSE 0 END) AS BIGINT) AS slides
FROM verdicts JOIN (SELECT doc_id AS id2, slides FROM valid) v ON v.id2 = verdicts.doc_id GROUP BY ALL""")
def verdict_routing(spark, d):
    facts = verdict.write_back(verified(spark, d).drop("slide_count", "file_size"))
    routed = verdict.route(facts.select("doc_id", "decision", "slide_count", "file_hash", "delivery_status"))
    parts = [routed[k].select(F.lit(k).alias("route"), "decision", "slide_count") for k in ("rejected", "kept")]
    return parts[0].unionByName(parts[1]).groupBy("route", "decision").agg(F.count("*").alias("n"), F.sum("slide_count").alias("slides"))


@CATALOG.add("audit_rows", f"""{_VERDICT_CTES}
SELECT lpad(CAST(doc_id AS VARCHAR), 6, '0') || CASE WHEN doc_id % 10 = 0 THEN '.ppt' ELSE '.pptx' END AS filename, '2026-01-01T00:00:00Z' AS timestamp,
  source_url, CASE WHEN valid THEN 'PASS' ELSE 'FAIL' END AS file_integrity, decision,
  CAST(NOT valid AS INTEGER) + CAST(valid AND NOT has_source AS INTEGER) + CAST(hard IS NOT NULL AS INTEGER) + CAST(quality_assessment = 'FAIL' AS INTEGER) AS n_reasons
FROM verdicts""")
def audit_rows(spark, d):
    v = verified(spark, d).withColumn("download_url", F.concat(F.lit("https://"), F.col("lang"), F.lit("."), F.col("source"), F.lit(".example.org/deck/"), F.col("name")))
    a = verdict.audit_rows(v, F.lit("2026-01-01T00:00:00Z"))
    return a.select("filename", "timestamp", "source_url", "file_integrity", "decision", F.size("rejection_reasons").alias("n_reasons"))


@CATALOG.add("stats_by_source", f"""{_VERDICT_CTES},
o AS (SELECT source, CASE decision WHEN 'DELIVER' THEN 'delivered' WHEN 'REVIEW' THEN 'review' ELSE 'rejected' END AS outcome,
             CASE WHEN valid AND hard IS NULL THEN tier ELSE '' END AS tier FROM verdicts)
SELECT coalesce(source, 'TOTAL') AS source, count(*) AS downloaded, count(CASE WHEN outcome = 'delivered' THEN 1 END) AS delivered, count(CASE WHEN outcome = 'review' THEN 1 END) AS review,
  count(CASE WHEN outcome = 'rejected' THEN 1 END) AS rejected, CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS failed, count(CASE WHEN tier = 'HIGH' THEN 1 END) AS high_count, count(CASE WHEN tier = 'MEDIUM' THEN 1 END) AS medium_count,
  count(CASE WHEN tier = 'LOW' THEN 1 END) AS low_count FROM o GROUP BY ROLLUP (source)""")
def stats_by_source(spark, d):
    from deckmill.operators import stats

    outcome = F.when(F.col("decision") == "DELIVER", "delivered").when(F.col("decision") == "REVIEW", "review").otherwise("rejected")
    return stats.source_stats(verified(spark, d).withColumn("outcome", outcome))
