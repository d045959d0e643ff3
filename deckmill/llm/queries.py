"""The registered queries of the operators, with production parameters over the whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deckmill.catalog.common import Catalog
from deckmill.llm import (bloom_lookup, byte_bpe, context_mixing, hamming, huffman, latent, mixing, pairwise, periodic_runs, pii, revisits,
                          spelling_variants, url_words)
from deckmill.llm.common import WORD, table

CATALOG = Catalog()
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


@CATALOG.add("op1_crf_personal_data")
def op1_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every whole text: base patterns, and what a field over word shapes adds."""
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS hash
  FROM documents),
sources AS (
  SELECT source, sum(size) AS source_size, 3.0 * sum(size) AS c,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(c) OVER (ORDER BY c / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY c / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
targets AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         coalesce(least(c, w * (SELECT arg_min(level, c / w) FROM levels WHERE level * w <= c)), 0) AS target
  FROM levels),
rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
groups AS (
  SELECT s.source, s.hash, sum(s.size) AS words FROM sized s GROUP BY s.source, s.hash),
running AS (
  SELECT g.*, sum(words) OVER (PARTITION BY source ORDER BY hash) AS upto FROM groups g),
extra AS (
  SELECT r.source, r.hash, CASE
           WHEN upto <= target - whole * source_size THEN 1
           WHEN upto - words > target - whole * source_size THEN 0
           WHEN words = 0 THEN 0
           WHEN upto - (target - whole * source_size) < (target - whole * source_size) - (upto - words) THEN 1 ELSE 0 END AS more
  FROM running r JOIN rests t ON r.source IS NOT DISTINCT FROM t.source)
SELECT s.doc_id, s.size, t.source_size, CAST(t.target AS DOUBLE) AS target,
       CAST((t.whole + e.more) * s.size AS BIGINT) AS taken, CAST(t.whole + e.more AS BIGINT) AS copies
FROM sized s JOIN rests t ON s.source IS NOT DISTINCT FROM t.source
JOIN extra e ON s.source IS NOT DISTINCT FROM e.source AND s.hash = e.hash
"""


def crc_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string"))


@CATALOG.add("op2_mix_sources", MIX_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed by weights 5, 2, 1 in turn, none above three times its size."""
    return mixing.mix(table(spark, sf_dir, "documents"), (5, 2, 1), 3.0)


def fetch_records(pages: DataFrame) -> DataFrame:
    """Crawl records of the pages: a full response at the time of the page's number, except for every thirteenth page, and
    up to a thousand ticks later a not-modified revisit of the same URL, some with another tag or none."""
    n, tag = F.col("page_id"), F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    modified = F.concat(F.lit("t"), (n % 97).cast("string"))
    later = n + n % 1000 + 1
    response = pages.where(n % 13 != 0).select(
        (2 * n).alias("record_id"), "url", n.alias("fetched_at"), F.lit("response").alias("kind"), tag.alias("etag"), modified.alias("last_modified"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.coalesce(F.length("html"), F.lit(0)).cast("string"),
                     F.lit("etag"), tag, F.lit("cache-control"), F.lit("max-age=60")).alias("headers"))
    own = F.when(n % 11 == 0, F.lit('"other"')).when(n % 7 == 0, F.lit(None)).when(n % 5 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag)
    revisit = pages.select(
        (2 * n + 1).alias("record_id"), "url", later.alias("fetched_at"), F.lit("revisit").alias("kind"), own.alias("etag"),
        F.when(n % 17 == 0, F.lit("other")).when(n % 3 == 0, F.lit(None)).otherwise(modified).alias("last_modified"),
        F.create_map(F.lit("content-length"), F.lit("0"), F.lit("date"), later.cast("string"),
                     F.lit("cache-control"), F.concat(F.lit("max-age="), (n % 600).cast("string"))).alias("headers"))
    return response.unionAll(revisit)


REVISIT_SQL = r"""
WITH base AS (
  SELECT page_id AS n, url, html, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag, 't' || CAST(page_id % 97 AS VARCHAR) AS modified,
         regexp_replace(regexp_replace(url, '#.*', '', 's'), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
  FROM pages),
keyed AS (
  SELECT *, regexp_replace(lower(regexp_extract(rest, '^[^/?]*', 0)), ':(80|443)$', '') AS host,
         regexp_replace(regexp_replace(regexp_extract(rest, '^[^/?]*(.*)$', 1, 's'), '([?&])(utm_[^&]*(&|$))+', '\1', 'g'), '[?&]+$', '') AS tail
  FROM base),
urls AS (SELECT *, host || CASE WHEN tail = '' THEN '/' ELSE tail END AS url_key FROM keyed),
records AS (
  SELECT 2 * n AS record_id, url_key, n AS fetched_at, tag AS etag, modified AS last_modified, n AS response_page,
         coalesce(length(html), 0) AS size, n FROM urls WHERE n % 13 <> 0
  UNION ALL
  SELECT 2 * n + 1, url_key, n + n % 1000 + 1,
         CASE WHEN n % 11 = 0 THEN '"other"' WHEN n % 7 = 0 THEN NULL WHEN n % 5 = 0 THEN 'W/' || tag ELSE tag END,
         CASE WHEN n % 17 = 0 THEN 'other' WHEN n % 3 = 0 THEN NULL ELSE modified END, NULL, NULL, n FROM urls),
found AS (
  SELECT *, last_value(CASE WHEN response_page IS NOT NULL THEN record_id END IGNORE NULLS) OVER (
    PARTITION BY url_key ORDER BY fetched_at, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM records),
checked AS (
  SELECT r.n, r.url_key, r.fetched_at, r.etag, o.response_page, o.etag AS old_tag, o.size,
         CASE WHEN r.etag IS NOT NULL THEN regexp_replace(r.etag, '^W/', '') = o.etag
              WHEN r.last_modified IS NOT NULL THEN r.last_modified = o.last_modified END AS agrees
  FROM found r LEFT JOIN records o ON o.record_id = r.before AND r.url_key IS NOT NULL
  WHERE r.response_page IS NULL)
SELECT n AS page_id, url_key, coalesce(response_page, -1) AS response_page,
       CASE WHEN response_page IS NULL THEN 'no_response' WHEN agrees IS NULL THEN 'unverified' WHEN agrees THEN 'resolved' ELSE 'mismatch' END AS status,
       CASE WHEN response_page IS NOT NULL AND agrees THEN
         'cache-control=max-age=' || CAST(n % 600 AS VARCHAR) || ';content-length=' || CAST(size AS VARCHAR) || ';content-type=text/html;date='
         || CAST(fetched_at AS VARCHAR) || ';etag=' || old_tag END AS headers
FROM checked
"""


@CATALOG.add("op3_revisit_resolution", REVISIT_SQL)
def op3_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revisit of every page with the page whose response it stands for (-1: none), its status and the merged headers."""
    found = revisits.resolve(fetch_records(table(spark, sf_dir, "pages")))
    pair = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select(((F.col("record_id") - 1) / 2).cast("long").alias("page_id"), "url_key", F.coalesce((F.col("response_id") / 2).cast("long"), F.lit(-1)).alias("response_page"),
                        "status", F.when(F.col("headers").isNotNull(), F.array_join(pair, ";")).alias("headers"))


@CATALOG.add("op4_latent_decontamination")
def op4_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, copied or reworded, with the closest item and how close it is."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", latent.leaks(docs, table(spark, sf_dir, "benchmark")).alias("found")).where(F.size("found") > 0)
    best = F.element_at("found", 1)
    return found.select("doc_id", best["item_id"].alias("item_id"), best["cosine"].alias("cosine"), best["lcs"].alias("lcs"),
                        best["lcs_share"].alias("lcs_share"), best["answer_share"].alias("answer_share"),
                        F.transform("found", lambda m: m["item_id"]).alias("item_ids"), F.lit(True).alias("contaminated"))


@CATALOG.add("op5_bloom_lookup_fingerprints")
def op5_bloom_lookup_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text and its edited form as subtractable sketches, and how much they share."""
    return bloom_lookup.fingerprints(table(spark, sf_dir, "documents"))


@CATALOG.add("op6_hamming_near_duplicates")
def op6_hamming_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a five-word shingle similarity of 0.75, with the least id of each group kept."""
    return hamming.near_duplicates(table(spark, sf_dir, "documents"), percent=75)


@CATALOG.add("op7_context_mixing_scores")
def op7_context_mixing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by a model of six sevenths of the ids, beside add-one unigrams."""
    return context_mixing.score(table(spark, sf_dir, "documents"), crc_of_id() % 7 == 2)


@CATALOG.add("op8_host_words")
def op8_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, or else by naive Bayes over the words of host and path."""
    pages = table(spark, sf_dir, "pages")
    return url_words.judge(pages, url_words.fit(pages), url_words.RULES)


@CATALOG.add("op9_pairwise_quality")
def op9_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text, ranked by preference pairs of labels of four fifths of the ids."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(crc_of_id() % 5 != 0)
    ranking = pairwise.train(docs, labels, most_labelled=20_000, threshold=0.3)
    scored = docs.select("doc_id", (crc_of_id() % 5 == 0).alias("held_out"), pairwise.score(F.col("text"), ranking).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@CATALOG.add("op10_huffman_ids")
def op10_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as ids in an id file, read back: doc_id, start, n_tokens, ids_crc32."""
    return huffman.token_table(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), end_id=1)


@CATALOG.add("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of six letters and five occurrences, some misprinted by hash, each with its near words, form and root."""
    counts = spelling_variants.count_words(table(spark, sf_dir, "documents"), shortest=6, least=5, misprint_every=199)
    return spelling_variants.variants(counts, ratio=5)


@CATALOG.add("op12_byte_transducer")
def op12_byte_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as byte-level ids, and digests of the ids and of what they decode to."""
    rows = byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    return rows.select(
        "doc_id", F.expr("length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """Every tenth text by the hash of its id repeats from some word on, by a period of a third of the rest or less. Other
    texts stay as they are."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    sized = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.coalesce(F.size("words"), F.lit(0)))
    placed = sized.withColumn("a", F.when(F.col("n") > 0, g % F.col("n")).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / F.col("p")).cast("int"))), 1, rest)
    text = F.array_join(F.concat(F.slice("words", 1, F.col("a")), repeated), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


@CATALOG.add("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of every whole text, the strongest one, and digests of all runs and of the collapsed text."""
    found = periodic_runs.find_runs(with_repeats(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    best = periodic_runs.strongest(F.col("runs"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "runs", "collapsed", best.alias("best")).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
