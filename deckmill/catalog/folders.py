"""Registered queries on folders of files, long lists, and groups of a fixed size.

Files are made by Spark from the given tables, one per row, through the library's own file writer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from deckmill.catalog.common import AUTHORITY, FILES, Catalog, heavy_files, table
from deckmill.functions import terms, urls
from deckmill.operators import scale, suffixes
from deckmill.session import scratch_path
from deckmill.sinks import files as file_sinks
from deckmill.sinks import tables as sinks
from deckmill.sources import decks
from deckmill.sources import tables as src
from deckmill.streaming import groups, watch

CATALOG = Catalog()
SUFFIX_RULES = ["com", "org  // a comment", "// a comment", "", "NET", "example.com", "*.example.net", "!tiontion.example.net", "*.org", "!example.org"]


def deck_folder(spark, d, condition="true"):
    """Every document as a file of its text in the folder of its source."""
    path = scratch_path(spark, "deck-folder")
    add_decks(spark, d, path, condition)
    return path


def add_decks(spark, d, path, condition):
    file_sinks.write_files(heavy_files(spark, d).where(condition), path, F.concat_ws("/", "source", "name"), F.encode(F.coalesce("text", F.lit("")), "UTF-8"))


@CATALOG.add("deck_folder_listing", f"""WITH {FILES}
SELECT name, source AS folder, extension, strlen(coalesce(text, '')) AS file_size FROM files""")
def deck_folder_listing(spark, d):
    found = decks.listing(spark, [deck_folder(spark, d)], recursive=True)
    return found.select("name", "folder", "extension", "file_size")


@CATALOG.add("deck_folder_contents", f"""WITH {FILES}
SELECT name, extension, sha256(coalesce(text, '')) AS file_hash FROM files""")
def deck_folder_contents(spark, d):
    found = decks.scan(spark, [deck_folder(spark, d)], recursive=True)
    return found.select("name", "extension", F.sha2("content", 256).alias("file_hash"))


@CATALOG.add("sidecar_files", f"""WITH {FILES}
SELECT name || '.meta.json' AS sidecar, name AS original_filename, source_url, lang AS language, file_size FROM files""")
def sidecar_files(spark, d):
    """One sidecar file per deck, read back by the sidecar scan."""
    path = scratch_path(spark, "sidecar-files")
    card = F.to_json(F.struct(F.col("name").alias("original_filename"), "source_url", F.col("lang").alias("language"), "file_size"))
    file_sinks.write_sidecar_files(heavy_files(spark, d), path, card, F.col("name"))
    cards = src.sidecars(spark, path)
    return cards.select(F.substring_index("sidecar_path", "/", -1).alias("sidecar"), "original_filename", "source_url", "language", "file_size")


@CATALOG.add("policy_file_lists", r"""
SELECT DISTINCT CASE WHEN page_id % 2 = 0 THEN 'pirate' ELSE 'corporate' END AS rule, regexp_extract(lower(split_part(url, '/', 3)), '[^.]*\.[^.]*$') AS value FROM pages
WHERE page_id % 3 <> 0""")
def policy_file_lists(spark, d):
    """Lists of one policy file; a key that no rule names and a missing one give no rows."""
    path = scratch_path(spark, "policy")
    host = F.upper(F.substring_index(F.split_part("url", F.lit("/"), F.lit(3)), ".", -2))
    i = F.col("page_id")
    listed = table(spark, d, "pages").groupBy().agg(
        F.collect_set(F.when((i % 2 == 0) & (i % 3 != 0), host)).alias("pirate_domains"),
        F.collect_set(F.when((i % 2 == 1) & (i % 3 != 0), host)).alias("corporate_domains"), F.collect_set(F.when(i % 3 == 0, host)).alias("other"))
    file_sinks.write_files(listed, path, F.lit("policy.json"), F.encode(F.to_json(F.struct("pirate_domains", "corporate_domains", "other")), "UTF-8"))
    return src.policy_lists(spark, f"{path}/policy.json", {"pirate_domains": "pirate", "corporate_domains": "corporate", "missing": "research"})


@CATALOG.add("stream_watch_decks", f"""WITH {FILES}
SELECT name, extension, strlen(coalesce(text, '')) AS file_size, CAST(1 AS BIGINT) AS times_seen FROM files""")
def stream_watch_decks(spark, d):
    """Decks arrive in two waves; a third run finds nothing new."""
    folder, out = scratch_path(spark, "watched"), scratch_path(spark, "stream-decks")
    for wave in range(3):
        add_decks(spark, d, folder, F.col("doc_id") % 2 == wave)
        arrived = watch.watch_decks(spark, folder, state=f"{out}/arrivals", content=False).select("name", "extension", "file_size")
        watch.start(arrived, lambda rows, epoch: sinks.append_parquet(rows, f"{out}/seen", watch._part(rows.sparkSession, epoch)), f"{out}/checkpoint").awaitTermination()
    seen = spark.read.schema("name string, extension string, file_size bigint").option("basePath", f"{out}/seen").parquet(f"{out}/seen")
    return seen.groupBy("name", "extension", "file_size").agg(F.count("*").alias("times_seen"))


@CATALOG.add("stream_publish_groups", """
SELECT doc_id, source, (row_number() OVER (ORDER BY doc_id % 3, doc_id) - 1) // 200 + 1 AS group_no FROM documents""")
def stream_publish_groups(spark, d):
    """Metadata is published per 200 rows, whatever the waves bring; the end of the harvest publishes the rest."""
    out, schema = scratch_path(spark, "stream-groups"), "doc_id bigint, source string"
    docs = table(spark, d, "documents").select("doc_id", "source")
    for wave in range(3):
        docs.where(F.col("doc_id") % 3 == wave).write.mode("append").parquet(f"{out}/arriving")
        arriving = watch.watch_table(spark, f"{out}/arriving", schema)
        watch.start(arriving, groups.group_batch(out, 200, ["doc_id"], schema), f"{out}/checkpoint").awaitTermination()
    groups.flush(spark, out, 200, ["doc_id"], schema)
    return groups.published(spark, out, schema).select("doc_id", "source", "group_no")


_SUFFIX_SQL = rf"""WITH h AS (SELECT page_id, split_part({AUTHORITY}, ':', 1) AS h FROM pages), l AS (SELECT *, string_split(h, '.') AS l FROM h),
t AS (SELECT *, len(l) AS n, l[-1] AS a, array_to_string(l[-2:], '.') AS b, array_to_string(l[-3:], '.') AS c FROM l),
k AS (SELECT *, CASE WHEN h = '' THEN 0 WHEN c = 'tiontion.example.net' THEN 2 WHEN b = 'example.org' THEN 1
  WHEN b = 'example.net' AND n > 2 THEN 3 WHEN b = 'example.com' OR a = 'org' AND n > 1 THEN 2 ELSE 1 END AS k FROM t)
SELECT page_id, array_to_string(l[n - k + 1:], '.') AS public_suffix, CASE WHEN n > k THEN array_to_string(l[n - k:], '.') END AS registered_domain FROM k"""


@CATALOG.add("public_suffix_rules", _SUFFIX_SQL)
def public_suffix_rules(spark, d):
    host = F.split_part(urls.authority(F.col("url")), F.lit(":"), F.lit(1))
    hosts = table(spark, d, "pages").select("page_id", host.alias("host"))
    suffix, domain = suffixes.suffix_and_domain(F.col("host"), suffixes.suffix_labels(F.col("host"), suffixes.SuffixRules.of(SUFFIX_RULES)))
    return hosts.select("page_id", suffix.alias("public_suffix"), domain.alias("registered_domain"))


@CATALOG.add("public_suffix_rules_joined", _SUFFIX_SQL)
def public_suffix_rules_joined(spark, d):
    """The same by a table of rules, as for lists of any length."""
    host = F.split_part(urls.authority(F.col("url")), F.lit(":"), F.lit(1))
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")
    found = suffixes.with_suffix(table(spark, d, "pages").select("page_id", host.alias("host")), "host", rules, ["page_id"])
    return found.select("page_id", "public_suffix", "registered_domain")


@CATALOG.add("long_term_list", """
WITH terms AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS term FROM benchmark)
SELECT doc_id, count(term) AS n_hits, coalesce(string_agg(term, ',' ORDER BY term), '') AS hits
FROM documents LEFT JOIN terms ON contains(lower(documents.text), term) GROUP BY doc_id""")
def long_term_list(spark, d):
    """Every document against a list of all long words of the benchmark, in one pass."""
    words = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), 0)).alias("term")).distinct()
    listed = scale.small_table(words, 200_000)
    if listed is None:
        raise ValueError("a term list is a parameter: at most 200,000 terms")
    lowered = table(spark, d, "documents").select("doc_id", F.lower("text").alias("low"))
    hits = lowered.select("doc_id", terms.term_hits(F.col("low"), [r.term for r in listed]).alias("hits"))
    return hits.select("doc_id", F.coalesce(F.size("hits"), F.lit(0)).cast("bigint").alias("n_hits"), F.coalesce(F.array_join("hits", ","), F.lit("")).alias("hits"))
