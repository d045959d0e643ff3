"""Registered queries on duplicates, numbering, quotas, ledgers and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from deckmill.catalog.common import FILES, Catalog, files, heavy_files, table
from deckmill.config import DeliveryRules
from deckmill.functions import names
from deckmill.operators import batches, dedup, integrity, ledger, numbering, scale, stats

CATALOG = Catalog()


def benchmark_hashes(spark, d):
    return table(spark, d, "benchmark").select(F.sha2("text", 256).alias("file_hash"))


@CATALOG.add("size_groups", f"""WITH {FILES}, g AS (SELECT file_size, count(*) AS n FROM files GROUP BY 1)
SELECT count(*) AS size_groups, count(CASE WHEN n = 1 THEN 1 END) AS unique_size_files, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS sharing_size_files FROM g""")
def size_groups(spark, d):
    return dedup.size_group_counts(files(spark, d))


_W3 = """w3 AS (SELECT *, row_number() OVER (PARTITION BY file_size, sha256(text) ORDER BY mtime, path) > 1 AS is_binary_copy,
   first_value(path) OVER (PARTITION BY file_size, sha256(text) ORDER BY mtime, path) AS first_path FROM files)"""


@CATALOG.add("exact_copies", f"""WITH {FILES}, {_W3}
SELECT doc_id, is_binary_copy, CASE WHEN count(*) OVER (PARTITION BY file_size, sha256(text)) > 1 THEN first_path END AS binary_keeper,
       count(*) OVER (PARTITION BY file_size) AS size_peers FROM w3""")
def exact_copies(spark, d):
    out = dedup.exact_copies(files(spark, d), F.sha2("text", 256), payload=["text"])
    return out.select("doc_id", "is_binary_copy", "binary_keeper", "size_peers")


@CATALOG.add("exact_copies_hot_keys", f"""WITH {FILES}, {_W3} SELECT doc_id, is_binary_copy FROM w3""")
def exact_copies_hot_keys(spark, d):
    f = files(spark, d).withColumn("h", F.sha2("text", 256))
    facts = f.groupBy("file_size", "h").agg(F.min(F.struct("mtime", "path")).alias("first"), F.count("*").alias("n"))
    marked = scale.attach(f, facts, ["file_size", "h"], "n", ["path"], hot_rows=1)
    return marked.select("doc_id", (F.struct("mtime", "path") > F.col("first")).alias("is_binary_copy"))


_NORM = "regexp_replace(text, ' (the|of|der|que)', '', 'g')"
_W5 = f"""w5 AS (SELECT *, NOT is_binary_copy AND extension = '.pptx' AND row_number() OVER (PARTITION BY is_binary_copy, extension, {_NORM} ORDER BY mtime, path) > 1
   AS is_content_copy FROM w3)"""


def content_marked(spark, d):
    digest = F.sha2(F.regexp_replace("text", " (the|of|der|que)", ""), 256)
    f = files(spark, d).withColumn("content_hash", digest)
    return dedup.content_copies(dedup.exact_copies(f, F.sha2("text", 256), payload=["text"]))


@CATALOG.add("content_copies", f"""WITH {FILES}, {_W3}, {_W5} SELECT doc_id, is_binary_copy, is_content_copy FROM w5""")
def content_copies(spark, d):
    return content_marked(spark, d).select("doc_id", "is_binary_copy", "is_content_copy")


@CATALOG.add("dedup_summary", f"""WITH {FILES}, {_W3}, {_W5}
SELECT count(*) AS scanned, count(CASE WHEN is_binary_copy THEN 1 END) AS binary_duplicates, count(CASE WHEN is_content_copy THEN 1 END) AS content_duplicates,
  count(CASE WHEN is_binary_copy OR is_content_copy THEN 1 END) AS moved, count(CASE WHEN NOT (is_binary_copy OR is_content_copy) THEN 1 END) AS kept,
  round(coalesce(CAST(sum(CASE WHEN is_binary_copy OR is_content_copy THEN file_size END) AS BIGINT), 0) / 1048576.0::DOUBLE, 4) AS saved_mb FROM w5""")
def dedup_summary(spark, d):
    return dedup.dedup_summary(content_marked(spark, d))


@CATALOG.add("normalised_markup_digest", r"""
SELECT page_id, sha256(regexp_replace(h, ' (id|val|time)="[^"]*"', '', 'g')) AS content_hash
FROM (SELECT page_id, replace(html, '<a href', '<a id="' || page_id || '" val="x" href') AS h FROM pages) t""")
def normalised_markup_digest(spark, d):
    marked = F.replace(F.col("html"), F.lit("<a href"), F.concat(F.lit('<a id="'), F.col("page_id").cast("string"), F.lit('" val="x" href')))
    members = table(spark, d, "pages").select("page_id", F.explode(F.array(
        F.struct(F.lit("ppt/slides/slide1.xml").alias("member"), marked.alias("xml")),
        F.struct(F.lit("docProps/core.xml").alias("member"), F.col("url").alias("xml")))).alias("m")).select("page_id", "m.member", "m.xml")
    return dedup.content_hash(members, "page_id")


@CATALOG.add("folder_copies", f"""WITH {FILES}, m AS (SELECT *, md5(text) AS h, CAST(substr(source, 4) AS INTEGER) AS folder_rank FROM files)
SELECT doc_id, row_number() OVER (PARTITION BY h ORDER BY folder_rank, path) > 1 AS is_copy FROM m""")
def folder_copies(spark, d):
    f = files(spark, d).withColumn("md5", F.md5("text")).withColumn("folder_rank", F.substring("source", 4, 9).cast("int"))
    return dedup.folder_copies(f).select("doc_id", "is_copy")


@CATALOG.add("duplicate_group_log", f"""WITH {FILES}, m AS (SELECT *, md5(text) AS h, CAST(substr(source, 4) AS INTEGER) AS folder_rank FROM files),
k AS (SELECT h AS md5, path AS moved_from, first_value(path) OVER w AS original_kept, row_number() OVER w AS r FROM m WINDOW w AS (PARTITION BY h ORDER BY folder_rank, path))
SELECT md5, original_kept, moved_from FROM k WHERE r > 1""")
def duplicate_group_log(spark, d):
    f = files(spark, d).withColumn("md5", F.md5("text")).withColumn("folder_rank", F.substring("source", 4, 9).cast("int"))
    return dedup.duplicate_log(f)


@CATALOG.add("duplicate_groups", f"""WITH {FILES}
SELECT md5(text) AS h, count(*) AS members, min(path) AS kept, count(*) - 1 AS moved FROM files GROUP BY 1 HAVING count(*) > 1""")
def duplicate_groups(spark, d):
    return dedup.duplicate_groups(files(spark, d).withColumn("h", F.md5("text")), "h", ["path"])


@CATALOG.add("duplicate_totals", f"""WITH {FILES}, g AS (SELECT count(*) AS n FROM files GROUP BY md5(text) HAVING count(*) > 1)
SELECT count(*) AS duplicate_groups, coalesce(CAST(sum(n - 1) AS BIGINT), 0) AS duplicate_files FROM g""")
def duplicate_totals(spark, d):
    return dedup.group_totals(files(spark, d).withColumn("h", F.md5("text")), "h")


@CATALOG.add("collision_names", f"""WITH {FILES}, t AS (SELECT doc_id, n_chars || '.pptx' AS name, mtime FROM files),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY mtime, doc_id) - 1 AS n FROM t)
SELECT doc_id, CASE WHEN n = 0 THEN name ELSE replace(name, '.pptx', '_' || n || '.pptx') END AS dest_name FROM r""")
def collision_names(spark, d):
    f = files(spark, d).select("doc_id", F.concat(F.col("n_chars").cast("string"), F.lit(".pptx")).alias("name"), "mtime")
    return dedup.resolve_collisions(f, "name", ["mtime", "doc_id"]).select("doc_id", "dest_name")


@CATALOG.add("joint_url_and_name", f"""WITH {FILES}, c AS (SELECT doc_id, 'https://h/' || (doc_id % 700) AS url, 'F' || (doc_id % 450) AS filename FROM files),
u AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1)
SELECT doc_id FROM u QUALIFY row_number() OVER (PARTITION BY lower(filename) ORDER BY doc_id) = 1""")
def joint_url_and_name(spark, d):
    i = F.col("doc_id")
    c = files(spark, d).select("doc_id", F.concat(F.lit("https://h/"), (i % 700).cast("string")).alias("url"),
                               F.concat(F.lit("F"), (i % 450).cast("string")).alias("filename"))
    return dedup.joint_url_name(c, ["doc_id"]).select("doc_id")


@CATALOG.add("once_per_entity", "SELECT DISTINCT user_id, event_type FROM events")
def once_per_entity(spark, d):
    from deckmill.operators import records

    return records.once_per_entity(table(spark, d, "events").select("user_id", "event_type"), ["user_id", "event_type"])


_CLEAN = f"""WITH {FILES}, e AS (SELECT *, sha256(text) AS h, CASE WHEN file_size < 400 THEN 'Below size threshold (' || file_size || ' bytes)'
    WHEN contains(text, 'worthless') THEN 'Invalid ZIP structure (corrupted .pptx)' END AS early FROM files),
cl AS (SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN row_number() OVER w > 1 THEN 'Duplicate of ' || first_value(name) OVER w END AS quarantine_reason
  FROM e WINDOW w AS (PARTITION BY early IS NULL, h ORDER BY name))"""


def cleaned(spark, d):
    f = files(spark, d).withColumns({"file_hash": F.sha2("text", 256), "corruption_reason": F.when(
        F.contains("text", F.lit("worthless")), "Invalid ZIP structure (corrupted .pptx)").otherwise("")})
    return integrity.clean_chain(f, floor=400)


@CATALOG.add("clean_chain", f"{_CLEAN} SELECT doc_id, quarantine_reason FROM cl")
def clean_chain(spark, d):
    return cleaned(spark, d).select("doc_id", "quarantine_reason")


@CATALOG.add("quarantine_kinds", f"""{_CLEAN}
SELECT CASE WHEN quarantine_reason LIKE 'Below%' THEN 'below_size_threshold' WHEN quarantine_reason LIKE 'Dup%' THEN 'duplicate_of'
  ELSE 'invalid_zip_structure' END AS reason_kind, count(*) AS n FROM cl WHERE quarantine_reason IS NOT NULL GROUP BY 1""")
def quarantine_kinds(spark, d):
    from deckmill.session import scratch_path
    from deckmill.sinks import tables as sinks

    path = scratch_path(spark, "quarantine")
    flagged = cleaned(spark, d).select("doc_id", "name", F.col("quarantine_reason").alias("reason"))
    sinks.quarantine(flagged, path, dry_run=False)
    return spark.read.parquet(path).groupBy("reason_kind").agg(F.count("*").alias("n"))


_FUNNEL = f"""WITH {FILES}, s AS (SELECT *, string_split(text, chr(10)) AS l, lower(text) AS t FROM files),
fun AS (SELECT doc_id, CASE WHEN file_size < 500 THEN 'too_small' WHEN doc_id % 31 = 0 THEN 'invalid' WHEN contains(name, '77') THEN 'china_filename'
    WHEN contains(name, '55') THEN 'usa_filename' WHEN sha256(text) IN (SELECT sha256(text) FROM documents WHERE doc_id % 6 = 0) THEN 'duplicate'
    WHEN len(regexp_extract_all(l[1], '[éèê]')) > 50 THEN 'china_content'
    WHEN CAST(contains(t, 'tion') AS INTEGER) + CAST(contains(t, 'whst') AS INTEGER) + CAST(contains(t, 'eaea') AS INTEGER) >= 3 THEN 'usa_content' END AS reason FROM s)"""


def funnel(spark, d):
    f = heavy_files(spark, d).withColumns({"magic_ok": F.col("doc_id") % 31 != 0, "tag": F.sha2("text", 256), "slides": F.split("text", "\n")})
    seen = table(spark, d, "documents").where(F.col("doc_id") % 6 == 0).select(F.sha2("text", 256).alias("tag"))
    return integrity.template_funnel(f, seen, floor=500, china_names=["77"], usa_names=["55"], cjk_pattern="[éèê]", terms=["tion", "whst", "eaea"])


@CATALOG.add("template_funnel", f"{_FUNNEL} SELECT doc_id, reason FROM fun")
def template_funnel(spark, d):
    return funnel(spark, d).select("doc_id", "reason")


@CATALOG.add("funnel_counts", f"{_FUNNEL} SELECT coalesce(r, 'total') AS reason, count(*) AS n FROM (SELECT coalesce(reason, 'kept') AS r FROM fun) x GROUP BY ROLLUP (r)")
def funnel_counts(spark, d):
    return stats.funnel_counts(funnel(spark, d))


@CATALOG.add("notebook_funnel", f"""WITH {FILES}, s AS (SELECT *, substr(sha1(text), 1, 12) AS tag FROM files),
e AS (SELECT *, CASE WHEN file_size < 500 THEN 'too_small' WHEN doc_id % 31 = 0 THEN 'invalid' WHEN contains(name, '77') THEN 'china_filename'
  WHEN contains(name, '55') THEN 'usa_filename' END AS early FROM s)
SELECT doc_id, CASE WHEN early IS NOT NULL THEN early WHEN row_number() OVER (PARTITION BY early IS NULL, tag ORDER BY path) > 1 THEN 'duplicate'
  WHEN len(regexp_extract_all(string_split(text, chr(10))[1], '[éèê]')) > 50 THEN 'china_content' END AS reason FROM e""")
def notebook_funnel(spark, d):
    f = heavy_files(spark, d).withColumns({"magic_ok": F.col("doc_id") % 31 != 0, "slides": F.split("text", "\n"),
                                     "tag": names.content_tag(F.encode("text", "UTF-8"))})
    return integrity.content_funnel(f, floor=500, china_names=["77"], usa_names=["55"], cjk_pattern="[éèê]").select("doc_id", "reason")


_ORG = """t AS (SELECT doc_id, file_size, CASE WHEN doc_id % 13 = 0 THEN 'bad header' ELSE '' END AS error, len(string_split(text, chr(10))) AS slides,
   CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END AS organization, 'Author ' || lang AS author FROM files)"""


@CATALOG.add("transfer_rule", f"""WITH {FILES}, {_ORG}
SELECT doc_id, CASE WHEN error <> '' AND file_size < 2000 THEN 'corrupt file — ' || error WHEN error = '' AND slides < 5 THEN 'only ' || slides || ' slides (min 5)'
  WHEN contains(lower(CASE WHEN organization <> '' THEN organization ELSE author END), 'src7') OR contains(lower(CASE WHEN organization <> '' THEN organization ELSE author END), 'author fr')
  THEN 'blocked organisation: ' || lower(CASE WHEN organization <> '' THEN organization ELSE author END) ELSE 'PASS' END AS reason,
  CASE WHEN error <> '' AND file_size >= 2000 THEN 'UNKNOWN' ELSE 'LOW' END AS quality FROM t""")
def transfer_rule(spark, d):
    f = files(spark, d).withColumns({
        "parse_error": F.when(F.col("doc_id") % 13 == 0, "bad header").otherwise(""), "slide_count": F.size(F.split("text", "\n")), "quality": F.lit("LOW"),
        "organization": F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise(""), "author": F.concat(F.lit("Author "), F.col("lang"))})
    rules = DeliveryRules(unparsed_accept_bytes=2000)
    f = integrity.accept_unparsed(f, rules)
    return f.select("doc_id", integrity.transfer_reason(F.col("parse_error"), F.col("slide_count"), F.col("organization"), F.col("author"),
                                                        ["src7", "author fr"], rules).alias("reason"), "quality")


# ---- ledgers -----------------------------------------------------------------
@CATALOG.add("content_ledger_check", """
SELECT doc_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM benchmark)
  AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 5 = 0)""")
def content_ledger_check(spark, d):
    f = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("file_hash"))
    known = benchmark_hashes(spark, d).union(f.where(F.col("doc_id") % 5 == 0).select("file_hash"))
    return ledger.drop_seen(f, known, ["file_hash"], ["doc_id"]).select("doc_id")


@CATALOG.add("ledger_new_entries", """
SELECT DISTINCT sha256(text) AS file_hash FROM documents
EXCEPT SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0""")
def ledger_new_entries(spark, d):
    f = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("file_hash"))
    return ledger.new_entries(f, f.where(F.col("doc_id") % 2 == 0), "file_hash")


@CATALOG.add("ledger_with_disk_tags", """
SELECT DISTINCT substr(sha1(url), 1, 10) AS tag FROM pages WHERE page_id % 3 = 0
UNION SELECT substr(sha1(url), 1, 10) FROM pages WHERE page_id % 4 = 0""")
def ledger_with_disk_tags(spark, d):
    from deckmill.functions import urls

    p = table(spark, d, "pages").withColumn("tag", urls.url_tag(F.col("url")))
    disk = p.where(F.col("page_id") % 4 == 0).select(F.explode(F.array(
        F.concat("tag", F.lit("_a.pptx")), F.lit("short_b.pptx"))).alias("name"))
    return ledger.with_disk_tags(p.where(F.col("page_id") % 3 == 0), disk)


@CATALOG.add("empty_file_requeue", f"""WITH {FILES}, tags AS (SELECT doc_id, lpad(CAST(doc_id AS VARCHAR), 7, '0') || '.pptx' AS new_name, substr(sha1(text), 1, 10) AS tag,
   CASE WHEN doc_id % 8 = 0 THEN 0 ELSE file_size END AS size FROM files)
SELECT tag, count(*) AS n FROM tags WHERE tag NOT IN (SELECT tag FROM tags WHERE size = 0 AND doc_id % 16 <> 0) GROUP BY tag""")
def empty_file_requeue(spark, d):
    from deckmill.plans import curate

    new = F.concat(names.zero_padded(F.col("doc_id"), 7), F.lit(".pptx"))
    f = files(spark, d).select("doc_id", new.alias("name"), F.when(F.col("doc_id") % 8 == 0, 0).otherwise(F.col("file_size")).alias("file_size"),
                               F.substring(F.sha1(F.encode("text", "UTF-8")), 1, 10).alias("tag"))
    old = F.when(F.col("doc_id") % 16 == 0, F.lit("untagged_file.pptx")).otherwise(F.concat("tag", F.lit("_x.pptx")))
    mapping = f.select(F.col("doc_id").alias("line_no"), F.col("name").alias("new_name"), old.alias("old_name"))
    return curate.repair(f, mapping, f.select("tag"))["ledger"].groupBy("tag").agg(F.count("*").alias("n"))


@CATALOG.add("empty_file_renumber", f"""WITH {FILES}
SELECT name, lpad(CAST(35914 + row_number() OVER (ORDER BY name) AS VARCHAR), 7, '0') || extension AS new_name FROM files WHERE doc_id % 8 <> 0""")
def empty_file_renumber(spark, d):
    from deckmill.plans import curate

    f = files(spark, d).select("doc_id", "name", F.when(F.col("doc_id") % 8 == 0, 0).otherwise(F.col("file_size")).alias("file_size"))
    mapping = f.select(F.col("doc_id").alias("line_no"), F.col("name").alias("new_name"), F.col("name").alias("old_name"))
    return curate.repair(f, mapping, f.select(F.lit("x").alias("tag")))["renamed"].select("name", "new_name")


@CATALOG.add("folder_aggregation", f"""WITH {FILES}, n AS (SELECT doc_id, source, md5(text) || '.pptx' AS name FROM files)
SELECT name, source FROM n WHERE source <> 'src0' AND name NOT IN (SELECT name FROM n WHERE source = 'src0')
QUALIFY row_number() OVER (PARTITION BY name ORDER BY source, doc_id) = 1""")
def folder_aggregation(spark, d):
    f = files(spark, d).select("doc_id", "source", F.concat(F.md5("text"), F.lit(".pptx")).alias("name"))
    moved = dedup.aggregate_folders(f.where(F.col("source") != "src0"), f.where(F.col("source") == "src0"), ["source", "doc_id"])
    return moved.select("name", "source")


# ---- numbering and batches ------------------------------------------------------
@CATALOG.add("sequential_renumber", f"""WITH {FILES}, r AS (SELECT *, lpad(CAST(row_number() OVER (ORDER BY name) - 1 AS VARCHAR), 6, '0') || extension AS new_name FROM files)
SELECT doc_id, new_name, new_name <> name AS renamed FROM r""")
def sequential_renumber(spark, d):
    return numbering.renumber(files(spark, d).select("doc_id", "name"), "name", 0, 6).select("doc_id", "new_name", "renamed")


@CATALOG.add("batch_numbering", f"""WITH {FILES}, n AS (SELECT *, CASE WHEN doc_id % 9 = 0 THEN 'BATCH_02_names_' || lpad(CAST(doc_id AS VARCHAR), 6, '0') || '.pptx' ELSE name END AS file_name FROM files),
l AS (SELECT coalesce(max(doc_id), 0) AS last FROM files WHERE doc_id % 9 = 0)
SELECT doc_id, file_name AS dest_name, 0 AS sequence_number FROM n WHERE doc_id % 9 = 0
UNION ALL SELECT doc_id, 'BATCH_02_names_' || lpad(CAST(last + r AS VARCHAR), 6, '0') || extension, last + r
FROM (SELECT *, row_number() OVER (ORDER BY path) AS r FROM n WHERE doc_id % 9 <> 0) x, l""")
def batch_numbering(spark, d):
    own = F.col("doc_id") % 9 == 0
    f = files(spark, d).select("doc_id", "path", F.when(own, F.concat(
        F.lit("BATCH_02_names_"), names.zero_padded(F.col("doc_id"), 6), F.lit(".pptx"))).otherwise(F.col("name")).alias("name"))
    given = f.where(own).select(F.lit("BATCH_02").alias("batch_id"), F.col("doc_id").alias("sequence_number"))
    last = numbering.last_used(given, "BATCH_02")
    return numbering.batch_names(f, "BATCH_02", ["path"], last).select(
        "doc_id", "dest_name", F.coalesce("sequence_number", F.lit(0)).alias("sequence_number"))


@CATALOG.add("next_batch_ids", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS existing, 'BATCH-' || strftime(any_value(ts), '%Y%m%d') || '-' ||
  CASE WHEN count(*) + 1 >= 100 THEN CAST(count(*) + 1 AS VARCHAR) ELSE lpad(CAST(count(*) + 1 AS VARCHAR), 3, '0') END AS next_batch_id
FROM events WHERE event_type = 'signup' GROUP BY 1""")
def next_batch_ids(spark, d):
    e = table(spark, d, "events").where(F.col("event_type") == "signup")
    return numbering.next_batch_ids(e.select(F.to_date("ts").alias("day"))).withColumn("day", F.col("day").cast("string"))


_COMPOSED = f"""WITH {FILES}, c AS (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'REVIEW' ELSE 'DELIVER' END AS delivery_status,
    CASE WHEN file_size % 3 = 0 THEN 'HIGH' WHEN file_size % 3 = 1 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM files),
f AS (SELECT *, row_number() OVER (ORDER BY tier, path) AS seq, row_number() OVER (PARTITION BY tier ORDER BY path) AS within FROM c
      WHERE delivery_status = 'DELIVER' AND tier <> 'LOW'),
h AS (SELECT CAST(floor(count(CASE WHEN tier = 'HIGH' THEN 1 END) / 0.7::DOUBLE * 0.3::DOUBLE) AS BIGINT) AS cap FROM f),
b AS (SELECT f.*, 'BATCH-20260416-' || lpad(CAST((seq - 1) // 50 + 3 AS VARCHAR), 3, '0') AS batch_id, (seq - 1) % 50 + 1 AS place FROM f, h WHERE tier = 'HIGH' OR within <= cap)"""


def packaged(spark, d):
    from deckmill.plans import curate

    size = F.col("file_size") % 3
    f = files(spark, d).withColumns({
        "delivery_status": F.when(F.col("doc_id") % 7 == 0, "REVIEW").otherwise("DELIVER"),
        "quality_classification": F.when(size == 0, "HIGH").when(size == 1, "MEDIUM").otherwise("LOW")})
    return curate.package(f.drop("text"), None, F.lit("2026-04-16").cast("date"), F.lit("2026-04-16T00:00:00Z"), 3, DeliveryRules(batch_size=50))


@CATALOG.add("delivery_batches", f"""{_COMPOSED}
SELECT doc_id, seq, batch_id, batch_id || '_FILE' || lpad(CAST(place AS VARCHAR), 5, '0') || extension AS delivery_name FROM b""")
def delivery_batches(spark, d):
    return packaged(spark, d)[0].select("doc_id", "seq", "batch_id", "delivery_name")


@CATALOG.add("batch_composition", f"""{_COMPOSED}
SELECT batch_id, count(*) AS total_files, count(CASE WHEN tier = 'HIGH' THEN 1 END) AS high_quality, count(CASE WHEN tier = 'MEDIUM' THEN 1 END) AS medium_quality,
  round(100.0::DOUBLE * count(CASE WHEN tier = 'HIGH' THEN 1 END) / count(*), 1) AS high_pct, round(100.0::DOUBLE * count(CASE WHEN tier = 'MEDIUM' THEN 1 END) / count(*), 1) AS medium_pct FROM b GROUP BY 1""")
def batch_composition(spark, d):
    return batches.composition(packaged(spark, d)[0])


@CATALOG.add("batch_manifests", f"""{_COMPOSED}
SELECT batch_id, count(*) AS total_files, round(100.0::DOUBLE * count(CASE WHEN tier = 'HIGH' THEN 1 END) / count(*), 1) AS high_pct, string_agg(name, ',' ORDER BY seq) AS names FROM b GROUP BY 1""")
def batch_manifests(spark, d):
    m = packaged(spark, d)[1]
    return m.select("batch_id", "total_files", "composition.high_pct", F.array_join(F.transform("files", lambda f: f["name"]), ",").alias("names"))


@CATALOG.add("source_quota", f"""WITH {FILES}, n AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY path) AS r FROM files WHERE source IN ('src1', 'src5', 'src9')),
a AS (SELECT count(CASE WHEN source = 'src1' THEN 1 END) AS a1, count(CASE WHEN source = 'src5' THEN 1 END) AS a5 FROM n),
q AS (SELECT least(a1, 13) AS q1, least(a5, 13) AS q5 FROM a)
SELECT doc_id, source, r AS source_seq FROM n, q WHERE r <= CASE source WHEN 'src1' THEN q1 WHEN 'src5' THEN q5 ELSE 40 - q1 - q5 END""")
def source_quota(spark, d):
    f = files(spark, d).select("doc_id", "source", "path")
    return batches.source_quota(f, ["src1", "src5", "src9"], 40, ["path"]).select("doc_id", "source", "source_seq")


# ---- counts ---------------------------------------------------------------------
@CATALOG.add("slide_summary", f"""WITH {FILES}, s AS (SELECT extension, CASE WHEN doc_id % 11 = 0 THEN 0 ELSE len(string_split(text, chr(10))) END AS n FROM files)
SELECT coalesce(extension, 'TOTAL') AS extension, count(*) AS files, CAST(sum(n) AS BIGINT) AS total_slides, count(CASE WHEN n = 0 THEN 1 END) AS zero_or_error FROM s GROUP BY ROLLUP (extension)""")
def slide_summary(spark, d):
    n = F.when(F.col("doc_id") % 11 == 0, 0).otherwise(F.size(F.split("text", "\n")))
    return stats.slide_summary(files(spark, d).withColumn("slide_count", n))


@CATALOG.add("source_histogram", """
SELECT CASE WHEN contains(n, '_ia_') THEN 'Internet Archive' WHEN contains(n, '_cc_') THEN 'Common Crawl' WHEN contains(n, '_hal_') THEN 'HAL' ELSE 'Other' END AS source, count(*) AS n
FROM (SELECT CASE doc_id % 5 WHEN 0 THEN 'x_ia_y' WHEN 1 THEN 'x_cc_y' WHEN 2 THEN 'x_hal_y' ELSE 'x' END AS n FROM documents) t GROUP BY 1""")
def source_histogram(spark, d):
    k = F.col("doc_id") % 5
    n = F.when(k == 0, "x_ia_y").when(k == 1, "x_cc_y").when(k == 2, "x_hal_y").otherwise("x")
    return stats.source_histogram(table(spark, d, "documents").select(n.alias("name")))


@CATALOG.add("country_results", """
SELECT country, CAST(sum(got) AS BIGINT) AS files, upper(country[1]) || lower(country[2:]) AS label FROM (
  SELECT lang AS country, CASE WHEN lang = 'de' THEN 0 ELSE 1 END AS got FROM documents) t GROUP BY country HAVING CAST(sum(got) AS BIGINT) > 0""")
def country_results(spark, d):
    return stats.country_results(table(spark, d, "documents").select(
        F.col("lang").alias("country"), F.when(F.col("lang") == "de", 0).otherwise(1).alias("got")))


@CATALOG.add("stage_dashboard", """
SELECT coalesce(source, 'TOTAL') AS source, count(*) AS downloaded, count(CASE WHEN doc_id % 3 = 0 THEN 1 END) AS staged FROM documents GROUP BY ROLLUP (source)""")
def stage_dashboard(spark, d):
    f = table(spark, d, "documents")
    return stats.stage_dashboard(f, f.where(F.col("doc_id") % 3 == 0))


@CATALOG.add("session_delta", """WITH c AS (SELECT source, count(CASE WHEN doc_id % 2 = 0 THEN 1 END) AS b, count(CASE WHEN doc_id % 3 <> 0 THEN 1 END) AS n FROM documents GROUP BY 1)
SELECT coalesce(source, 'TOTAL') AS source, CAST(sum(greatest(n - b, 0)) AS BIGINT) AS new_files FROM c GROUP BY ROLLUP (source)""")
def session_delta(spark, d):
    f = table(spark, d, "documents")
    return stats.session_delta(f.where(F.col("doc_id") % 2 == 0), f.where(F.col("doc_id") % 3 != 0))


@CATALOG.add("corpus_size", f"WITH {FILES} SELECT count(*) AS files, round(CAST(sum(file_size) AS BIGINT) / (1024.0::DOUBLE * 1024 * 1024), 8) AS gb FROM files")
def corpus_size(spark, d):
    return stats.corpus_size(files(spark, d))


@CATALOG.add("ledger_count", "SELECT count(*) AS entries FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM conversations) t WHERE trim(l) <> ''")
def ledger_count(spark, d):
    return stats.ledger_count(table(spark, d, "conversations").select(F.explode(F.split("text", "\n")).alias("value")))


@CATALOG.add("source_union", """
SELECT 'documents' AS source, doc_id AS id, lang, NULL AS url FROM documents UNION ALL SELECT 'pages', page_id, NULL, url FROM pages""")
def source_union(spark, d):
    a = table(spark, d, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "lang")
    b = table(spark, d, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"), "url")
    return scale.union_all([a, b])
