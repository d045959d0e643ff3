"""Registered queries on file formats, feeds and harvest records.

Where an operator reads files, the given tables are first written in that
format to the shared folder by Spark and then scanned back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from deckmill.catalog.common import FILES, Catalog, files, longs, table
from deckmill.functions import records as rc
from deckmill.functions import urls
from deckmill.operators import ledger, records
from deckmill.session import scratch_path
from deckmill.sinks import tables as sinks
from deckmill.sources import tables as src

CATALOG = Catalog()


def pages(spark, d):
    return table(spark, d, "pages")


def s(column):
    return F.col(column).cast("string")


@CATALOG.add("metadata_sidecar_scan", f"""WITH {FILES}
SELECT original_filename, source_url, file_size, n_tags, document_title FROM (
  SELECT name AS original_filename, source_url, file_size, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 0 END AS n_tags, '' AS document_title, doc_id FROM files) t WHERE doc_id % 20 <> 3""")
def metadata_sidecar_scan(spark, d):
    path = scratch_path(spark, "sidecars")
    good = F.to_json(F.struct(F.col("name").alias("original_filename"), "source_url", "file_size", F.lit("x").alias("unknown_key"),
                              F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a"), F.col("lang"))).alias("tags_categories")))
    files(spark, d).select(F.when(F.col("doc_id") % 20 == 3, F.lit('{"source_url": "cut')).otherwise(good)).write.text(path)
    got = src.sidecars(spark, path, lines=True)
    return got.select("original_filename", "source_url", "file_size", F.coalesce(F.size("tags_categories"), F.lit(0)).alias("n_tags"),
                      F.coalesce("document_title", F.lit("")).alias("document_title"))


@CATALOG.add("sidecar_join", f"""WITH {FILES}
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'full ' || name WHEN 1 THEN 'stem ' || name WHEN 2 THEN 'full ' || name END AS title FROM files""")
def sidecar_join(spark, d):
    f = files(spark, d).select("doc_id", "name", "path")
    stem = F.regexp_replace("path", r"\.[^./]+$", "")
    kind = F.col("doc_id") % 4
    full = f.where(kind.isin(0, 2)).select(F.concat("path", F.lit(".meta.json")).alias("sidecar_path"), F.concat(F.lit("full "), "name").alias("title"))
    short = f.where(kind.isin(1, 2)).select(F.concat(stem, F.lit(".meta.json")).alias("sidecar_path"), F.concat(F.lit("stem "), "name").alias("title"))
    base = F.regexp_replace("sidecar_path", r"\.meta\.json$", "")
    cards = full.unionByName(short).withColumn("deck_path_a", base).withColumn("deck_stem_b", base)
    return src.with_sidecars(f, cards).select("doc_id", "sidecar.title")


@CATALOG.add("sidecar_json_without_empties", f"""WITH {FILES}
SELECT doc_id, '{{"source_url":"' || source_url || '",' || CASE WHEN doc_id % 3 = 0 THEN '' ELSE '"language":"' || lang || '",' END
  || '"slide_count":' || (doc_id % 2) || CASE WHEN doc_id % 2 = 0 THEN ',"tags":["' || source || '"]' ELSE '' END || '}}' AS json FROM files""")
def sidecar_json_without_empties(spark, d):
    f = files(spark, d).withColumns({"language": F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")),
                                     "slide_count": (F.col("doc_id") % 2), "title": F.lit(""),
                                     "tags": F.when(F.col("doc_id") % 2 == 0, F.array("source")).otherwise(F.array().cast("array<string>"))})
    json = rc.sidecar_json(["source_url", "title", "language", "slide_count", "tags"], ["source_url", "title", "language"], ["tags"])
    return f.select("doc_id", json.alias("json"))


@CATALOG.add("crawl_index_scan", """
SELECT url, CASE WHEN page_id % 9 = 0 THEN 0 ELSE strlen(html) END AS length, page_id * 10 AS "offset", 'CC-1' AS crawl FROM pages WHERE page_id % 5 <> 0""")
def crawl_index_scan(spark, d):
    path = scratch_path(spark, "crawl-index")
    record = F.to_json(F.struct("url", F.when(F.col("page_id") % 9 == 0, "n/a").otherwise(F.octet_length("html").cast("string")).alias("length"),
                                (F.col("page_id") * 10).cast("string").alias("offset"), F.lit("CC-1").alias("_crawl")))
    i = F.col("page_id") % 5
    text = F.when(F.col("page_id") % 10 == 0, "").when(i == 0, '{"url": "broken').otherwise(record)
    pages(spark, d).select(text).write.text(path)
    return src.crawl_index(spark, path).select("url", "length", "offset", F.col("_crawl").alias("crawl"))


@CATALOG.add("header_row_promotion", """
SELECT page_id, url AS original, CAST(20240101000000 + page_id AS VARCHAR) AS timestamp, NULL AS length FROM pages WHERE page_id % 7 <> 0
UNION ALL SELECT page_id, url || '#2', '20250101000000', '77' FROM pages WHERE page_id % 7 <> 0 AND page_id % 2 = 0""")
def header_row_promotion(spark, d):
    i = F.col("page_id")
    one = F.array(F.col("url"), (F.lit(20240101000000) + i).cast("string"))
    plain = F.array(F.array(F.lit("original"), F.lit("timestamp")), one)
    wide = F.array(F.array(F.lit("timestamp"), F.lit("original"), F.lit("length")), F.array(one[1], one[0]),
                   F.array(F.lit("20250101000000"), F.concat("url", F.lit("#2")), F.lit("77")))
    head = F.array(F.array(F.lit("original"), F.lit("timestamp")))
    payload = F.when(i % 7 == 0, F.to_json(head)).when(i % 2 == 0, F.to_json(wide)).otherwise(F.to_json(plain))
    return src.promote_header(pages(spark, d).select("page_id", payload.alias("payload")), "payload", ["original", "timestamp", "length"], ["page_id"])


@CATALOG.add("flexible_dataset_columns", """
SELECT url, CASE WHEN page_id % 4 = 0 THEN 'f' || page_id ELSE CAST(page_id AS VARCHAR) END AS record_id,
  CASE WHEN page_id % 3 = 0 THEN 'untitled' ELSE 'T' || page_id END AS record_title, '' AS record_category FROM pages WHERE page_id > 0""")
def flexible_dataset_columns(spark, d):
    path = scratch_path(spark, "shards")
    i = F.col("page_id")
    pages(spark, d).where(i > 0).select("url", F.when(i % 4 != 0, i).alias("ID"), F.when(i % 4 == 0, F.concat(F.lit("f"), s("page_id"))).alias("file_id"),
                                        F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("T"), s("page_id"))).alias("Title")).write.parquet(path)
    return src.dataset_shards(spark, path).select("url", "record_id", "record_title", "record_category")


@CATALOG.add("flexible_dataset_columns_all", """
SELECT url, CASE WHEN page_id % 4 = 0 THEN 'f' || page_id ELSE CAST(page_id AS VARCHAR) END AS record_id,
  CASE WHEN page_id % 3 = 0 THEN 'untitled' ELSE 'T' || page_id END AS record_title, lower(split_part(url, '/', 3)) AS record_category FROM pages""")
def flexible_dataset_columns_all(spark, d):
    """Every page, with a category column."""
    path = scratch_path(spark, "shards")
    i = F.col("page_id")
    pages(spark, d).select("url", F.when(i % 4 != 0, i).alias("ID"), F.when(i % 4 == 0, F.concat(F.lit("f"), s("page_id"))).alias("file_id"),
                           F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("T"), s("page_id"))).alias("Title"),
                           F.lower(F.split_part("url", F.lit("/"), F.lit(3))).alias("category")).write.parquet(path)
    return src.dataset_shards(spark, path).select("url", "record_id", "record_title", "record_category")


@CATALOG.add("dataset_row_numbers", "SELECT count(*) AS n, count(DISTINCT page_id) AS ids, 0 AS least FROM pages")
def dataset_row_numbers(spark, d):
    got = src.dataset_shards(spark, f"{d}/pages.parquet")
    return got.agg(F.count("*").alias("n"), F.count_distinct("record_id").alias("ids"), F.min(F.col("record_id").cast("int")).alias("least"))


@CATALOG.add("dataset_binary_column", "SELECT page_id, strlen(html || html || html) AS bytes, md5(html || html || html) AS md5 FROM pages")
def dataset_binary_column(spark, d):
    path = scratch_path(spark, "binary-shards")
    pages(spark, d).select("page_id", F.encode(F.lit("short"), "UTF-8").alias("thumb"),
                           F.encode(F.concat("html", "html", "html"), "UTF-8").alias("payload")).write.parquet(path)
    shards = spark.read.parquet(path)
    column = src.binary_column(shards)
    return longs(shards.select("page_id", F.octet_length(column).alias("bytes"), F.md5(column).alias("md5")))


@CATALOG.add("ledger_scan", "SELECT DISTINCT substr(sha1(text), 1, 10) AS tag FROM documents WHERE doc_id % 10 <> 0")
def ledger_scan(spark, d):
    path = scratch_path(spark, "ledger")
    tag = F.substring(F.sha1(F.encode("text", "UTF-8")), 1, 10)
    table(spark, d, "documents").select(F.when(F.col("doc_id") % 10 == 0, "  ").otherwise(F.concat(F.lit(" "), tag, F.lit(" ")))).write.text(path)
    return src.ledger(src.ledger_lines(spark, path))


@CATALOG.add("ledger_append", """
SELECT count(*) AS entries, count(DISTINCT tag) AS tags FROM (SELECT DISTINCT sha256(text) AS tag FROM documents)""")
def ledger_append(spark, d):
    path = scratch_path(spark, "ledger-table")
    f = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("tag"))
    first = f.where(F.col("doc_id") % 2 == 0).select("tag").distinct()
    sinks.append_ledger(first, path, ["tag"])
    for _ in range(2):  # the second round finds nothing new
        known = spark.read.parquet(path)
        sinks.append_ledger(ledger.new_entries(f, known, "tag"), path, ["tag"])
    return spark.read.parquet(path).agg(F.count("*").alias("entries"), F.count_distinct("tag").alias("tags"))


@CATALOG.add("rename_log_scan", f"""WITH {FILES}
SELECT 'n' || doc_id || '.pptx' AS new_name, CASE WHEN doc_id % 3 = 0 THEN 'old_name.pptx' ELSE substr(sha1(text), 1, 10) || '_z.pptx' END AS old_name,
  CASE WHEN doc_id % 3 <> 0 THEN substr(sha1(text), 1, 10) END AS tag FROM files WHERE doc_id % 10 <> 9""")
def rename_log_scan(spark, d):
    path = scratch_path(spark, "rename-log")
    tag = F.substring(F.sha1(F.encode("text", "UTF-8")), 1, 10)
    old = F.when(F.col("doc_id") % 3 == 0, "old_name.pptx").otherwise(F.concat(tag, F.lit("_z.pptx")))
    line = F.when(F.col("doc_id") % 10 == 9, "--- session ---").otherwise(F.concat(F.lit("n"), s("doc_id"), F.lit(".pptx | "), old))
    table(spark, d, "documents").select(line).write.text(path)
    log = src.rename_log(spark, path)
    return log.join(ledger.rename_tags(log), "new_name", "left").select("new_name", "old_name", "tag")


@CATALOG.add("rename_map_write", f"""WITH {FILES} SELECT 'x' || name AS new_name, name AS old_name FROM files""")
def rename_map_write(spark, d):
    path = scratch_path(spark, "rename-map")
    pairs = files(spark, d).select(F.concat(F.lit("x"), "name").alias("new_name"), F.col("name").alias("old_name"))
    sinks.write_rename_map(pairs, path, "1")
    return src.rename_log(spark, f"{path}/session=1").select("new_name", "old_name")


@CATALOG.add("seed_list_scan", "SELECT url AS name, url AS base_url FROM pages WHERE page_id % 3 = 1")
def seed_list_scan(spark, d):
    path = scratch_path(spark, "seeds")
    i = F.col("page_id") % 3
    pages(spark, d).select(F.when(i == 0, "").when(i == 2, "# a comment").otherwise(F.concat(F.lit("  "), "url"))).write.text(path)
    return src.seed_list(src.ledger_lines(spark, path))


@CATALOG.add("harvest_feed_links", """
SELECT page_id, unnest(['https://r.example.org/' || page_id || '.PPTX?seq=1', 'http://r.example.org/bitstream/1/' || page_id || '.pptx.txt']) AS link FROM pages WHERE page_id % 4 <> 0""")
def harvest_feed_links(spark, d):
    i = s("page_id")
    body = F.concat(
        F.lit('<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords><record><header><identifier>http://no.example.org/a.ppt</identifier></header>'
              '<metadata><dc xmlns:d="http://purl.org/dc/elements/1.1/"><d:identifier> https://r.example.org/'), i,
        F.lit(".PPTX?seq=1 </d:identifier><d:title>a &amp; b</d:title><d:relation>http://r.example.org/bitstream/1/"), i,
        F.lit(".pptx.txt</d:relation><d:identifier>http://r.example.org/x.pdf</d:identifier><d:identifier>ftp://r/b.ppt</d:identifier>"),
        F.when(F.col("page_id") % 4 == 0, "").otherwise("</dc>"), F.lit("</metadata></record></ListRecords></OAI-PMH>"))
    return src.harvest_links(pages(spark, d).select("page_id", body.alias("value")), keep=["page_id"])


@CATALOG.add("harvest_dump_links", """
SELECT unnest(['https://r.example.org/' || page_id || '.PPTX?seq=1', 'http://r.example.org/bitstream/1/' || page_id || '.pptx.txt']) AS link FROM pages WHERE page_id % 4 <> 0""")
def harvest_dump_links(spark, d):
    """All pages' records in few large responses, every fourth record malformed."""
    path, i = scratch_path(spark, "harvest-dump"), s("page_id")
    record = F.concat(
        F.lit("<record><header><identifier>http://no.example.org/a.ppt</identifier></header>\n<metadata><oai:dc>\n<d:identifier> https://r.example.org/"), i,
        F.lit(".PPTX?seq=1 </d:identifier><d:title>a &amp; b &lt;</d:title><d:relation>http://r.example.org/bitstream/1/"), i,
        F.lit(".pptx.txt</d:relation><d:identifier>http://r.example.org/x.pdf</d:identifier><d:identifier>ftp://r/b.ppt</d:identifier>"),
        F.when(F.col("page_id") % 4 == 0, "</oai:other>").otherwise("</oai:dc>"), F.lit("\n</metadata></record>"))
    pages(spark, d).select(record).write.text(path)
    return src.harvest_dump_links(spark, path)


@CATALOG.add("sitemap_scan", "SELECT url FROM pages")
def sitemap_scan(spark, d):
    path = scratch_path(spark, "sitemap")
    (pages(spark, d).select(F.col("url").alias("loc")).write.format("xml").option("rootTag", "urlset").option("rowTag", "url")
     .option("compression", "gzip").save(path))
    return src.sitemap_urls(spark, path)


@CATALOG.add("sitemap_index_scan", "SELECT 'https://s.example.org/docs-' || page_id || '.xml.gz' AS loc FROM pages WHERE page_id % 2 = 0")
def sitemap_index_scan(spark, d):
    path = scratch_path(spark, "sitemap-index")
    kind = F.when(F.col("page_id") % 2 == 0, "docs-").otherwise("users-")
    (pages(spark, d).select(F.concat(F.lit("https://s.example.org/"), kind, s("page_id"), F.lit(".xml.gz")).alias("loc"))
     .write.format("xml").option("rootTag", "sitemapindex").option("rowTag", "sitemap").save(path))
    return src.sitemap_index(spark, path)


@CATALOG.add("folder_listing_filter", """
SELECT doc_id FROM documents WHERE doc_id % 4 IN (0, 1)""")
def folder_listing_filter(spark, d):
    from deckmill.sources import decks

    k = F.col("doc_id") % 4
    mime = F.when(k == 0, "application/vnd.ms-powerpoint").otherwise("application/octet-stream")
    name = F.when(k == 1, "Deck.PPTX").when(k == 2, "deck.pptx.txt").otherwise("deck")
    return table(spark, d, "documents").where(decks.is_deck_item(mime, name)).select("doc_id")


@CATALOG.add("directory_manifest", f"WITH {FILES} SELECT name, source_url FROM files")
def directory_manifest(spark, d):
    path = scratch_path(spark, "manifest")
    cards = files(spark, d).select("name", "source_url", F.concat("path", F.lit(".meta.json")).alias("sidecar_path"))
    sinks.export_manifest(cards, path)
    return spark.read.schema("name string, source_url string").json(path)


@CATALOG.add("audit_log_append", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def audit_log_append(spark, d):
    path = scratch_path(spark, "audit")
    rows = table(spark, d, "documents").select("source", F.lit("PASS").alias("file_integrity"))
    sinks.append_audit(rows, path, "0")
    sinks.append_audit(rows, path, "0")  # a repeated write of the same part leaves one copy
    return spark.read.schema("source string, file_integrity string").json(path).groupBy("source").agg(F.count("*").alias("n"))


@CATALOG.add("reject_log", "SELECT CAST(doc_id AS VARCHAR) AS file_id, 'few slides' AS reason FROM documents WHERE doc_id % 3 = 0")
def reject_log(spark, d):
    path = scratch_path(spark, "rejects")
    rows = table(spark, d, "documents").where(F.col("doc_id") % 3 == 0).select(
        s("doc_id").alias("file_id"), F.lit("f").alias("filename"), F.lit("few slides").alias("reason"))
    sinks.append_rejects(rows, path)
    return spark.read.schema("file_id string, reason string").json(path)


# ---- records ---------------------------------------------------------------------
def raw_records(spark, d):
    i = F.col("doc_id")
    a = F.to_json(F.struct(i.alias("record_id"), F.col("source").alias("title"), F.array("lang", F.lit("x")).alias("tags"),
                           F.concat(F.lit("https://p/"), s("doc_id")).alias("url"), F.lit("10.1/x").alias("doi"), F.lit(0).alias("views"),
                           F.lit(False).alias("flag"), F.lit("0").alias("zero_text")))
    b = F.to_json(F.struct(s("doc_id").alias("id"), F.col("source").alias("document_title"), F.lit("solo").alias("keywords"),
                           F.lit("P").alias("publisher"), F.array(F.lit(1), F.lit(2)).alias("pages"), F.lit("").alias("note")))
    c = F.to_json(F.struct(i.alias("article_id"), F.lit("h").alias("hal_id"), F.lit("").alias("title"), F.lit("unused").alias("document_title"),
                           F.lit("A; B").alias("authors"), F.lit(5).alias("tags"), F.lit("2020").alias("published_date")))
    return table(spark, d, "documents").select("doc_id", F.when(i % 3 == 0, a).when(i % 3 == 1, b).otherwise(c).alias("record"))


@CATALOG.add("canonical_metadata", """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'https://p/' || doc_id ELSE 'https://Dl.example.org:8080/' || doc_id END AS source_url,
  'dl.example.org:8080' AS source_domain, CAST(doc_id AS VARCHAR) AS api_record_id,
  CASE WHEN doc_id % 3 = 2 THEN '' ELSE source END AS document_title, CASE WHEN doc_id % 3 = 1 THEN 'P' ELSE '' END AS organization_name,
  CASE WHEN doc_id % 3 = 2 THEN 'A; B' ELSE '' END AS author_info, CASE WHEN doc_id % 3 = 2 THEN '2020' ELSE '' END AS publication_date,
  CASE doc_id % 3 WHEN 0 THEN lang || '|x' WHEN 1 THEN 'solo' ELSE '' END AS tags,
  CASE doc_id % 3 WHEN 0 THEN 'doi="10.1/x",flag_none,zero_text="0"' WHEN 1 THEN 'pages=[1,2]' ELSE '' END AS extra, 'PPTX' AS file_format FROM documents""".replace("flag_none,", ""))
def canonical_metadata(spark, d):
    link = F.concat(F.lit("https://Dl.example.org:8080/"), s("doc_id"))
    m = rc.metadata_from_record(F.col("record"), F.lit("repo"), link, F.lit("a.b.pptx"), F.lit("2026-01-01T00:00:00Z"))
    out = raw_records(spark, d).withColumns(m)
    extra = F.array_join(F.transform(F.array_sort(F.map_entries("extra")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return out.select("doc_id", "source_url", "source_domain", "api_record_id", "document_title", "organization_name", "author_info",
                      "publication_date", F.array_join("tags_categories", "|").alias("tags"), extra.alias("extra"), "file_format")


@CATALOG.add("repository_record_files", """
SELECT CAST(page_id AS VARCHAR) AS record_id, CASE WHEN page_id % 4 = 3 THEN 'untitled' ELSE 'T' || page_id END AS title, 'a.PPTX' AS filename,
  CASE WHEN page_id % 4 = 1 THEN 'https://z/content' ELSE url || '/content' END AS url FROM pages
UNION ALL SELECT CAST(page_id AS VARCHAR), CASE WHEN page_id % 4 = 3 THEN 'untitled' ELSE 'T' || page_id END, 'b.ppt', 'https://z/only' FROM pages WHERE page_id % 2 = 0""")
def repository_record_files(spark, d):
    i = F.col("page_id")
    own = F.when(i % 4 == 1, "https://z/content").otherwise(F.col("url"))
    deck = F.struct(F.lit("a.PPTX").alias("key"), F.struct(own.alias("self")).alias("links"))
    pdf = F.struct(F.lit("c.pdf").alias("key"), F.struct(F.lit("https://z/c").alias("self")).alias("links"))
    other = F.struct(F.lit("b.ppt").alias("key"), F.struct(F.lit("https://z/only").alias("content")).alias("links"))
    meta = F.struct(F.when(i % 4 != 3, F.concat(F.lit("T"), s("page_id"))).alias("title"))
    listed = F.to_json(F.struct(i.alias("id"), meta.alias("metadata"), F.array(F.to_json(deck), F.to_json(pdf), F.to_json(other)).alias("f")))
    head = F.regexp_replace(listed, r',"f":.*$', "")
    as_list = F.concat(head, F.lit(',"files":['), F.to_json(deck), F.lit(","), F.to_json(pdf), F.lit(","), F.to_json(other), F.lit("]}"))
    named = F.to_json(F.struct(F.struct(own.alias("self")).alias("links")))
    as_map = F.concat(head, F.lit(',"files":{"entries":{"a.PPTX":'), named, F.lit(',"c.pdf":'), F.to_json(pdf), F.lit("}}}"))
    rec = F.when(i % 2 == 0, as_list).otherwise(as_map)
    return records.repository_files(pages(spark, d).select(rec.alias("record")))


@CATALOG.add("paper_record_files", """
SELECT 'hal-' || page_id AS hal_id, CASE WHEN page_id % 3 = 0 THEN 'untitled' ELSE 'T' || page_id END AS title, 'https://h/' || page_id || '.ppt?x=1' AS url, '.ppt' AS ext FROM pages
UNION ALL SELECT 'hal-' || page_id, CASE WHEN page_id % 3 = 0 THEN 'untitled' ELSE 'T' || page_id END, 'https://h/b.PPTX', '.pptx' FROM pages WHERE page_id % 2 = 0""")
def paper_record_files(spark, d):
    i = F.col("page_id")
    first = F.concat(F.lit("https://h/"), s("page_id"), F.lit(".ppt?x=1"))
    t = F.concat(F.lit("T"), s("page_id"))
    head = F.concat(F.lit('{"halId_s":"hal-'), s("page_id"), F.lit('"'),
                    F.when(i % 3 == 1, F.concat(F.lit(',"title_s":["'), t, F.lit('","second"]'))).when(i % 3 == 2, F.concat(F.lit(',"title_s":"'), t, F.lit('"'))).otherwise(""))
    many = F.concat(F.lit(',"files_s":["'), first, F.lit('","https://h/b.PPTX","https://h/c.pdf"]}'))
    one = F.concat(F.lit(',"files_s":"'), first, F.lit('"}'))
    return records.paper_files(pages(spark, d).select(F.concat(head, F.when(i % 2 == 0, many).otherwise(one)).alias("record")))


@CATALOG.add("article_record_files", "SELECT CAST(page_id AS VARCHAR) AS article_id, 'T' AS title, 'x.pptx' AS filename, url FROM pages")
def article_record_files(spark, d):
    f = F.array(F.struct(F.lit("x.pptx").alias("name"), F.col("url").alias("download_url")),
                F.struct(F.lit("y.pptx").alias("name"), F.lit("").alias("download_url")), F.struct(F.lit("z.csv").alias("name"), F.lit("u").alias("download_url")))
    return records.article_files(pages(spark, d).select(F.to_json(F.struct(F.col("page_id").alias("id"), F.lit("T").alias("title"), f.alias("files"))).alias("record")))


@CATALOG.add("archive_item_files", """
SELECT 'it-' || page_id AS identifier, 'it-' || page_id AS title, 'a b*~.pptx' AS filename, page_id AS declared_size,
  'https://archive.org/download/it-' || page_id || '/a%20b%2A~.pptx' AS url FROM pages WHERE page_id % 10 <> 0""")
def archive_item_files(spark, d):
    ident = F.concat(F.lit("it-"), s("page_id"))
    f = F.array(F.struct(F.lit("a b*~.pptx").alias("name"), s("page_id").alias("size"), F.lit("original").alias("source")),
                F.struct(F.lit("t.pptx").alias("name"), F.lit("1").alias("size"), F.lit("metadata").alias("source")))
    base = pages(spark, d).select("page_id", ident.alias("identifier"))
    rec = pages(spark, d).select(F.to_json(F.struct(ident.alias("identifier"), f.alias("files"))).alias("record"))
    return records.item_files(rec, skip=base.where(F.col("page_id") % 10 == 0), file_sources=["original", "derivative"])


@CATALOG.add("datafile_records", """
SELECT 'https://dv' AS instance, CAST(page_id AS VARCHAR) AS file_id, 'n.ppt' AS filename, CASE WHEN page_id % 2 = 0 THEN 'D' ELSE 'S' END AS title,
  'https://dv/api/access/datafile/' || page_id AS url FROM pages WHERE page_id > 0 AND page_id % 5 <> 0""")
def datafile_records(spark, d):
    i = F.col("page_id")
    rec = F.to_json(F.struct(i.alias("file_id"), F.when(i % 5 == 0, "n.pdf").otherwise("n.ppt").alias("name"), F.when(i % 2 == 0, "D").alias("description"),
                             F.lit("S").alias("dataset_name")))
    return records.datafile_rows(pages(spark, d).select(F.lit("https://dv").alias("instance"), rec.alias("record")))


@CATALOG.add("code_search_records", """
SELECT 'o/r' || page_id AS repo, 'deck.pptx' AS filename, 'https://raw.githubusercontent.com/o/r' || page_id || '/main/d/deck.pptx' AS url FROM pages WHERE page_id % 3 <> 0""")
def code_search_records(spark, d):
    repo = F.concat(F.lit("o/r"), s("page_id"))
    rec = F.to_json(F.struct(F.struct(F.when(F.col("page_id") % 3 != 0, repo).alias("full_name")).alias("repository"), F.lit("d/deck.pptx").alias("path"),
                             F.concat(F.lit("https://github.com/"), repo, F.lit("/blob/main/d/deck.pptx")).alias("html_url")))
    return records.code_files(pages(spark, d).select(rec.alias("record")))


@CATALOG.add("work_record_links", """
SELECT CAST(page_id AS VARCHAR) AS id, CASE WHEN page_id % 2 = 0 THEN 'T' ELSE 'core_file' END AS filename,
  CASE WHEN page_id % 3 = 0 THEN url ELSE 'https://l/d1' END AS url FROM pages WHERE page_id % 3 <> 2""")
def work_record_links(spark, d):
    i = F.col("page_id")
    links = F.array(F.struct(F.lit("display").alias("type"), F.lit("https://l/x").alias("url")), F.struct(
        F.when(i % 3 == 2, "reader").otherwise("download").alias("type"), F.lit("https://l/d1").alias("url")),
        F.struct(F.when(i % 3 == 2, "reader").otherwise("download").alias("type"), F.lit("https://l/d2").alias("url")))
    rec = F.to_json(F.struct(i.alias("id"), F.when(i % 2 == 0, "T").alias("title"), F.when(i % 3 == 0, F.col("url")).alias("downloadUrl"), links.alias("links")))
    return records.work_links(pages(spark, d).select(rec.alias("record")))


def catalogue_packages(spark, d):
    i = F.col("page_id")
    res = F.array(
        F.struct(s("page_id").alias("id"), F.when(i % 2 == 0, "/d/one.pptx").otherwise(" https://o.example.org/Two.PPT ").alias("url"), F.lit("").alias("format"),
                 F.when(i % 3 != 0, "R").alias("name"), F.lit("D").alias("description")),
        F.struct(F.lit("f").alias("id"), F.lit("https://o.example.org/get?id=1").alias("url"), F.when(i % 5 == 0, " pptx").otherwise("CSV").alias("format"),
                 F.lit("").alias("name"), F.lit("").alias("description")),
        F.struct(F.lit("b").alias("id"), F.lit(" ").alias("url"), F.lit("PPT").alias("format"), F.lit("").alias("name"), F.lit("").alias("description")))
    org = F.when(i % 4 != 0, F.struct(F.lit("").alias("title"), F.lit("orgname").alias("name")))
    return pages(spark, d).select("page_id", F.lit("P").alias("portal_name"), F.lit("https://portal.example.org/data").alias("portal_base_url"), F.to_json(F.struct(
        F.concat(F.lit("pkg"), s("page_id")).alias("id"), F.lit("Package").alias("title"), org.alias("organization"),
        F.array(F.struct(F.lit("t1").alias("name")), F.struct(F.lit("").alias("name"))).alias("tags"), res.alias("resources"))).alias("package"))


_CATALOGUE = """cat AS (
  SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://portal.example.org/d/one.pptx' ELSE 'https://o.example.org/Two.PPT' END AS url, '' AS format,
    CASE WHEN page_id % 3 <> 0 THEN 'R' ELSE 'D' END AS resource_name, CAST(page_id AS VARCHAR) AS resource_id FROM pages
  UNION ALL SELECT page_id, 'https://o.example.org/get?id=1', ' pptx', '', 'f' FROM pages WHERE page_id % 5 = 0)"""


@CATALOG.add("catalogue_resources", f"""WITH {_CATALOGUE}
SELECT page_id, url, format, resource_name, resource_id, 'pkg' || page_id AS package_id, CASE WHEN page_id % 4 <> 0 THEN 'orgname' ELSE '' END AS organization,
  '' AS author, 't1' AS tags FROM cat""")
def catalogue_resources(spark, d):
    return records.catalogue_resources(catalogue_packages(spark, d), keep=["page_id"]).select(
        "page_id", "url", "format", "resource_name", "resource_id", "package_id", "organization", "author", F.array_join("tags", ",").alias("tags"))


@CATALOG.add("catalogue_sidecars", f"""WITH {_CATALOGUE}
SELECT page_id, url AS source_url, CASE WHEN contains(url, 'one.pptx') THEN 'one.pptx' WHEN contains(url, 'Two') THEN 'Two.PPT' ELSE 'get' END AS original_filename,
  split_part(url, '/', 3) AS source_domain, CASE WHEN resource_name <> '' THEN resource_name ELSE 'Package' END AS title, format AS declared_format FROM cat""")
def catalogue_sidecars(spark, d):
    r = records.catalogue_resources(catalogue_packages(spark, d), keep=["page_id"])
    columns = {c: F.col(c) for c in r.columns if c not in ("url", "page_id")}
    card = rc.catalogue_sidecar(F.col("url"), columns, F.lit("fallback.pptx"), F.lit("2026-01-01T00:00:00Z"))
    return r.withColumn("c", card).select("page_id", "c.source_url", "c.original_filename", "c.source_domain", "c.title", "c.crawl_metadata.declared_format")


@CATALOG.add("batch_sidecars", f"""WITH {FILES}
SELECT 'BATCH_02' AS batch_id, doc_id AS sequence_number, 'BATCH_02_names_' || name AS filename, name AS original_filename, source_url,
  lang || '.' || source || '.example.org' AS source_domain, file_size, ltrim(extension, '.') AS file_format FROM files""")
def batch_sidecars(spark, d):
    f = files(spark, d).withColumn("sequence_number", F.col("doc_id")).withColumn("dest_name", F.concat(F.lit("BATCH_02_names_"), "name"))
    return f.select(*rc.batch_sidecar("BATCH_02", F.lit("2026-01-01T00:00:00Z"))).drop("download_url", "collection_timestamp")


@CATALOG.add("url_domain_case", "SELECT page_id, regexp_extract(upper(url), '^[A-Z]+://([^/?#]*)', 1) AS domain FROM pages")
def url_domain_case(spark, d):
    return pages(spark, d).select("page_id", urls.authority(F.upper("url"), lower=False).alias("domain"))


@CATALOG.add("harvest_file_names", r"""
SELECT page_id, substr(sha1(url), 1, 10) AS tag, 'hal_h_' || page_id || '_' || regexp_replace(substr(title, 1, 80), '[^\p{L}\p{N}_\-]', '_', 'g') || '.ppt' AS paper,
  'core_' || page_id || '_' || regexp_replace(substr(title, 1, 100), '[^\p{L}\p{N}_\-]', '_', 'g') || '.pptx' AS work,
  't_pon_' || page_id || '_' || regexp_replace(substr(CASE WHEN title = '' THEN 'untitled' ELSE title END, 1, 35), '[^\p{L}\p{N}_\-]', '_', 'g') || '.pptx' AS dataset,
  'github_o_r_' || page_id || '.pptx' AS code,
  CASE WHEN length(df) > 200 THEN substr(df, 1, 190) || '.ppt' ELSE df END AS datafile,
  substr(sha1(url || '/Deck One.PPTX'), 1, 10) || '_ckan_' || substr(regexp_replace(split_part(url, '/', 3), '[^\p{L}\p{N}_]', '_', 'g'), 1, 30) || '_Deck_One.pptx' AS catalogue
FROM (SELECT *, 'dataverse_' || page_id || '_' || regexp_replace(substr(title, 1, 60), '[^\p{L}\p{N}_\-]', '_', 'g') || '_' ||
        regexp_replace(substr(title, 1, 150), '[^\p{L}\p{N}_.\-]', '_', 'g') || '.ppt' AS df
      FROM (SELECT page_id, split_part(split_part(url, '?', 1), '#', 1) AS url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages) a) t""")
def harvest_file_names(spark, d):
    from deckmill.functions import names

    i = s("page_id")
    p = pages(spark, d).select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
                               F.split_part(F.split_part("url", F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1)).alias("url"))
    u, t = F.col("url"), F.col("title")
    return p.select("page_id", urls.url_tag(u).alias("tag"), names.titled_name("hal", F.concat(F.lit("h_"), i), t, F.lit(".ppt")).alias("paper"),
                    names.work_name(i, t).alias("work"), names.dataset_name(F.lit("t"), i, t, F.lit(".pptx")).alias("dataset"),
                    names.code_file_name(F.lit("o/r"), F.concat(i, F.lit(".pptx"))).alias("code"),
                    names.datafile_name(i, t, F.concat(F.substring("title", 1, 150), F.lit(".ppt"))).alias("datafile"),
                    names.catalogue_name(F.concat(u, F.lit("/Deck One.PPTX")), urls.authority(u)).alias("catalogue"))
