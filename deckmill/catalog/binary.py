"""Registered queries on deck bytes.

Decks are made by Spark from the given documents: one slide per line, a volatile
id in each slide, and damaged containers for some ids.
"""

from __future__ import annotations

import gzip
import io
import struct
import sys
import zipfile
from dataclasses import replace
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from deckmill.catalog.common import FILES, SLIDES, Catalog, heavy_files, longs, sql_any, sql_count, sql_under, table
from deckmill.config import DeliveryRules, IntegrityRules, QualityRules
from deckmill.functions import names
from deckmill.operators import dedup, quality, scale
from deckmill.operators.policy import DomainPolicy
from deckmill.plans import curate, ingest
from deckmill.session import cut_lineage, scratch_path
from deckmill.sinks import tables as sinks
from deckmill.sources import archives, decks
from deckmill.sources.decks import pieces
from deckmill.sources.tables import CATALOGUE_SIDECAR_SCHEMA

cloudpickle.register_pickle_by_value(sys.modules[__name__])
CATALOG = Catalog()
NOW = "2026-01-01T00:00:00Z"

_SLIDE = ('<?xml version="1.0" encoding="UTF-8"?><p:sld xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" '
          'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"><p:cSld><p:spTree><p:sp id="{id}"><a:t>{text}</a:t></p:sp>'
          "{frames}</p:spTree></p:cSld></p:sld>")
_FRAME = ('<p:graphicFrame><a:graphic><a:graphicData uri="http://schemas.openxmlformats.org/drawingml/2006/{kind}">{inner}'
          "</a:graphicData></a:graphic></p:graphicFrame>")


def ole_file(streams: list[str], allocation_sectors: int = 1) -> bytes:
    """Compound file with the given streams below its root (512-byte sectors).

    With many allocation sectors the file is as long as a large deck, and its directory lies at the end, in a sector
    whose chain is listed beyond the header.
    """
    none, last = 0xFFFFFFFF, 0xFFFFFFFE
    names_ = ["Root Entry", *streams]
    entries = b"".join(
        (n.encode("utf-16-le").ljust(64, b"\0") + struct.pack("<HBBIII", 2 * len(n) + 2, 2 if i else 5, 1, none,
                                                              i + 1 if 0 < i < len(streams) else none, 1 if not i and streams else none)).ljust(128, b"\0")
        for i, n in enumerate(names_))
    directory = -(-len(entries) // 512)
    extra = -(-max(0, allocation_sectors - 109) // 127)
    first = 128 * allocation_sectors - directory  # the directory ends where the allocation table does
    if allocation_sectors == 1:
        first = 1
    lists = list(range(allocation_sectors, allocation_sectors + extra))
    fat = [none] * (128 * allocation_sectors)
    fat[:allocation_sectors] = [0xFFFFFFFD] * allocation_sectors
    for n in lists:
        fat[n] = 0xFFFFFFFC
    fat[first:first + directory] = [*range(first + 1, first + directory), last]
    header = bytearray(512)
    header[:8] = bytes.fromhex("D0CF11E0A1B11AE1")
    struct.pack_into("<H", header, 30, 9)
    struct.pack_into("<II", header, 44, allocation_sectors, first)
    struct.pack_into("<II", header, 68, lists[0] if lists else last, extra)
    own = list(range(allocation_sectors))
    struct.pack_into("<109I", header, 76, *(own[:109] + [none] * 109)[:109])
    body = bytearray(512 * (first + directory))
    struct.pack_into(f"<{len(fat)}I", body, 0, *fat)
    for k, n in enumerate(lists):
        part = own[109 + 127 * k:109 + 127 * (k + 1)]
        struct.pack_into("<128I", body, 512 * n, *(part + [none] * 127)[:127], lists[k + 1] if k + 1 < len(lists) else last)
    body[512 * first:512 * first + len(entries)] = entries
    return bytes(header + body)


def build_deck(doc_id: int, text: str, lang: str, source: str) -> bytes:
    lines = text.split("\n")
    if doc_id % 10 == 0:
        return ole_file(["PowerPoint Document", "Slide one", "slide two"])
    if doc_id % 19 == 0:
        return b"<!DOCTYPE HTML><html>" + text.encode()
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        if doc_id % 17 != 0:
            z.writestr("[Content_Types].xml", "<Types/>")
        for i, line in enumerate(lines if doc_id % 23 != 0 else [], 1):
            frames = _FRAME.format(kind="chart", inner="") if "eaea" in line else ""
            frames += _FRAME.format(kind="table", inner="<a:tbl/>") if "|" in line else ""
            z.writestr(f"ppt/slides/slide{i}.xml", _SLIDE.format(id=doc_id, text=escape(line), frames=frames))
        if doc_id % 4 == 1:
            z.writestr("ppt/charts/part1.xml", "<c/>")
        z.writestr("docProps/core.xml", '<cp:coreProperties xmlns:cp="http://schemas.openxmlformats.org/package/2006/metadata/core-properties" '
                   f'xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>{lang}</dc:title><dc:creator>{source}</dc:creator></cp:coreProperties>')
    return out.getvalue()


def made_decks(spark, d):
    f = heavy_files(spark, d)

    def run(batches):
        for batch in batches:
            for b in pieces(batch):
                yield pd.DataFrame({"doc_id": b.doc_id, "content": [
                    build_deck(*r) for r in b[["doc_id", "text", "lang", "source"]].itertuples(index=False, name=None)]})

    built = f.select("doc_id", "text", "lang", "source").mapInPandas(run, "doc_id bigint, content binary")
    name = F.concat(names.zero_padded(F.col("doc_id"), 6), F.when(F.col("doc_id") % 10 == 0, ".ppt").otherwise(".pptx"))
    return built.select("doc_id", "content", name.alias("name"), F.lower(names.suffix(name)).alias("extension"),
                        F.concat(F.lit("corpus/"), name).alias("path"), F.octet_length("content").cast("bigint").alias("file_size"),
                        (F.col("doc_id") * 7919 % 100003).alias("mtime"))


_KIND = """k AS (SELECT *, CASE WHEN doc_id % 10 = 0 THEN 'ole' WHEN doc_id % 19 = 0 THEN 'html' WHEN doc_id % 17 = 0 THEN 'untyped'
  WHEN doc_id % 23 = 0 THEN 'bare' ELSE 'good' END AS kind FROM files),
ln AS (SELECT doc_id, count(*) AS n, count(CASE WHEN contains(text, 'eaea') THEN 1 END) AS c, count(CASE WHEN contains(text, '|') THEN 1 END) AS t FROM slides GROUP BY 1),
facts AS (SELECT k.*, CASE WHEN kind = 'ole' THEN 2 WHEN kind IN ('html', 'bare') OR doc_id % 23 = 0 THEN 0 ELSE n END AS slide_members,
  CASE WHEN kind IN ('ole', 'html') OR doc_id % 23 = 0 THEN 0 ELSE c END AS charts, CASE WHEN kind IN ('ole', 'html') OR doc_id % 23 = 0 THEN 0 ELSE t END AS tables,
  CASE WHEN kind NOT IN ('ole', 'html') AND doc_id % 4 = 1 THEN 1 ELSE 0 END AS chart_files,
  CASE kind WHEN 'html' THEN 'Invalid ZIP structure' WHEN 'untyped' THEN 'Missing [Content_Types].xml' WHEN 'bare' THEN 'No slide XML found' ELSE '' END AS reason,
  CASE kind WHEN 'html' THEN 'Invalid ZIP structure (corrupted .pptx)' WHEN 'untyped' THEN 'Missing PPTX content types (corrupted)' ELSE '' END AS clean_reason
  FROM k JOIN ln USING (doc_id))"""


@CATALOG.add("deck_containers", f"""WITH {FILES}, {SLIDES}, {_KIND}
SELECT doc_id, kind NOT IN ('ole', 'html') AS is_zip, kind = 'ole' AS is_ole, slide_members, CAST(chart_files AS BIGINT) AS chart_files, charts, tables, reason, clean_reason,
  CASE WHEN kind IN ('ole', 'html') THEN '' ELSE lang END AS title, CASE WHEN kind IN ('ole', 'html') THEN '' ELSE source END AS author FROM facts""")
def deck_containers(spark, d):
    p = decks.parse_decks(made_decks(spark, d), ["doc_id", "extension"])
    return longs(p.select("doc_id", "is_zip", "is_ole", "slide_members", "chart_files", "charts", "tables",
                    decks.container_reason(F.col("extension")).alias("reason"),
                    decks.container_reason(F.col("extension"), "cleaner").alias("clean_reason"), "title", "author"))


@CATALOG.add("deck_slides", f"""WITH {FILES}, {SLIDES}, {_KIND}
SELECT doc_id, 'ppt/slides/slide' || slide_number || '.xml' AS member, row_number() OVER (PARTITION BY doc_id ORDER BY slide_number || '.xml') AS slide_number,
  text_length, md5(s.text) AS text_md5, contains(s.text, '|') AS has_table FROM slides s JOIN facts USING (doc_id) WHERE slide_members > 0 AND kind <> 'ole'""")
def deck_slides(spark, d):
    p = decks.parse_decks(made_decks(spark, d), ["doc_id"])
    return longs(decks.slides_of(p, ["doc_id"]).select("doc_id", "member", "slide_number", "text_length", F.md5("text").alias("text_md5"), "has_table"))


_MARK = quality.SlideMarkers(chart=("2006/chart",), diagram=("whst",), image=("shsh",))
_RULES = QualityRules(text_heavy_chars=120, photo_heavy_chars=400)


@CATALOG.add("deck_rollup_in_row", f"""WITH {FILES}, {SLIDES}, {_KIND},
fl AS (SELECT doc_id, text_length AS n, contains(text, 'eaea') AS c, contains(text, '|') AS t, contains(lower(text), 'whst') AS g, contains(lower(text), 'shsh') AS i FROM slides),
r AS (SELECT doc_id, count(CASE WHEN c OR t OR g THEN 1 END) AS ana, count(CASE WHEN c THEN 1 END) AS c, count(CASE WHEN t THEN 1 END) AS t, count(CASE WHEN g THEN 1 END) AS g,
  count(CASE WHEN n > 120 AND NOT (c OR t OR g) THEN 1 END) AS heavy, count(CASE WHEN i AND NOT (c OR t OR g) AND n < 400 THEN 1 END) AS photo FROM fl GROUP BY 1)
SELECT doc_id, slide_members AS slide_count, ana AS analytical_slides, c + chart_files AS chart_slides, t AS table_slides, g AS diagram_slides, heavy AS text_heavy_slides,
  photo AS photo_heavy_slides, round(ana / slide_members::DOUBLE, 6) AS analytical_pct,
  CASE WHEN heavy / slide_members::DOUBLE >= 0.75 THEN 'LOW' WHEN photo / slide_members::DOUBLE >= 0.5 THEN 'LOW'
       WHEN ana / slide_members::DOUBLE >= 0.5 AND c + chart_files + g >= 3 THEN 'HIGH' WHEN ana / slide_members::DOUBLE >= 0.2 AND c + chart_files + g >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS tier
FROM r JOIN facts USING (doc_id) WHERE slide_members > 0 AND kind <> 'ole'""")
def deck_rollup_in_row(spark, d):
    p = decks.parse_decks(made_decks(spark, d), ["doc_id"])
    r = quality.with_tier(quality.rollup_parts(p, markers=_MARK, rules=_RULES), "chart_files", _RULES, "tier").where("slide_count > 0")
    return longs(r.select("doc_id", "slide_count", "analytical_slides", "chart_slides", "table_slides", "diagram_slides", "text_heavy_slides",
                    "photo_heavy_slides", F.round("analytical_pct", 6).alias("analytical_pct"), "tier"))


_PIRATE = ["src3.example.org"]


@CATALOG.add("deck_verdicts", f"""WITH {FILES}, {SLIDES}, {_KIND},
v AS (SELECT *, CASE WHEN kind = 'html' THEN 'HTML content detected (likely error page)' WHEN kind <> 'ole' AND reason <> '' THEN reason
  WHEN slide_members < 2 THEN 'Insufficient slides (' || slide_members || ' < 2)' ELSE '' END AS bad FROM facts)
SELECT doc_id, CASE WHEN bad = '' THEN 'PASS' ELSE 'FAIL' END AS file_integrity, bad AS rejection_reason,
  CASE WHEN bad <> '' THEN 'PENDING' WHEN {sql_under("source || '.example.org'", _PIRATE)} THEN 'FAIL' ELSE 'PASS' END AS pirate_screening,
  CASE WHEN bad <> '' THEN 'PENDING' WHEN kind <> 'ole' AND (len(regexp_extract_all(text, '[a-zA-Z0-9._%+\\-]+@[a-zA-Z0-9.\\-]+\\.[a-zA-Z]{{2,}}')) > 2
    OR len(regexp_extract_all(replace(text, chr(10), ' '), '(?:\\+?\\d{{1,3}}[-.\\s]?)?\\(?\\d{{2,4}}\\)?[-.\\s]?\\d{{3,4}}[-.\\s]?\\d{{3,4}}')) > 3) THEN 'REVIEW' ELSE 'PASS' END AS personal_data
FROM v""")
def deck_verdicts(spark, d):
    sources = table(spark, d, "documents").select("doc_id", "source")
    f = made_decks(spark, d).join(sources, "doc_id").withColumn("source_url", F.concat(F.lit("https://"), "source", F.lit(".example.org/"), "name")).withColumn(
        "download_url", F.col("source_url"))
    v = curate.verify_decks(f, None, _PIRATE, integrity_rules=IntegrityRules(min_bytes=1, min_slides=2))
    return v.select(F.substring("name", 1, 6).cast("bigint").alias("doc_id"), "file_integrity", F.col("validation.rejection_reason").alias("rejection_reason"),
                    "pirate_screening", "personal_data")


@CATALOG.add("deck_content_copies", f"""WITH {FILES}, {SLIDES}, {_KIND}
SELECT doc_id, kind = 'good' AND row_number() OVER (PARTITION BY kind = 'good', text ORDER BY mtime, name) > 1 AS is_content_copy FROM facts
WHERE kind IN ('good', 'ole')""")
def deck_content_copies(spark, d):
    p = decks.parse_decks(made_decks(spark, d), ["doc_id", "path", "extension", "mtime"]).where("(is_zip and has_content_types and has_slide) or is_ole")
    hashed = p.withColumn("content_hash", dedup.content_hash_of_parts(decks.part_xml(F.col("parts")))).drop("parts").withColumn("is_binary_copy", F.lit(False))
    return dedup.content_copies(dedup.stored_digests(hashed)).select("doc_id", "is_content_copy")


@CATALOG.add("deck_content_digests", f"""WITH {FILES}, {SLIDES}, {_KIND}
SELECT count(*) AS decks, count(DISTINCT text) AS digests FROM facts WHERE kind NOT IN ('ole', 'html') AND slide_members > 0""")
def deck_content_digests(spark, d):
    p = decks.parse_decks(made_decks(spark, d), ["path"])
    members = p.select("path", F.explode("parts").alias("p")).select("path", "p.member", "p.xml")
    return dedup.content_hash(members).agg(F.count("*").alias("decks"), F.count_distinct("content_hash").alias("digests"))


@CATALOG.add("corpus_slide_counts", f"""WITH {FILES}, {SLIDES}, {_KIND}
SELECT coalesce(extension, 'TOTAL') AS extension, count(*) AS files, CAST(sum(slide_members) AS BIGINT) AS total_slides, count(CASE WHEN slide_members = 0 THEN 1 END) AS zero_or_error
FROM facts GROUP BY ROLLUP (extension)""")
def corpus_slide_counts(spark, d):
    from deckmill.operators import stats

    p = decks.parse_decks(made_decks(spark, d), ["extension"])
    return stats.slide_summary(p, slides="slide_members")


# ---- delivery and transfer ---------------------------------------------------------
_DELIVERY = """dl AS (SELECT *, CASE WHEN kind IN ('html', 'untyped') THEN 'corrupt' WHEN kind <> 'ole' AND slide_members < 5 THEN 'few_slides' ELSE 'delivered' END AS status,
  CASE WHEN kind = 'ole' THEN 5 ELSE slide_members END AS slide_count,
  CASE WHEN kind = 'ole' THEN 'UNKNOWN' WHEN (charts + tables) * 100.0::DOUBLE / greatest(slide_members, 1) >= 50 AND charts + tables >= 3 THEN 'HIGH'
       WHEN (charts + tables) * 100.0::DOUBLE / greatest(slide_members, 1) >= 40 OR charts + tables >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS quality
  FROM facts WHERE doc_id % 6 <> 0)"""
_DELIVERY_RULES = DeliveryRules(min_bytes=0)


def delivery_run(spark, d):
    p = decks.parse_decks(made_decks(spark, d), ["path", "name", "extension", "file_size"])
    facts = curate.deck_facts(p, _DELIVERY_RULES).drop("parts").withColumn("sidecar", F.lit(None).cast(CATALOGUE_SIDECAR_SCHEMA))
    facts = cut_lineage(facts)
    done = table(spark, d, "documents").where(F.col("doc_id") % 6 == 0).select(F.concat(
        names.zero_padded(F.col("doc_id"), 6), F.when(F.col("doc_id") % 10 == 0, ".ppt").otherwise(".pptx")).alias("filename"))
    return curate.deliver(facts, done, "BATCH_03", F.lit(NOW), 7, ["path"], _DELIVERY_RULES)


@CATALOG.add("delivery_metadata", f"""WITH {FILES}, {SLIDES}, {_KIND}, {_DELIVERY}
SELECT 'BATCH_03' AS batch_id, name AS original_filename, 'BATCH_03_names_' || lpad(CAST(7 + row_number() OVER (ORDER BY name) AS VARCHAR), 6, '0') || extension AS filename,
  7 + row_number() OVER (ORDER BY name) AS sequence_number, slide_count, quality AS quality_classification, ltrim(extension, '.') AS file_format, 'PASS' AS file_integrity
FROM dl WHERE status = 'delivered'""")
def delivery_metadata(spark, d):
    return longs(delivery_run(spark, d)["metadata"].select("batch_id", "original_filename", "filename", "sequence_number", "slide_count",
                                                     "quality_classification", "file_format", "file_integrity"))


@CATALOG.add("delivery_audit", f"""WITH {FILES}, {SLIDES}, {_KIND}, {_DELIVERY}
SELECT name AS filename, slide_count, quality, 'PASS' AS file_integrity, 'PASS' AS rights_review, '{NOW}' AS delivered_at FROM dl WHERE status = 'delivered'""")
def delivery_audit(spark, d):
    return longs(delivery_run(spark, d)["audit"].select("filename", "slide_count", "quality", "file_integrity", "rights_review", "delivered_at"))


@CATALOG.add("delivery_ledger", f"""WITH {FILES}, {SLIDES}, {_KIND}, {_DELIVERY} SELECT name AS filename, status FROM dl""")
def delivery_ledger(spark, d):
    return delivery_run(spark, d)["ledger"]


def transfer_run(spark, d):
    p = decks.parse_decks(made_decks(spark, d), ["doc_id", "name", "extension", "file_size"])
    facts = curate.deck_facts(p, _DELIVERY_RULES).drop("parts").withColumns({
        "file_id": F.col("doc_id").cast("string"), "fetched": F.col("doc_id") % 29 != 0, "found_url": F.lit(""), "view_link": F.lit("v"),
        "created_time": F.lit(NOW), "owner_email": F.lit("o@example.org")})
    facts = cut_lineage(facts)
    done = table(spark, d, "documents").where(F.col("doc_id") % 6 == 0).select(F.col("doc_id").cast("string").alias("file_id"))
    rules = DeliveryRules(unparsed_accept_bytes=10 ** 9)
    return curate.transfer(facts, done, ["src9"], "BATCH_01", F.lit(NOW), 27, ["name"], rules)


_TRANSFER = """tr AS (SELECT *, CASE WHEN doc_id % 29 = 0 THEN 'failed' WHEN status = 'corrupt' THEN 'corrupt file — not a readable deck'
    WHEN status = 'few_slides' THEN 'only ' || slide_count || ' slides (min 5)' WHEN kind <> 'ole' AND contains(source, 'src9') THEN 'blocked organisation: ' || source ELSE 'PASS' END AS verdict FROM dl)"""


@CATALOG.add("transfer_metadata", f"""WITH {FILES}, {SLIDES}, {_KIND}, {_DELIVERY}, {_TRANSFER}
SELECT CAST(doc_id AS VARCHAR) AS source_file_id, 'BATCH_01_' || lpad(CAST(27 + row_number() OVER (ORDER BY name) AS VARCHAR), 6, '0') || extension AS upload_filename,
  slide_count, CASE WHEN kind = 'ole' THEN '' ELSE lang END AS title, quality AS quality_classification FROM tr WHERE verdict = 'PASS'""")
def transfer_metadata(spark, d):
    return longs(transfer_run(spark, d)["metadata"].select("source_file_id", "upload_filename", "slide_count", "title", "quality_classification"))


@CATALOG.add("transfer_outcomes", f"""WITH {FILES}, {SLIDES}, {_KIND}, {_DELIVERY}, {_TRANSFER}
SELECT CAST(doc_id AS VARCHAR) AS file_id, CASE verdict WHEN 'failed' THEN 'failed' ELSE 'rejected' END AS outcome, CASE verdict WHEN 'failed' THEN '' ELSE verdict END AS reason
FROM tr WHERE verdict <> 'PASS'""")
def transfer_outcomes(spark, d):
    run = transfer_run(spark, d)
    rejected = run["rejected"].select("file_id", F.lit("rejected").alias("outcome"), "reason")
    return rejected.unionByName(run["failed"].select("file_id", F.lit("failed").alias("outcome"), F.lit("").alias("reason")))


# ---- archive records and ingest --------------------------------------------------------
@CATALOG.add("archive_payloads", """
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN NULL ELSE sha256(html) END AS payload FROM pages""")
def archive_payloads(spark, d):
    def run(batches):
        for b in batches:
            records = []
            for i, html in zip(b.page_id, b.html):
                raw = b"WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\nX: y" + (b"" if i % 14 == 0 else b"\r\n\r\n")
                raw += b"" if i % 7 == 0 else html.encode()
                records.append(gzip.compress(raw) if i % 2 else raw)
            yield pd.DataFrame({"page_id": b.page_id, "record": records})

    stored = table(spark, d, "pages").select("page_id", "html").mapInPandas(run, "page_id bigint, record binary")
    return stored.select("page_id", F.sha2(decks.archive_payload(F.col("record")), 256).alias("payload"))


@CATALOG.add("archive_records", """
SELECT CAST(page_id AS VARCHAR) AS record_id, url, CASE WHEN html <> '' THEN sha256(html) END AS by_scan, CASE WHEN html <> '' THEN sha256(html) END AS by_index,
       CAST(1 AS BIGINT) AS times
FROM pages""")
def archive_records(spark, d):
    """Every page as a response record of an archive file, half of them chunked, read back by scan and by index."""
    path = scratch_path(spark, "archive")
    rows = table(spark, d, "pages").select(
        F.col("page_id").cast("string").alias("record_id"), "url", F.lit("2024-01-01T00:00:00Z").alias("archived_at"), F.lit("text/html").alias("mime"),
        F.encode("html", "UTF-8").alias("payload"), (F.col("page_id") % 2 == 0).alias("chunked"))
    archives.write(scale.spread(rows, ["record_id"]), path)
    digest = F.sha2("payload", 256)
    scanned = archives.scan(spark, path).where(F.col("error") == "").groupBy("record_id", "url").agg(F.max(digest).alias("by_scan"), F.count("*").alias("times"))
    fetched = archives.read_index(archives.index(spark, path), path).where(F.col("error") == "").select("record_id", digest.alias("by_index"))
    return scanned.join(fetched, "record_id").select("record_id", "url", "by_scan", "by_index", "times")


_WORDS = ["/fr/", "tiontion"]
_INGEST = f"""c AS (SELECT page_id, url, CASE WHEN page_id % 16 = 0 THEN '' ELSE 'w' END AS filename, strlen(html) AS size, sha256(html) AS h,
    page_id % 9 <> 0 AS magic, page_id % 12 = 5 AS lost, len(regexp_extract_all(html, '[éèê]')) AS dense FROM pages),
j AS (SELECT *, CASE WHEN filename = '' THEN 'incomplete' WHEN page_id % 8 = 3 THEN 'dup' WHEN {sql_any('lower(url)', _WORDS)} THEN 'blocked'
    WHEN page_id % 3 = 0 AND size < 4000 THEN 'small' WHEN lost THEN 'error' WHEN size < 4000 THEN 'small'
    WHEN h IN (SELECT sha256(html) FROM pages WHERE page_id % 20 = 1) THEN 'dup' WHEN NOT magic THEN 'invalid' WHEN dense > 300 THEN 'china' END AS r FROM c),
x AS (SELECT *, CASE WHEN r IS NOT NULL THEN r WHEN row_number() OVER (PARTITION BY r IS NULL, h ORDER BY page_id) > 1 THEN 'dup' END AS reason FROM j),
y AS (SELECT page_id, CASE WHEN reason IS NULL AND count(CASE WHEN reason IS NULL THEN 1 END) OVER (ORDER BY page_id) > 30 THEN 'beyond_target' ELSE reason END AS reason FROM x)"""


def ingested(spark, d):
    i = F.col("page_id")
    h = F.sha2("html", 256)
    p = table(spark, d, "pages")
    c = p.select("page_id", "url", F.when(i % 16 == 0, "").otherwise("w").alias("filename"), F.octet_length("html").alias("length"),
                 F.when(i % 3 == 0, F.octet_length("html").cast("string")).otherwise("?").alias("declared_length"),
                 F.when(i % 12 != 5, F.octet_length("html")).alias("file_size"), (i % 9 != 0).alias("magic_ok"), h.alias("file_hash"), F.array("html").alias("parts"))
    from deckmill.functions import urls

    seen = p.where(i % 8 == 3).select(urls.url_tag(F.col("url")).alias("tag"))
    known = p.where(i % 20 == 1).select(h.alias("file_hash"))
    route = ingest.IngestRoute(floor=4000, blocked_words=_WORDS, cjk_pattern="[éèê]", cjk_limit=300)
    return ingest.ingest(c, seen, known, route, ["page_id"], target=30)


@CATALOG.add("ingest_funnel", f"WITH {_INGEST} SELECT page_id, reason FROM y")
def ingest_funnel(spark, d):
    return ingested(spark, d).select("page_id", "reason")


@CATALOG.add("ingest_ledgers", f"WITH {_INGEST} SELECT substr(sha1(p.url), 1, 10) AS tag FROM y JOIN pages p USING (page_id) WHERE reason IS NULL")
def ingest_ledgers(spark, d):
    path = scratch_path(spark, "tags")
    tags, _ = ingest.ledger_rows(ingested(spark, d))
    sinks.append_ledger(tags, path, ["tag"])
    return spark.read.schema("tag string").parquet(path)


_DATASET = f"""c AS (SELECT page_id, strlen(html) AS size, substr(sha1(html), 1, 10) AS tag, sha256(html) AS h, {sql_any('lower(url)', _WORDS)} AS blocked,
    page_id % 9 <> 0 AS magic FROM pages),
k AS (SELECT *, CASE WHEN blocked THEN 'blocked' WHEN tag IN (SELECT tag FROM c WHERE page_id % 40 = 3) THEN 'dup' WHEN size < 4000 THEN 'small'
    WHEN h IN (SELECT h FROM c WHERE page_id % 20 = 1) THEN 'dup' WHEN NOT magic THEN 'invalid' END AS r FROM c),
f AS (SELECT tag, min(page_id) AS first FROM k WHERE r IS NULL GROUP BY tag)"""


@CATALOG.add("ingest_dataset_route", f"""WITH {_DATASET}
SELECT page_id, CASE WHEN page_id > first AND coalesce(r, '') <> 'blocked' THEN 'dup' ELSE r END AS reason FROM k LEFT JOIN f USING (tag)""")
def ingest_dataset_route(spark, d):
    tag = F.substring(F.sha1(F.encode("html", "UTF-8")), 1, 10)
    p = table(spark, d, "pages").select("page_id", "url", F.col("url").alias("title"), F.lit("").alias("category"), tag.alias("tag"),
                                        F.lit("").alias("declared_length"), F.octet_length("html").alias("file_size"),
                                        (F.col("page_id") % 9 != 0).alias("magic_ok"), F.sha2("html", 256).alias("file_hash"), F.array("url").alias("parts"))
    route = ingest.IngestRoute(floor=4000, blocked_words=_WORDS, text_columns=("title", "category"), required=(), topic_terms=("no such", "of these", "terms"), tag="tag")
    seen = p.where(F.col("page_id") % 40 == 3).select("tag")
    known = p.where(F.col("page_id") % 20 == 1).select("file_hash")
    return ingest.ingest(p, seen, known, route, ["page_id"]).select("page_id", "reason")


@CATALOG.add("ingest_catalogue_route", f"""
SELECT page_id, CASE WHEN {sql_under("lower(split_part(url, '/', 3))", ['cheap-pills.example.com'])} OR ends_with(lower(split_part(url, '/', 3)), '.example.net') THEN 'blocked'
  WHEN strlen(html) < 15360 THEN 'small' WHEN page_id % 9 = 0 THEN 'invalid' WHEN page_id % 20 = 1 THEN 'dup' END AS reason FROM pages""")
def ingest_catalogue_route(spark, d):
    p = table(spark, d, "pages").select("page_id", "url", F.lit("0").alias("declared_length"), F.octet_length("html").alias("file_size"),
                                        (F.col("page_id") % 9 != 0).alias("magic_ok"), F.sha2("url", 256).alias("file_hash"), F.array("url").alias("parts"))
    rules = DomainPolicy(pirate=("cheap-pills.example.com",), tld=(".example.net",))
    known = p.where(F.col("page_id") % 20 == 1).select("file_hash")
    none = p.where(F.lit(False)).select(F.col("url").alias("tag"))
    return ingest.ingest(p, none, known, ingest.catalogue_route(rules), ["page_id"]).select("page_id", "reason")


_TOPIC = ("tiontion", "ing", "ouqu", "erung", "schaft", "ción")
_CONTENT = f"""c AS (SELECT page_id, url, html, strlen(html) AS size, sha256(html) AS h, substr(sha1(html), 1, 10) AS tag, {sql_any('lower(url)', _WORDS)} AS words,
    page_id % 9 <> 0 AS magic, len(regexp_extract_all(html, '[éèê]')) > 300 AS dense, {sql_count('lower(html)', _TOPIC)} >= 3 AS topical FROM pages)"""


@CATALOG.add("ingest_dataset_contents", f"""WITH {_CONTENT},
k AS (SELECT *, CASE WHEN words THEN 'blocked' WHEN tag IN (SELECT tag FROM c WHERE page_id % 40 = 3) THEN 'dup' WHEN size < 4000 THEN 'small'
    WHEN h IN (SELECT h FROM c WHERE page_id % 20 = 1) THEN 'dup' WHEN NOT magic THEN 'invalid' WHEN dense THEN 'china' WHEN topical THEN 'blocked' END AS r FROM c),
f AS (SELECT tag, min(page_id) AS first FROM k WHERE r IS NULL GROUP BY tag)
SELECT page_id, CASE WHEN page_id > first AND coalesce(r, '') <> 'blocked' THEN 'dup' ELSE r END AS reason FROM k LEFT JOIN f USING (tag)""")
def ingest_dataset_contents(spark, d):
    """The dataset route over whole pages: contents are tagged, digested and screened for script and topic."""
    p = _contents(spark, d).withColumn("tag", F.substring(F.sha1(F.encode("html", "UTF-8")), 1, 10)).drop("html")
    route = ingest.IngestRoute(floor=4000, blocked_words=_WORDS, text_columns=("title", "category"), required=(), topic_terms=_TOPIC, tag="tag",
                               cjk_pattern="[éèê]", cjk_limit=300)
    seen = p.where(F.col("page_id") % 40 == 3).select("tag")
    known = p.where(F.col("page_id") % 20 == 1).select("file_hash")
    return ingest.ingest(p, seen, known, route, ["page_id"]).select("page_id", "reason")


@CATALOG.add("ingest_catalogue_contents", f"""WITH {_CONTENT},
k AS (SELECT *, CASE WHEN {sql_under("lower(split_part(url, '/', 3))", ['cheap-pills.example.com'])} OR ends_with(lower(split_part(url, '/', 3)), '.example.net') THEN 'blocked'
  WHEN size < 4000 THEN 'small' WHEN NOT magic THEN 'invalid' WHEN h IN (SELECT h FROM c WHERE page_id % 20 = 1) THEN 'dup' WHEN dense THEN 'china' END AS r FROM c)
SELECT page_id, CASE WHEN r IS NULL AND row_number() OVER (PARTITION BY r IS NULL, h ORDER BY page_id) > 1 THEN 'dup' ELSE r END AS reason FROM k""")
def ingest_catalogue_contents(spark, d):
    """The catalogue route over whole pages: equal contents count once, whatever their address."""
    p = _contents(spark, d).drop("html")
    rules = DomainPolicy(pirate=("cheap-pills.example.com",), tld=(".example.net",))
    route = replace(ingest.catalogue_route(rules), floor=4000, cjk_pattern="[éèê]", cjk_limit=300)
    known = p.where(F.col("page_id") % 20 == 1).select("file_hash")
    none = p.where(F.lit(False)).select(F.col("url").alias("tag"))
    return ingest.ingest(p, none, known, route, ["page_id"]).select("page_id", "reason")


def _contents(spark, d):
    return table(spark, d, "pages").select("page_id", "url", "html", F.col("url").alias("title"), F.lit("").alias("category"), F.lit("").alias("declared_length"),
                                           F.octet_length("html").alias("file_size"), (F.col("page_id") % 9 != 0).alias("magic_ok"),
                                           F.sha2("html", 256).alias("file_hash"), F.array("html").alias("parts"))
