"""Readers of sidecars, indexes, ledgers, policies, logs and XML feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deckmill import fixed_values as fv
from deckmill.functions import names, urls
from deckmill.functions import text as tx
from deckmill.operators import scale

METADATA_FIELDS = [
    "source_url", "source_domain", "download_url", "original_filename", "collection_timestamp",
    "download_timestamp", "publication_date", "author_info", "organization_name", "document_title",
    "language", "file_format", "scraper_source", "search_query", "api_record_id", "batch_id",
    "quality_classification", "delivery_status", "file_hash",
]
METADATA_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in METADATA_FIELDS]
    + [T.StructField("file_size", T.LongType()), T.StructField("slide_count", T.IntegerType()),
       T.StructField("tags_categories", T.ArrayType(T.StringType())),
       T.StructField("extra", T.MapType(T.StringType(), T.StringType()))])

CATALOGUE_SIDECAR_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "source_url", "original_filename", "source_domain", "collection_timestamp", "publication_date",
        "author", "organization", "title", "language")]
    + [T.StructField("tags", T.ArrayType(T.StringType())),
       T.StructField("crawl_metadata", T.StructType([T.StructField(c, T.StringType()) for c in (
           "source", "portal_name", "portal_base_url", "package_id", "package_title", "resource_id",
           "license_title", "declared_format")]))])

CRAWL_INDEX_SCHEMA = ("url string, mime string, `mime-detected` string, filename string, "
                      "offset string, length string, _crawl string")


def sidecars(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = METADATA_SCHEMA,
             lines: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """Metadata sidecars with the path they belong to.

    Unknown keys are dropped. A corrupt file is left out, or kept as a row of
    nulls. ``deck_path_a`` and ``deck_stem_b`` are the join keys of
    ``foo.pptx.meta.json`` and of ``foo.meta.json``.
    """
    reader = spark.read.schema(schema).option("multiLine", str(not lines).lower())
    raw = reader.option("mode", "PERMISSIVE" if keep_corrupt else "DROPMALFORMED").json(paths)
    found = scale.gathered(raw.select("*", plain_path(F.col("_metadata.file_path")).alias("sidecar_path")))
    base = F.regexp_replace("sidecar_path", r"\.meta\.json$", "")
    return found.withColumn("deck_path_a", base).withColumn("deck_stem_b", base)


def plain_path(path: Column) -> Column:
    """One spelling of a path: metadata columns escape it and write ``file:///`` where file sources write ``file:/``."""
    opened = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.regexp_replace(F.when(F.contains(path, F.lit("%")), opened).otherwise(path), "^file:/+", "file:/")


def with_sidecars(files: DataFrame, cards: DataFrame, path: str = "path", how: str = "left") -> DataFrame:
    """Join files with sidecars under both naming conventions; the full name wins.

    Paths are unique on both sides, so the join is even.
    """
    body = [c for c in cards.columns if c not in ("sidecar_path", "deck_path_a", "deck_stem_b")]
    packed = cards.select(F.col("deck_path_a").alias("__key"), F.struct(*body).alias("__card"))
    a = packed.select(F.col("__key").alias("__a"), F.col("__card").alias("__card_a"))
    b = packed.select(F.col("__key").alias("__b"), F.col("__card").alias("__card_b"))
    full = F.regexp_replace(F.col(path), "^file:/+", "file:/")
    stem = F.regexp_replace("__full", r"\.[^./]+$", "")
    both = (files.withColumn("__full", full).withColumn("__stem", stem).join(a, F.col("__full") == F.col("__a"), "left")
            .join(b, F.col("__stem") == F.col("__b"), "left")
            .withColumn("sidecar", F.coalesce("__card_a", "__card_b"))
            .select(*files.columns, "sidecar"))
    return both.where(F.col("sidecar").isNotNull()) if how == "inner" else both


def crawl_index(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JSON-lines index; bad and blank lines are skipped, numbers stay text until cast."""
    raw = spark.read.schema(CRAWL_INDEX_SCHEMA).option("mode", "DROPMALFORMED").json(paths)
    return typed_index(raw)


def typed_index(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"offset": F.coalesce(F.col("offset").try_cast("bigint"), F.lit(0)),
                            "length": F.coalesce(F.col("length").try_cast("bigint"), F.lit(0))})


def promote_header(payloads: DataFrame, payload: str, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``[[header], [row], …]`` payloads to one row per data row.

    Fields are looked up by header name, so their order may differ by payload.
    """
    table = F.from_json(F.col(payload), "array<array<string>>")
    rows = (payloads.select(*keep, table.alias("__t")).where(F.size("__t") > 1)
            .select(*keep, F.get("__t", F.lit(0)).alias("__h"),
                    F.explode(F.slice("__t", 2, 2147483647)).alias("__r")))
    pairs = F.map_from_arrays(F.slice("__h", F.lit(1), F.least(F.size("__h"), F.size("__r"))),
                              F.slice("__r", F.lit(1), F.least(F.size("__h"), F.size("__r"))))
    return rows.withColumn("__m", pairs).select(*keep, *[F.try_element_at("__m", F.lit(f)).alias(f) for f in fields])


def _pick(columns: Sequence[str], options: Sequence[str], default: Column) -> Column:
    """First option that holds something, compared by exact column name."""
    held = [F.when(~F.col(f"`{o}`").cast("string").isin("", "0"), F.col(f"`{o}`").cast("string"))
            for o in options if o in columns]
    return F.coalesce(*held, default)


def with_record_columns(df: DataFrame, row_index: Column) -> DataFrame:
    """Flexible ``id``, ``title`` and ``category`` columns of a dataset shard."""
    return df.withColumns({
        "record_id": _pick(df.columns, ["id", "ID", "file_id"], row_index.cast("string")),
        "record_title": _pick(df.columns, ["title", "Title"], F.lit("untitled")),
        "record_category": _pick(df.columns, ["category", "Category"], F.lit("")),
    })


def dataset_shards(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet shards with flexible columns; a row without id takes its place in the file."""
    raw = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    placed = raw.select("*", F.col("_metadata.row_index").alias("row_index"))
    return with_record_columns(placed, F.col("row_index"))


def binary_column(df: DataFrame, min_bytes: int = 1000) -> str | None:
    """Name of the first column that holds a payload in any row. One aggregate over lengths; the rule looked at one row, but
    a null or short first payload says nothing about the others."""
    candidates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)]
    if not candidates:
        return None
    longest = df.agg(*[F.max(F.octet_length(f"`{c}`")).alias(c) for c in candidates]).first()
    return next((c for c in candidates if (longest[c] or 0) > min_bytes), None)


def ledger_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.text(paths)


def ledger(lines: DataFrame, name: str = "tag", value: str = "value") -> DataFrame:
    """Distinct trimmed non-empty lines."""
    return lines.select(tx.strip(F.col(value)).alias(name)).where(F.length(name) > 0).distinct()


def policy_lists(spark: SparkSession, path: str, keys: dict[str, str]) -> DataFrame:
    """``(rule, value)`` rows of one JSON policy file.

    ``keys`` maps a JSON key to its rule. A missing or corrupt file and a
    missing key give no rows, whereupon the built-in defaults apply.
    """
    schema = T.StructType([T.StructField(k, T.ArrayType(T.StringType())) for k in keys])
    raw = (spark.read.schema(schema).option("multiLine", "true").option("mode", "DROPMALFORMED")
           .option("ignoreMissingFiles", "true"))
    parts = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(k).alias("entries")) for k, rule in keys.items()])
    try:
        loaded = raw.json(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "rule string, value string")
    return (loaded.select(F.inline(parts)).select("rule", F.explode("entries").alias("value"))
            .select("rule", F.lower("value").alias("value")).distinct())


def split_rename_lines(lines: DataFrame, line_no: Column) -> DataFrame:
    """``new | old`` lines; lines without two parts are no mapping."""
    parts = F.split(F.col("value"), r"\|")
    return (lines.withColumn("line_no", line_no).withColumn("__p", parts).where(F.size("__p") > 1)
            .select("line_no", tx.strip(F.get("__p", F.lit(0))).alias("new_name"),
                    tx.strip(F.get("__p", F.lit(1))).alias("old_name")))


def rename_log(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"))
    place = F.struct("__f", "__b", F.monotonically_increasing_id().alias("__i"))
    return split_rename_lines(lines, place)


def seed_list(lines: DataFrame) -> DataFrame:
    """Portal seeds: blanks and comments skipped, the value is name and address."""
    value = tx.strip(F.col("value"))
    return lines.select(value.alias("name")).where((F.col("name") != "") & ~F.startswith("name", F.lit("#"))).withColumn(
        "base_url", F.col("name"))


def frontier_seed(spark: SparkSession, path: str) -> DataFrame:
    """Country, kind (topic, domain, broad) and value of the query frontier."""
    return spark.read.schema("country string, kind string, value string").option("header", "true").csv(path)


def documents_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Whole small responses, one per row."""
    return spark.read.text(paths, wholetext=True)


def harvest_links(responses: DataFrame, xml: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Deck links of harvest responses.

    Any text of a record's metadata counts: an http address with a deck suffix
    before its query, or one with ``/bitstream/`` and a deck suffix anywhere.
    A malformed response yields nothing.
    """
    checked = responses.select(*keep, F.col(xml).alias("__xml")).withColumn(
        "__parsed", F.from_xml(F.col("__xml"), "__any string, _corrupt_record string"))
    well_formed = F.col("__parsed._corrupt_record").isNull() & F.col("__parsed").isNotNull()
    nodes = F.xpath("__xml", F.lit(
        "//*[local-name()='record']//*[local-name()='metadata']//text()"))
    texts = checked.select(*keep, F.explode(F.when(well_formed, nodes)).alias("__t")).select(
        *keep, tx.strip(F.col("__t")).alias("link"))
    return texts.where(is_harvest_link(F.col("link")))


def harvest_dump_links(spark: SparkSession, paths: str | Sequence[str], record: str = "record") -> DataFrame:
    """Deck links of harvest dumps of any size: files are split by records, so no task holds a whole response.

    A malformed record is dropped, and the others of its file stay. Prefixes may be declared above the record.
    """
    ends = spark.read.option("lineSep", f"</{record}>").text(paths)
    # A character that no XML text holds marks where records open, as other elements may begin with the same letters.
    opened = F.regexp_replace("value", rf"<{record}(?=[\s>])", "\u0001")
    records = ends.select(opened.alias("value")).where(F.contains("value", F.lit("\u0001")))
    whole = F.concat(F.lit(f"<{record}"), F.substring_index("value", "\u0001", -1), F.lit(f"</{record}>"))
    return harvest_links(records.select(whole.alias("value")))


def is_harvest_link(text: Column) -> Column:
    low = F.lower(text)
    suffix = urls.ends_with_any(urls.without_query(low), fv.SHOW_SUFFIXES)
    bitstream = F.contains(text, F.lit("/bitstream/")) & (
        F.contains(low, F.lit(".ppt")) | F.contains(low, F.lit(".pptx")))
    return F.startswith(text, F.lit("http")) & (suffix | bitstream)


def sitemap_index(spark: SparkSession, path: str, marker: str = "docs-") -> DataFrame:
    """Child sitemaps that list documents."""
    rows = spark.read.format("xml").option("rowTag", "sitemap").schema("loc string").load(path)
    return rows.where(F.contains("loc", F.lit(marker)))


def sitemap_urls(spark: SparkSession, paths: str) -> DataFrame:
    """Page addresses of plain or gzip sitemaps."""
    return spark.read.format("xml").option("rowTag", "url").schema("loc string").load(paths).where(
        F.col("loc").isNotNull()).select(F.col("loc").alias("url"))
