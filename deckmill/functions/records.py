"""Canonical metadata from records of differing shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.functions import names, urls

EMPTY_JSON = ['""', "0", "0.0", "false", "[]", "{}", "null"]


def fields(record: Column) -> Column:
    """Top-level fields of a JSON record as text, parsed once."""
    return F.from_json(record, "map<string,string>")


def typed_fields(record: Column) -> Column:
    """Top-level fields as JSON text, so that ``"0"`` and ``0`` differ."""
    return F.transform_values(F.from_json(record, "map<string,variant>"), lambda k, v: F.to_json(v))


def first_present(values: Column, keys: Sequence[str], default: Column | str = "") -> Column:
    """Value of the first key that exists, even when that value is empty."""
    out = None
    for key in keys:
        got = F.coalesce(F.try_element_at(values, F.lit(key)), F.lit(""))
        hit = F.map_contains_key(values, F.lit(key))
        out = F.when(hit, got) if out is None else out.when(hit, got)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def as_tags(json_text: Column) -> Column:
    """List to strings, string to a one-item list, anything else to an empty list."""
    return (F.when(F.startswith(json_text, F.lit("[")), F.from_json(json_text, "array<string>"))
            .when(F.startswith(json_text, F.lit('"')), F.from_json(F.concat(F.lit("["), json_text, F.lit("]")), "array<string>"))
            .otherwise(F.array().cast("array<string>")))


def residual(typed: Column, known: Sequence[str] = tuple(fv.KNOWN_RECORD_KEYS)) -> Column:
    """Fields outside the known ones that hold something."""
    return F.map_filter(typed, lambda k, v: ~k.isin(list(known)) & v.isNotNull() & ~v.isin(EMPTY_JSON))


def metadata_from_record(record: Column, source: Column, download_url: Column, filename: Column, now: Column) -> dict[str, Column]:
    """Metadata columns of one API record (JSON text)."""
    f, typed = fields(record), typed_fields(record)
    tags = first_present(typed, fv.TAG_KEYS, "[]")
    return {
        "source_url": first_present(f, ["source_url", "url"], download_url),
        "source_domain": urls.authority(download_url),
        "download_url": download_url,
        "original_filename": filename,
        "collection_timestamp": now,
        "download_timestamp": now,
        "publication_date": first_present(f, ["publication_date", "published_date"]),
        "author_info": first_present(f, ["author_info", "authors"]),
        "organization_name": first_present(f, ["organization_name", "publisher"]),
        "document_title": first_present(f, ["title", "document_title"]),
        "language": first_present(f, ["language"]),
        "file_format": F.upper(F.ltrim(names.suffix(filename), F.lit("."))),
        "tags_categories": as_tags(tags),
        "scraper_source": source,
        "search_query": first_present(f, ["query"]),
        "api_record_id": first_present(f, fv.RECORD_ID_KEYS),
        "extra": residual(typed),
    }


def catalogue_sidecar(url: Column, resource: dict[str, Column], filename: Column, now: Column) -> Column:
    """Sidecar struct of a catalogue resource."""
    def given(c: str) -> Column:
        return F.coalesce(resource.get(c, F.lit("")), F.lit(""))
    named = F.coalesce(F.nullif(urls.path_name(url), F.lit("")), filename)
    title = F.coalesce(F.nullif(given("resource_name"), F.lit("")), given("package_title"))
    crawl = ["portal_name", "portal_base_url", "package_id", "package_title", "resource_id", "license_title"]
    return F.struct(
        url.alias("source_url"), named.alias("original_filename"), urls.authority(url, lower=False).alias("source_domain"),
        now.alias("collection_timestamp"), given("metadata_created").alias("publication_date"), given("author").alias("author"),
        given("organization").alias("organization"), title.alias("title"), F.lit("").alias("language"),
        F.coalesce(resource["tags"], F.array().cast("array<string>")).alias("tags"),
        F.struct(F.lit("ckan").alias("source"), *[given(c).alias(c) for c in crawl],
                 given("format").alias("declared_format")).alias("crawl_metadata"))


def delivery_metadata(batch: str, now: Column) -> list[Column]:
    """Delivery record from ``name``, ``stem_id``, the sidecar struct and deck facts."""
    def card(c: str, default: str | Column = "") -> Column:
        return F.coalesce(F.col(f"sidecar.{c}"), default if isinstance(default, Column) else F.lit(default)).alias(c)
    name, url = F.col("name"), F.coalesce(F.col("sidecar.source_url"), F.lit(""))
    stem = names.stem(name)
    return [
        F.lit(batch).alias("batch_id"), F.substring_index(stem, "_", 1).alias("file_id"), F.col("dest_name").alias("filename"),
        card("original_filename", name), url.alias("source_url"), card("source_domain", urls.authority(url, lower=False)),
        url.alias("download_url"), card("collection_timestamp"), now.alias("download_timestamp"), card("publication_date"),
        card("author"), card("organization"), card("title"), card("language"),
        F.coalesce(F.col("sidecar.tags"), F.array().cast("array<string>")).alias("tags"),
        F.col("file_size"), F.ltrim(F.lower(names.suffix(name)), F.lit(".")).alias("file_format"), F.col("slide_count"),
        F.col("quality").alias("quality_classification"), F.col("analytical_pct"), F.col("charts").alias("chart_slides"),
        F.col("tables").alias("table_slides"), F.when(F.col("error") == "", "PASS").otherwise("FAIL").alias("file_integrity"),
        F.lit("PASS").alias("public_availability"), F.lit("PASS").alias("pirate_site_screening"),
        F.col("sidecar.crawl_metadata").alias("crawl_metadata"), F.col("sequence_number")]


def transfer_metadata(batch: str, now: Column) -> list[Column]:
    """Transfer record from the listing item and the deck's core properties."""
    name, url = F.col("name"), F.coalesce(F.col("found_url"), F.lit(""))
    ok = [F.lit("PASS").alias(c) for c in ("public_availability", "pirate_site_screening", "robots_access",
                                           "rights_review", "personal_data_screening")]
    return [
        F.lit(batch).alias("batch_id"), F.col("file_id").alias("source_file_id"), name.alias("filename"),
        name.alias("original_filename"), url.alias("source_url"), urls.authority(url, lower=False).alias("source_domain"),
        F.coalesce("view_link", F.lit("")).alias("download_url"), F.coalesce("created_time", F.lit("")).alias("collection_timestamp"),
        now.alias("download_timestamp"), F.col("created").alias("publication_date"), "author", "organization", "title", "subject",
        "keywords", F.lit("").alias("language"), F.coalesce(F.col("file_size").try_cast("bigint"), F.lit(0)).alias("file_size"),
        F.ltrim(F.lower(names.suffix(name)), F.lit(".")).alias("file_format"), "slide_count",
        F.col("quality").alias("quality_classification"), "analytical_pct", F.col("charts").alias("chart_slides"),
        F.col("tables").alias("table_slides"), F.coalesce("owner_email", F.lit("")).alias("original_owner"),
        F.when(F.col("error") == "", "PASS").otherwise("FAIL").alias("file_integrity"), *ok,
        F.col("dest_name").alias("upload_filename"), "sequence_number"]


def batch_sidecar(batch: str, now: Column, url: str = "source_url", name: str = "name", seq: str = "sequence_number",
                  dest: str = "dest_name", size: str = "file_size") -> list[Column]:
    """Sidecar fields of a file named into a batch."""
    ext = F.coalesce(F.nullif(F.lower(names.suffix(F.col(name))), F.lit("")), F.lit(".pptx"))
    return [F.lit(batch).alias("batch_id"), F.col(seq).alias("sequence_number"), F.col(dest).alias("filename"),
            F.col(name).alias("original_filename"), F.col(url).alias("source_url"),
            urls.authority(F.col(url), lower=False).alias("source_domain"), F.col(url).alias("download_url"),
            now.alias("collection_timestamp"), F.col(size).alias("file_size"), F.ltrim(ext, F.lit(".")).alias("file_format")]


def sidecar_json(columns: Sequence[str], texts: Sequence[str], lists: Sequence[str] = ()) -> Column:
    """Metadata as JSON without empty texts and lists; zero and false stay."""
    def shown(c: str) -> Column:
        if c in texts:
            return F.nullif(F.col(c), F.lit("")).alias(c)
        if c in lists:
            return F.when(F.size(c) > 0, F.col(c)).alias(c)
        return F.col(c).alias(c)
    return F.to_json(F.struct(*[shown(c) for c in columns]), {"ignoreNullFields": "true"})
