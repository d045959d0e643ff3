"""Nested files of harvest records to one row per deck."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.functions import text as tx
from deckmill.functions import urls
from deckmill.operators import integrity, scale

_LINKED = "struct<key:string,links:struct<self:string,content:string>>"


def _is_deck(name: Column) -> Column:
    return urls.ends_with_any(F.lower(name), fv.DECK_SUFFIXES)


def _text_or_list(json: Column) -> Column:
    """A scalar or a list field as a list of texts."""
    return (F.when(json.isNull(), F.array().cast("array<string>"))
            .when(F.startswith(json, F.lit("[")), F.from_json(json, "array<string>"))
            .otherwise(F.array(json)))


def repository_files(records: DataFrame, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """Deck files of repository records whose ``files`` is a list, or holds entries as a map or list."""
    r = F.col(record)
    entries = F.get_json_object(r, "$.files.entries")
    named = F.map_entries(F.from_json(entries, f"map<string,{_LINKED}>"))
    by_name = F.transform(named, lambda e: F.struct(
        F.coalesce(e["value"]["key"], e["key"]).alias("key"), e["value"]["links"].alias("links")))
    listed = F.from_json(F.when(F.startswith(F.get_json_object(r, "$.files"), F.lit("[")), F.get_json_object(r, "$.files"))
                         .otherwise(F.when(F.startswith(entries, F.lit("[")), entries)), f"array<{_LINKED}>")
    numbered = F.transform(listed, lambda e, i: F.struct(
        F.coalesce(e["key"], F.when(entries.isNotNull(), i.cast("string")).otherwise("")).alias("key"), e["links"].alias("links")))
    every = records.select(*keep, F.get_json_object(r, "$.id").alias("record_id"),
                           F.coalesce(F.get_json_object(r, "$.metadata.title"), F.lit("untitled")).alias("title"),
                           F.explode(F.coalesce(numbered, by_name)).alias("f"))
    own = F.coalesce(F.col("f.links.self"), F.lit(""))
    url = (F.when((own != "") & ~F.endswith(own, F.lit("/content")), F.concat(own, F.lit("/content")))
           .when(own != "", own).otherwise(F.col("f.links.content")))
    return (every.select(*keep, "record_id", "title", F.col("f.key").alias("filename"), url.alias("url"))
            .where(_is_deck(F.col("filename")) & (F.coalesce(F.col("url"), F.lit("")) != "")))


def paper_files(records: DataFrame, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """Records with a scalar or list title and file address."""
    r = F.col(record)
    titles = _text_or_list(F.get_json_object(r, "$.title_s"))
    title = F.substring(F.coalesce(F.nullif(F.get(titles, F.lit(0)), F.lit("")), F.lit("untitled")), 1, 200)
    rows = records.select(*keep, F.coalesce(F.get_json_object(r, "$.halId_s"), F.lit("")).alias("hal_id"), title.alias("title"),
                          F.explode(_text_or_list(F.get_json_object(r, "$.files_s"))).alias("url"))
    return rows.where(urls.ends_with_deck_suffix(F.col("url"), fv.DECK_SUFFIXES)).withColumn(
        "ext", urls.deck_extension(F.col("url"), unquote=True))


def article_files(records: DataFrame, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """Articles with their file list."""
    r = F.col(record)
    rows = records.select(*keep, F.get_json_object(r, "$.id").alias("article_id"),
                          F.coalesce(F.get_json_object(r, "$.title"), F.lit("untitled")).alias("title"),
                          F.inline(F.from_json(F.get_json_object(r, "$.files"), "array<struct<name:string,download_url:string>>")))
    return (rows.where(_is_deck(F.coalesce("name", F.lit(""))) & (F.coalesce("download_url", F.lit("")) != ""))
            .withColumnsRenamed({"name": "filename", "download_url": "url"}))


def quote_path(name: Column) -> Column:
    """Percent-encoding of everything but letters, digits and ``_.-~``."""
    out = F.url_encode(name)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def item_files(records: DataFrame, record: str = "record", keep: Sequence[str] = (),
               skip: DataFrame | None = None, file_sources: Sequence[str] | None = None) -> DataFrame:
    """Archive items with files; ``skip`` lists identifiers done before.

    ``file_sources`` keeps only files of the given kinds and also reports their size.
    """
    r = F.col(record)
    rows = records.withColumn("identifier", F.get_json_object(r, "$.identifier")).where(F.col("identifier").isNotNull())
    if skip is not None:
        rows = rows.join(scale.broadcast_if_small(skip.select("identifier").distinct()), "identifier", "left_anti")
    titles = _text_or_list(F.get_json_object(r, "$.metadata.title"))
    title = F.substring(F.coalesce(F.get(titles, F.lit(0)), F.col("identifier")), 1, 200)
    files = rows.select(*keep, "identifier", title.alias("title"), F.inline(F.from_json(
        F.get_json_object(r, "$.files"), "array<struct<name:string,size:string,source:string>>")))
    decks = files.where(_is_deck(F.coalesce("name", F.lit(""))))
    if file_sources is not None:
        decks = decks.where(F.col("source").isin(list(file_sources)))
    return decks.select(*keep, "identifier", "title", F.col("name").alias("filename"),
                        F.coalesce(F.col("size").try_cast("bigint"), F.lit(0)).alias("declared_size"),
                        F.concat(F.lit("https://archive.org/download/"), "identifier", F.lit("/"), quote_path(F.col("name"))).alias("url"))


def datafile_rows(records: DataFrame, record: str = "record", instance: str = "instance", keep: Sequence[str] = ()) -> DataFrame:
    """Search hits that are files of a data repository instance."""
    r = F.col(record)
    name = F.coalesce(F.get_json_object(r, "$.name"), F.lit("file.pptx"))
    rows = records.select(*keep, instance, F.get_json_object(r, "$.file_id").alias("file_id"), name.alias("filename"),
                          F.coalesce(F.get_json_object(r, "$.description"), F.get_json_object(r, "$.dataset_name"), name).alias("title"))
    return rows.where(~F.coalesce("file_id", F.lit("")).isin("", "0") & _is_deck(F.col("filename"))).withColumn(
        "url", F.concat(F.col(instance), F.lit("/api/access/datafile/"), F.col("file_id")))


def code_files(records: DataFrame, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """Code-search hits; the page address becomes the raw one."""
    r = F.col(record)
    rows = records.select(*keep, F.get_json_object(r, "$.repository.full_name").alias("repo"),
                          F.get_json_object(r, "$.path").alias("path"), F.get_json_object(r, "$.html_url").alias("page"))
    held = rows.where((F.coalesce("repo", F.lit("")) != "") & (F.coalesce("path", F.lit("")) != "") & (F.coalesce("page", F.lit("")) != ""))
    return held.select(*keep, "repo", F.substring_index("path", "/", -1).alias("filename"),
                       urls.raw_code_host_url(F.col("page")).alias("url"))


def work_links(records: DataFrame, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """Direct address, or the first link of type download."""
    r = F.col(record)
    links = F.from_json(F.get_json_object(r, "$.links"), "array<struct<type:string,url:string>>")
    linked = F.get(F.filter(links, lambda x: x["type"] == "download"), F.lit(0))["url"]
    url = F.coalesce(F.nullif(F.get_json_object(r, "$.downloadUrl"), F.lit("")), linked)
    rows = records.select(*keep, F.get_json_object(r, "$.id").alias("id"),
                          F.coalesce(F.get_json_object(r, "$.title"), F.lit("core_file")).alias("filename"), url.alias("url"))
    return rows.where(F.coalesce("url", F.lit("")) != "")


CATALOGUE_PACKAGE = """struct<id:string,title:string,author:string,license_title:string,metadata_created:string,
metadata_modified:string,organization:struct<title:string,name:string>,tags:array<struct<name:string>>,
resources:array<struct<id:string,url:string,format:string,name:string,description:string>>>"""


def catalogue_resources(packages: DataFrame, package: str = "package", portal_name: str = "portal_name",
                        portal_url: str = "portal_base_url", keep: Sequence[str] = (),
                        suffixes: Sequence[str] = tuple(fv.DECK_SUFFIXES)) -> DataFrame:
    """Deck resources of catalogue packages, host-relative addresses resolved against the portal."""
    p = F.from_json(F.col(package), CATALOGUE_PACKAGE)
    rows = packages.select(*keep, portal_name, portal_url, p.alias("p")).withColumn("r", F.explode("p.resources"))

    def held(*columns: str) -> Column:
        return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns], F.lit(""))
    given = tx.strip(F.coalesce("r.url", F.lit("")))
    full = F.when(urls.authority(given) != "", given).otherwise(
        urls.resolve_url(F.concat(F.col(portal_url), F.lit("/")), given))
    tags = F.filter(F.transform(F.coalesce("p.tags", F.array().cast("array<struct<name:string>>")), lambda t: t["name"]),
                    lambda t: t.isNotNull() & (t != ""))
    out = rows.where(given != "").select(
        *keep, full.alias("url"), F.coalesce("r.format", F.lit("")).alias("format"), held("r.name", "r.description").alias("resource_name"),
        F.coalesce("r.id", F.lit("")).alias("resource_id"), F.coalesce("p.id", F.lit("")).alias("package_id"),
        F.coalesce("p.title", F.lit("untitled")).alias("package_title"),
        held("p.organization.title", "p.organization.name").alias("organization"),
        held("p.author", "p.organization.title").alias("author"), F.coalesce("p.license_title", F.lit("")).alias("license_title"),
        tags.alias("tags"), F.coalesce("p.metadata_created", F.lit("")).alias("metadata_created"),
        F.coalesce("p.metadata_modified", F.lit("")).alias("metadata_modified"), portal_name, portal_url)
    return out.where(integrity.is_deck_resource(F.col("url"), F.col("format"), suffixes))


def once_per_entity(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Harvest rows without repeats of the same entity."""
    return df.dropDuplicates(list(keys))
