"""File-name, tag, date and numbering column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deckmill.functions.urls import deck_extension, path_name, url_tag

# Word characters are Unicode letters, digits and the underscore.
NOT_WORD = r"[^\p{L}\p{N}_]"
NOT_WORD_OR_DASH = r"[^\p{L}\p{N}_\-]"
NOT_WORD_DOT_DASH = r"[^\p{L}\p{N}_.\-]"


def suffix(name: Column) -> Column:
    """Last extension with its dot; empty for none, for dot files and a final dot."""
    return F.regexp_extract(name, r"(?s)^.+(\.[^.]+)$", 1)


def stem(name: Column) -> Column:
    return F.left(name, F.length(name) - F.length(suffix(name)))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_name(path: Column) -> Column:
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def file_name_tag(name: Column, length: int = 10) -> Column:
    return F.substring(F.sha1(F.encode(name, "UTF-8")), 1, length)


def head_bytes_tag(content: Column, head: int = 1000, length: int = 10) -> Column:
    return F.substring(F.sha1(F.substring(content, 1, head)), 1, length)


def content_tag(content: Column, length: int = 12) -> Column:
    return F.substring(F.sha1(content), 1, length)


def content_sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def content_md5(content: Column) -> Column:
    return F.md5(content)


def tag_of_name(name: Column, length: int = 10) -> Column:
    """Tag in front of the first underscore; null unless it has the full length."""
    tag = F.substring_index(name, "_", 1)
    return F.when(F.length(tag) == length, tag)


def _has_deck_suffix(name: Column) -> Column:
    low = F.lower(name)
    return F.endswith(low, F.lit(".pptx")) | F.endswith(low, F.lit(".ppt"))


def tagged_name(url: Column, require_suffix: bool) -> Column:
    """``tag_name`` for a deck URL.

    A path that names no deck gives null with ``require_suffix``, else it
    gets ``.pptx`` appended. An empty path counts as ``file.pptx``.
    """
    name = F.coalesce(F.nullif(path_name(url), F.lit("")), F.lit("file.pptx"))
    if not require_suffix:
        name = F.when(_has_deck_suffix(name), name).otherwise(F.concat(name, F.lit(".pptx")))
    built = F.concat(url_tag(url), F.lit("_"), F.regexp_replace(name, NOT_WORD_DOT_DASH, "_"))
    return F.when(_has_deck_suffix(name), built) if require_suffix else built


def bulk_name(url: Column, prefix: str, width: int, extension: Column) -> Column:
    """``tag_prefix_slug.ext`` where the slug is cut to ``width`` characters first."""
    last = F.substring_index(url, "/", -1)
    slug = F.regexp_replace(F.substring(F.split_part(last, F.lit("?"), F.lit(1)), 1, width), NOT_WORD, "_")
    return F.concat(url_tag(url), F.lit(f"_{prefix}_"), slug, extension)


def title_slug(title: Column, width: int) -> Column:
    return F.regexp_replace(F.substring(title, 1, width), NOT_WORD_OR_DASH, "_")


def capped_name(name: Column, original: Column, cap: int = 200, keep: int = 190) -> Column:
    """Names above ``cap`` are cut to ``keep`` and get the original extension."""
    return F.when(F.length(name) > cap, F.concat(F.substring(name, 1, keep), suffix(original))).otherwise(name)


def legacy_safe_name(name: Column) -> Column:
    clean = F.regexp_replace(name, "[<>:\"/\\\\|?*\\x00-\\x1f]", "_")
    clean = F.regexp_replace(F.regexp_replace(clean, "_+", "_"), r"^[_. ]+|[_. ]+$", "")
    ext = F.lower(suffix(clean))
    return F.concat(F.substring(stem(clean), 1, 160),
                    F.when(ext.isin(".ppt", ".pptx"), ext).otherwise(F.lit(".pptx")))


def zero_padded(number: Column, width: int) -> Column:
    """Zero padding that never cuts a number wider than ``width``."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def batch_id(day: Column, number: Column) -> Column:
    return F.concat(F.lit("BATCH-"), F.date_format(day, "yyyyMMdd"), F.lit("-"), zero_padded(number, 3))


def normalised_member(xml: Column) -> Column:
    """Slide XML without the attributes that differ between downloads."""
    return F.regexp_replace(xml, r' (id|val|time)="[^"]*"', "")


def with_deck_suffix(name: Column, fallback: Column | str = ".pptx") -> Column:
    """Append the fallback suffix unless the name is a deck name."""
    tail = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.when(_has_deck_suffix(name), name).otherwise(F.concat(name, tail))


def catalogue_name(url: Column, portal_host: Column) -> Column:
    """``tag_ckan_portal_stem.ext`` from the resource's own file name."""
    own = F.coalesce(F.nullif(path_name(url), F.lit("")), F.lit("file.pptx"))
    own = with_deck_suffix(own, deck_extension(url))
    slug = F.substring(F.regexp_replace(portal_host, NOT_WORD, "_"), 1, 30)
    body = F.substring(F.regexp_replace(stem(own), NOT_WORD_DOT_DASH, "_"), 1, 80)
    return F.concat(url_tag(url), F.lit("_ckan_"), slug, F.lit("_"), body, F.lower(suffix(own)))


def dataset_name(tag: Column, record_id: Column, title: Column, extension: Column) -> Column:
    """Name of a deck taken from a dataset row."""
    shown = F.coalesce(F.nullif(title, F.lit("")), F.lit("untitled"))
    return F.concat(tag, F.lit("_pon_"), record_id, F.lit("_"), title_slug(shown, 35), extension)


def titled_name(source: str, record_id: Column, title: Column, extension: Column) -> Column:
    """``source_id_title.ext``, the form of the article, record and paper harvesters."""
    return F.concat(F.lit(f"{source}_"), F.regexp_replace(record_id, NOT_WORD_OR_DASH, "_"), F.lit("_"),
                    title_slug(title, 80), extension)


def work_name(work_id: Column, title: Column) -> Column:
    return F.concat(F.lit("core_"), work_id, F.lit("_"), with_deck_suffix(title_slug(title, 100)))


def datafile_name(file_id: Column, title: Column, name: Column) -> Column:
    long = F.concat(F.lit("dataverse_"), file_id, F.lit("_"), title_slug(title, 60), F.lit("_"),
                    F.regexp_replace(name, NOT_WORD_DOT_DASH, "_"))
    return capped_name(long, name)


def code_file_name(repo: Column, name: Column) -> Column:
    return capped_name(F.concat(F.lit("github_"), F.replace(repo, F.lit("/"), F.lit("_")), F.lit("_"), name), name)
