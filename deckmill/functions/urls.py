"""URL column functions. All are built-in expressions."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.functions.text import strip

AUTHORITY_PATTERN = r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
# scheme, authority, path, query, fragment of a URL reference
REFERENCE_PATTERN = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def authority(url: Column, lower: bool = True) -> Column:
    """Authority with port and user info; empty when the URL has none."""
    found = F.coalesce(F.regexp_extract(url, AUTHORITY_PATTERN, 1), F.lit(""))
    return F.lower(found) if lower else found


def bare_host(url: Column) -> Column:
    """Lower-cased host without port and without one leading ``www.``."""
    return F.regexp_replace(F.split_part(authority(url), F.lit(":"), F.lit(1)), r"^www\.", "")


def display_host(url: Column) -> Column:
    """Host with every leading ``w`` and ``.`` removed, or ``unknown``."""
    host = F.split_part(authority(url), F.lit(":"), F.lit(1))
    stripped = F.regexp_replace(host, r"^[w.]+", "")
    return F.when(stripped == "", F.lit("unknown")).otherwise(stripped)


def by_label_count(names: Iterable[str]) -> dict[int, list[str]]:
    groups: dict[int, list[str]] = defaultdict(list)
    for name in sorted({n.lower() for n in names if n}):
        groups[name.count(".") + 1].append(name)
    return dict(groups)


def under_any(host: Column, names: Iterable[str]) -> Column:
    """True when ``host`` is one of ``names`` or a subdomain of one.

    A name of k labels covers exactly the hosts whose last k labels equal it,
    so the test is one hashed IN per label count: no join, no explode.
    """
    test = F.lit(False)
    for labels, group in sorted(by_label_count(names).items()):
        test = test | F.substring_index(host, ".", -labels).isin(group)
    return test


def ends_with_any(text: Column, suffixes: Iterable[str]) -> Column:
    test = F.lit(False)
    for suffix in suffixes:
        test = test | text.endswith(suffix)
    return test


def public_suffix(host: Column, suffixes: Sequence[str]) -> Column:
    """Longest of the given public suffixes that ends ``host``, else empty."""
    found = F.lit("")
    for labels, group in sorted(by_label_count(suffixes).items()):
        tail = F.substring_index(host, ".", -labels)
        found = F.when(tail.isin(group), tail).otherwise(found)
    return found


def registered_domain(host: Column, suffixes: Sequence[str]) -> Column:
    """The label before the public suffix joined to it, as ``label.suffix``."""
    suffix = public_suffix(host, suffixes)
    head = F.when(suffix == "", host).when(host == suffix, F.lit("")).otherwise(
        F.left(host, F.length(host) - F.length(suffix) - F.lit(1)))
    return F.concat(F.substring_index(head, ".", -1), F.lit("."), suffix)


def url_tag(url: Column) -> Column:
    return F.substring(F.sha1(F.encode(url, "UTF-8")), 1, 10)


def without_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def url_path(url: Column) -> Column:
    """Path without query, fragment and the parameters of its last part."""
    return F.regexp_replace(F.regexp_extract(url, REFERENCE_PATTERN, 3), r";[^/]*$", "")


def path_name(url: Column) -> Column:
    """Last non-empty part of the URL path."""
    return F.substring_index(F.regexp_replace(url_path(url), r"/+$", ""), "/", -1)


def is_deck_link(url: Column, pattern: str = fv.DECK_URL_PATTERN) -> Column:
    return F.rlike(url, F.lit(pattern))


def has_skipped_extension(url: Column, extensions: Sequence[str] = tuple(fv.SKIP_EXTENSIONS)) -> Column:
    return ends_with_any(F.lower(url), extensions)


def ends_with_deck_suffix(url: Column, suffixes: Sequence[str] = tuple(fv.SHOW_SUFFIXES)) -> Column:
    """Suffix test on the lower-cased URL with its query cut off."""
    return ends_with_any(F.lower(without_query(url)), suffixes)


def deck_extension(url: Column, unquote: bool = False) -> Column:
    """``.ppt`` when the query-less URL ends so, else ``.pptx``."""
    path = without_query(url)
    if unquote:
        path = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.when(F.endswith(F.lower(path), F.lit(".ppt")), F.lit(".ppt")).otherwise(F.lit(".pptx"))


def remove_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, part: F.when(part == ".", acc)
        .when(part == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - F.lit(1))).otherwise(acc))
        .otherwise(F.concat(acc, F.array(part))))
    trailing = F.when(F.rlike(path, F.lit(r"/\.{1,2}$")), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(kept, "/"), trailing)


def resolve_url(base: Column, ref: Column) -> Column:
    """Resolve a link against the page it stands on."""
    ref = strip(ref)
    scheme = F.regexp_extract(base, REFERENCE_PATTERN, 1)
    host = F.regexp_extract(base, REFERENCE_PATTERN, 2)
    base_path = F.regexp_extract(base, REFERENCE_PATTERN, 3)
    base_query = F.regexp_extract(base, r"(\?[^#]*)", 1)
    root = F.concat(scheme, F.lit("://"), host)
    ref_path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    ref_tail = F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    folder = F.regexp_replace(F.when(base_path == "", F.lit("/")).otherwise(base_path), r"[^/]*$", "")

    def tidy(path: Column) -> Column:
        return F.when(F.rlike(path, F.lit(r"(^|/)\.{1,2}(/|$)")), remove_dot_segments(path)).otherwise(path)

    return (
        F.when(ref == "", base)
        .when(F.rlike(ref, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")), ref)
        .when(F.startswith(ref, F.lit("//")), F.concat(scheme, F.lit(":"), ref))
        .when(F.startswith(ref, F.lit("#")), F.concat(root, base_path, base_query, ref))
        .when(F.startswith(ref, F.lit("?")), F.concat(root, base_path, ref))
        .when(F.startswith(ref, F.lit("/")), F.concat(root, tidy(ref_path), ref_tail))
        .otherwise(F.concat(root, tidy(F.concat(folder, ref_path)), ref_tail)))


def raw_code_host_url(url: Column) -> Column:
    """Page of a file on a code host to the address of its bytes."""
    swapped = F.replace(url, F.lit("github.com"), F.lit("raw.githubusercontent.com"))
    return F.replace(swapped, F.lit("/blob/"), F.lit("/"))


def snapshot_url(stamp: Column, url: Column) -> Column:
    """Archive address of one 14-digit capture."""
    return F.concat(F.lit("https://web.archive.org/web/"), stamp, F.lit("id_/"), url)


def stamp_to_time(stamp: Column) -> Column:
    return F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))


def download_link(html: Column, page_url: Column, site_root: str) -> Column:
    """Deck link of a presentation page: download, then export, then by id."""
    download = F.regexp_extract(html, fv.DOWNLOAD_LINK_PATTERN, 1)
    export = F.regexp_extract(html, fv.EXPORT_LINK_PATTERN, 1)
    number = F.regexp_extract(page_url, fv.PRESENTATION_ID_PATTERN, 1)
    return F.coalesce(
        F.nullif(download, F.lit("")),
        F.nullif(export, F.lit("")),
        F.when(number != "", F.concat(F.lit(f"{site_root}/download/"), number)))


def under_any_parent(host: Column, names: Iterable[str]) -> Column:
    """True when ``host`` is a strict subdomain of one of ``names``."""
    test = F.lit(False)
    for labels, group in sorted(by_label_count(names).items()):
        tail = F.substring_index(host, ".", -labels)
        test = test | (tail.isin(group) & (host != tail))
    return test


# Markup in which an anchor is no link.
NO_ANCHOR_PATTERN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ANCHOR_PATTERN = r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
ENTITIES = [("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&#38;", "&"), ("&amp;", "&")]


def anchor_targets(html: Column) -> Column:
    """Targets of the anchors of a page, quotes and entities resolved, ends stripped."""
    visible = F.regexp_replace(html, NO_ANCHOR_PATTERN, "")

    def plain(target: Column) -> Column:
        out = F.regexp_replace(target, r"^[\"']|[\"']$", "")
        for entity, char in ENTITIES:
            out = F.replace(out, F.lit(entity), F.lit(char))
        return strip(out)
    return F.transform(F.regexp_extract_all(visible, F.lit(ANCHOR_PATTERN), 1), plain)
