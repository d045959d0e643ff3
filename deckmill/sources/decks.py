"""Decks as rows: folder listing, bytes, container members and slides."""

from __future__ import annotations

import gzip
import io
import struct
import sys
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deckmill import fixed_values as fv
from deckmill.functions import names
from deckmill.operators import scale

# The functions below travel to the workers by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

AT_ONCE = 64  # decks opened before their rows leave the worker
OLE_MAGIC = bytes.fromhex(fv.OLE_MAGIC_HEX)
DRAWING_NS = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
SLIDE_NS = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
CORE_FIELDS = {
    "title": "{http://purl.org/dc/elements/1.1/}title",
    "author": "{http://purl.org/dc/elements/1.1/}creator",
    "subject": "{http://purl.org/dc/elements/1.1/}subject",
    "organization": "{http://schemas.openxmlformats.org/package/2006/metadata/core-properties}lastModifiedBy",
    "keywords": "{http://schemas.openxmlformats.org/package/2006/metadata/core-properties}keywords",
    "created": "{http://purl.org/dc/terms/}created",
    "modified": "{http://purl.org/dc/terms/}modified",
}

PART_TYPE = ("array<struct<member:string,position:int,number:int,is_slide:boolean,xml:string,text:string,"
             "text_length:int,has_table:boolean,parsed:boolean>>")
PARSED_COLUMNS = [
    "is_zip boolean", "is_ole boolean", "has_content_types boolean", "has_slide boolean",
    "read_error string", "slide_members int", "chart_files int", "charts int", "tables int",
    f"parts {PART_TYPE}", *[f"{c} string" for c in CORE_FIELDS],
]


def listing(spark: SparkSession, folders: Sequence[str], recursive: bool = False,
            pattern: str = "*.{ppt,pptx}") -> DataFrame:
    """Path, name, size and time of deck files. The bytes are not read."""
    return scan(spark, folders, recursive, pattern).drop("content")


def scan(spark: SparkSession, folders: Sequence[str], recursive: bool = False,
         pattern: str = "*.{ppt,pptx}") -> DataFrame:
    """Deck files with their bytes. A folder named twice is read once."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.load(list(dict.fromkeys(folders)))
    return with_name_columns(scale.gathered(files.select(
        "path", F.col("length").alias("file_size"), F.col("modificationTime").alias("mtime"), "content")))


def with_name_columns(files: DataFrame, path: str = "path") -> DataFrame:
    return files.withColumns({
        "name": names.base_name(F.col(path)), "folder": names.parent_name(F.col(path)),
        "extension": F.lower(names.suffix(names.base_name(F.col(path))))})


def is_deck_item(mime: Column, name: Column) -> Column:
    """Listing item with a deck MIME type or a deck name."""
    return mime.isin(fv.DECK_MIMES[:2]) | F.rlike(name, F.lit(r"(?i)\.pptx?$"))


def ole_stream_names(data: bytes) -> list[str]:
    """Paths of the streams of a compound file, storages before a slash. A chain that is broken raises ValueError."""
    size = 1 << struct.unpack_from("<H", data, 30)[0]
    per_sector = size // 4
    none = 0xFFFFFFF0

    def sector(number: int) -> int:
        if (number + 2) * size > len(data):
            raise ValueError("sector beyond the end of the file")
        return (number + 1) * size

    # the allocation table: 109 of its sectors are listed in the header, the others in a chain of sectors
    listed = list(struct.unpack_from("<109I", data, 76))
    more, seen = struct.unpack_from("<I", data, 68)[0], set()
    while more < none:
        if more in seen:
            raise ValueError("the list of allocation sectors runs in a circle")
        seen.add(more)
        *entries, more = struct.unpack_from(f"<{per_sector}I", data, sector(more))
        listed += entries
    fat: list[int] = []
    for number in listed:
        if number < none:
            fat += struct.unpack_from(f"<{per_sector}I", data, sector(number))
    entries, at, seen = [], struct.unpack_from("<I", data, 48)[0], set()
    while at < none:
        if at in seen or at >= len(fat):
            raise ValueError("the directory chain is broken")
        seen.add(at)
        start = sector(at)
        for entry in range(start, start + size, 128):
            length, kind = struct.unpack_from("<HB", data, entry + 64)
            left, right, child = struct.unpack_from("<III", data, entry + 68)
            entries.append((data[entry:entry + max(0, length - 2)].decode("utf-16-le", "ignore"), kind, left, right, child))
        at = fat[at]
    # streams below the root; siblings form a tree of their own
    found, todo, met = [], [(entries[0][4], "")] if entries else [], set()
    while todo:
        number, folder = todo.pop()
        if number >= len(entries) or number in met:
            continue
        met.add(number)
        name, kind, left, right, child = entries[number]
        todo += [(left, folder), (right, folder)]
        if kind == 2:
            found.append(folder + name)
        elif kind == 1:
            todo.append((child, f"{folder}{name}/"))
    return found


def _slide_part(member: str, number: int, raw: bytes) -> tuple[dict, int, int]:
    """Text, table flag and drawn objects of one slide."""
    xml = raw.decode("utf-8", errors="ignore")
    part = {"member": member, "number": number, "is_slide": True, "xml": xml, "text": "",
            "text_length": 0, "has_table": False, "parsed": False}
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return part, 0, 0
    texts = [t.text for t in root.iter(f"{DRAWING_NS}t") if t.text]
    uris = [g.get("uri", "") for tree in root.iter(f"{SLIDE_NS}spTree")
            for frame in tree.findall(f"{SLIDE_NS}graphicFrame") for g in frame.iter(f"{DRAWING_NS}graphicData")]
    part.update(text=" ".join(texts), text_length=sum(map(len, texts)), parsed=True,
                has_table=next(root.iter(f"{DRAWING_NS}tbl"), None) is not None)
    return part, sum(u.endswith("/chart") for u in uris), sum(u.endswith("/table") for u in uris)


def parse_deck(content: bytes) -> dict:
    """Container facts and slide members of one deck."""
    row: dict = {"is_zip": False, "is_ole": content[:8] == OLE_MAGIC,
                 "has_content_types": False, "has_slide": False, "read_error": "", "slide_members": 0,
                 "chart_files": 0, "charts": 0, "tables": 0, "parts": [], **{c: "" for c in CORE_FIELDS}}
    if row["is_ole"]:
        try:
            row["slide_members"] = max(sum("slide" in n.lower() for n in ole_stream_names(content)), 1)
        except (struct.error, IndexError, ValueError) as error:
            row["read_error"] = f"OLE error: {error}"
        return row
    if not zipfile.is_zipfile(io.BytesIO(content)):
        return row
    row["is_zip"] = True
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            members = z.namelist()
            row["has_content_types"] = "[Content_Types].xml" in members
            row["has_slide"] = any(m.startswith("ppt/slides/slide") for m in members)
            row["chart_files"] = sum(m.startswith("ppt/charts/") for m in members)
            number = 0
            place = {m: i for i, m in enumerate(members)}
            for member in sorted(m for m in members if "slide" in m and m.endswith(".xml")):
                raw = z.read(member)
                if member.startswith("ppt/slides/slide"):
                    number += 1
                    part, charts, tables = _slide_part(member, number, raw)
                    row["charts"] += charts
                    row["tables"] += tables
                else:
                    part = {"member": member, "number": 0, "is_slide": False, "text": "", "text_length": 0,
                            "xml": raw.decode("utf-8", errors="ignore"), "has_table": False, "parsed": False}
                row["parts"].append({**part, "position": place[member]})
            row["slide_members"] = number
            if "docProps/core.xml" in members:
                core = ET.fromstring(z.read("docProps/core.xml"))
                row.update({c: core.findtext(tag) or "" for c, tag in CORE_FIELDS.items()})
    except Exception as error:  # any damage inside the archive is a finding, not a job failure
        row["read_error"] = f"ZIP read error: {error}"
    return row


def pieces(batch: pd.DataFrame, rows: int = AT_ONCE) -> Iterator[pd.DataFrame]:
    """A batch by a few rows at a time: what is made of them, many times their size, does not follow the batch size."""
    for at in range(0, len(batch), rows):
        yield batch.iloc[at:at + rows]


def parse_decks(files: DataFrame, keep: Sequence[str] = ("path",), content: str = "content") -> DataFrame:
    """One row per deck with its container facts and slide parts.

    The only step that runs Python on the bytes; everything after it is
    expressions. ``keep`` columns travel along.
    """
    fields = {f.name: f.dataType.simpleString() for f in files.schema.fields}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in keep] + PARSED_COLUMNS)
    kept = list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some in pieces(batch):
                parsed = pd.DataFrame([parse_deck(bytes(c) if c is not None else b"") for c in some[content]])
                yield pd.concat([some[kept].reset_index(drop=True), parsed], axis=1)

    return files.select(*kept, content).mapInPandas(run, schema)


def container_reason(extension: Column, wording: str = "validator") -> Column:
    """Why a container is unsound; empty when it is sound.

    ``wording="cleaner"`` gives the texts of the cleaning tool, which asks
    for the content types only.
    """
    ext = F.lower(extension)
    error = F.col("read_error") != ""
    if wording == "cleaner":
        return (F.when((ext == ".pptx") & ~F.col("is_zip"), "Invalid ZIP structure (corrupted .pptx)")
                .when((ext == ".pptx") & error & ~F.col("has_content_types"), "Failed to read ZIP archive")
                .when((ext == ".pptx") & ~F.col("has_content_types"), "Missing PPTX content types (corrupted)")
                .when((ext == ".ppt") & ~F.col("is_ole"), "Invalid OLE structure (corrupted .ppt)")
                .otherwise(""))
    return (F.when((ext == ".pptx") & ~F.col("is_zip"), F.lit("Invalid ZIP structure"))
            .when((ext == ".pptx") & error & ~F.col("has_content_types") & ~F.col("has_slide"), F.col("read_error"))
            .when((ext == ".pptx") & ~F.col("has_content_types"), F.lit("Missing [Content_Types].xml"))
            .when((ext == ".pptx") & ~F.col("has_slide"), F.lit("No slide XML found"))
            .when((ext == ".ppt") & ~F.col("is_ole"), F.lit("Invalid OLE structure"))
            .when((ext == ".ppt") & error, F.col("read_error"))
            .otherwise(F.lit("")))


def slides_of(parsed: DataFrame, keys: Sequence[str] = ("path",)) -> DataFrame:
    """One row per slide."""
    return (parsed.select(*keys, F.explode("parts").alias("__p"))
            .where(F.col("__p.is_slide"))
            .select(*keys, F.col("__p.number").alias("slide_number"), F.col("__p.member").alias("member"),
                    F.col("__p.xml").alias("xml"), F.col("__p.text").alias("text"),
                    F.col("__p.text_length").alias("text_length"),
                    F.col("__p.has_table").alias("has_table"), F.col("__p.parsed").alias("parsed")))


def deck_text(parts: Column) -> Column:
    """Slide text of a deck in member order, blank-joined."""
    texts = F.filter(F.transform(F.filter(parts, lambda p: p["is_slide"]), lambda p: p["text"]), lambda t: t != "")
    return F.array_join(texts, " ")


def part_xml(parts: Column) -> Column:
    """XML of all slide-like members in name order."""
    return F.transform(parts, lambda p: p["xml"])


def archive_order_xml(parts: Column) -> Column:
    """The same in the order of the archive, as the topical test joins them."""
    placed = F.array_sort(F.transform(parts, lambda p: F.struct(p["position"].alias("position"), p["xml"].alias("xml"))))
    return F.transform(placed, lambda p: p["xml"])


def slide_xml(parts: Column) -> Column:
    """XML of the slides alone; the first one is slide 1."""
    return F.transform(F.filter(parts, lambda p: p["is_slide"]), lambda p: p["xml"])


@F.pandas_udf(T.BinaryType())
def _gunzip(data: pd.Series) -> pd.Series:
    def one(raw):
        try:
            return gzip.decompress(bytes(raw))
        except (OSError, EOFError, zlib.error):
            return raw
    return data.map(one, na_action="ignore")


def archive_payload(record: Column) -> Column:
    """Body of one web-archive response: after the second blank line; null when empty.

    A record that is not gzip is taken as it is.
    """
    opened = F.decode(_gunzip(record), "ISO-8859-1")
    blank = "\r\n\r\n"
    first = F.locate(blank, opened)
    http = F.when(first > 0, F.substr(opened, first + F.lit(4)))
    second = F.instr(http, blank)
    body = F.when(second > 0, F.substr(http, second + F.lit(4)))
    return F.encode(F.nullif(body, F.lit("")), "ISO-8859-1")
