"""Byte-level tests on a binary column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deckmill import fixed_values as fv


def has_zip_magic(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 2)) == fv.ZIP_MAGIC_HEX


def has_ole_magic(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 8)) == fv.OLE_MAGIC_HEX


def has_deck_magic(content: Column) -> Column:
    return has_zip_magic(content) | has_ole_magic(content)


def is_html(content: Column, head: int = 1024) -> Column:
    """Web page delivered under a deck name: its first bytes carry an HTML tag."""
    start = F.lower(F.decode(F.substring(content, 1, head), "ISO-8859-1"))
    return F.contains(start, F.lit("<!doctype html")) | F.contains(start, F.lit("<html"))
