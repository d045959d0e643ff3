"""Shared pieces of the registered queries: table access, stand-ins, SQL fragments.

The stand-in tables are projections of the given tables: documents act as deck
files and slides, pages as crawl records. Each has a Spark and an SQL form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deckmill.functions import names
from deckmill.operators import scale

Query = Callable[[SparkSession, str], DataFrame]


class Catalog(dict):
    """Name -> (query, SQL or None)."""

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            if name in self:
                raise ValueError(f"query {name} registered twice")
            self[name] = (query, sql)
            return query
        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows are costly, over all cores even where it is one small file."""
    return scale.spread(table(spark, sf_dir, name), [key])


def longs(df: DataFrame) -> DataFrame:
    """Counts in the width SQL gives them."""
    return df.select(*[F.col(f.name).cast("bigint").alias(f.name) if f.dataType.simpleString() == "int" else F.col(f.name)
                       for f in df.schema.fields])


# ---- deck files from documents ---------------------------------------------
def deck_files(docs: DataFrame) -> DataFrame:
    """Every tenth document is an old-format file; arrival order differs from the id."""
    ext = F.when(F.col("doc_id") % 10 == 0, ".ppt").otherwise(".pptx")
    name = F.concat(names.zero_padded(F.col("doc_id"), 6), ext)
    return docs.select(
        "doc_id", "text", "lang", F.col("source").alias("source"), "n_chars",
        name.alias("name"), ext.alias("extension"),
        F.concat(F.lit("corpus/"), F.col("source"), F.lit("/"), name).alias("path"),
        F.octet_length("text").cast("bigint").alias("file_size"),
        (F.col("doc_id") * 7919 % 100003).alias("mtime"),
        F.concat(F.lit("https://"), F.col("lang"), F.lit("."), F.col("source"), F.lit(".example.org/deck/"), name).alias("source_url"))


FILES = """files AS (
  SELECT doc_id, text, lang, source, n_chars, name, extension, 'corpus/' || source || '/' || name AS path,
         CAST(strlen(text) AS BIGINT) AS file_size, doc_id * 7919 % 100003 AS mtime,
         'https://' || lang || '.' || source || '.example.org/deck/' || name AS source_url
  FROM (SELECT *, CASE WHEN doc_id % 10 = 0 THEN '.ppt' ELSE '.pptx' END AS extension,
               CASE WHEN length(CAST(doc_id AS VARCHAR)) >= 6 THEN CAST(doc_id AS VARCHAR)
                    ELSE lpad(CAST(doc_id AS VARCHAR), 6, '0') END
               || CASE WHEN doc_id % 10 = 0 THEN '.ppt' ELSE '.pptx' END AS name
        FROM documents) d)"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deck_files(table(spark, sf_dir, "documents"))


def heavy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deck_files(spread_table(spark, sf_dir, "documents", "doc_id"))


# ---- slides from the lines of documents ------------------------------------
def lines(text: Column) -> Column:
    return F.split(text, "\n")


def slide_rows(docs: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    return docs.select("doc_id", *keep, F.posexplode(lines(F.col("text"))).alias("pos", "text")).select(
        "doc_id", *keep, (F.col("pos") + 1).alias("slide_number"), "text", F.length("text").alias("text_length"))


SLIDES = """slides AS (
  SELECT doc_id, i AS slide_number, l[i] AS text, length(l[i]) AS text_length
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) a) b)"""


# ---- SQL fragments ----------------------------------------------------------
AUTHORITY = r"lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1))"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_under(host: str, values: Iterable[str]) -> str:
    tests = [f"{host} = {q(v)} OR ends_with({host}, {q('.' + v)})" for v in values]
    return "(" + (" OR ".join(tests) or "FALSE") + ")"


def sql_ends(text: str, values: Iterable[str]) -> str:
    return "(" + (" OR ".join(f"ends_with({text}, {q(v)})" for v in values) or "FALSE") + ")"


def sql_any(text: str, values: Iterable[str]) -> str:
    return "(" + (" OR ".join(f"contains({text}, {q(v)})" for v in values) or "FALSE") + ")"


def sql_hits(text: str, values: Iterable[str]) -> str:
    items = ", ".join(f"CASE WHEN contains({text}, {q(v)}) THEN {q(v)} END" for v in sorted(set(values)))
    return f"concat_ws(', ', {items})"


def sql_count(text: str, values: Iterable[str]) -> str:
    return " + ".join(f"CAST(contains({text}, {q(v)}) AS INTEGER)" for v in sorted(set(values)))


def sql_list(values: Iterable[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"
