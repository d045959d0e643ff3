"""Shared pieces of the operators: typed inputs, worker code by value, scratch tables, small checked joins."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deckmill.session import write_and_read

# A word is a run of anything but ASCII white space, which is what bytes.split() leaves; bytes.lower() lower-cases
# A-Z only. The same in regular expressions:
WORD = r"[^\x20\x09-\x0D]+"
# Tables counted to be at most this long are broadcast: 16 bytes a row make 16 MB.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id long, text string), null texts empty; all other columns are left out, so none can clash."""
    return docs.select(docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[text_column], F.lit("")).alias("text"))


def by_value(function: Callable) -> Callable:
    """Ship the function and the package's helpers inside the plan: executors need not have the package."""
    for name in [m for m in sys.modules if m == "deckmill" or m.startswith("deckmill.")]:
        cloudpickle.register_pickle_by_value(sys.modules[name])
    return function


def kept(key: tuple, make: Callable):
    """A value that a Python worker makes once and keeps for its later tasks, such as a cache."""
    store = sys.__dict__.setdefault("_deckmill_kept", {})
    if key not in store:
        store[key] = make()
    return store[key]


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(by_value(function), schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def text_chunks(texts: list[bytes], most: int = 2_000_000) -> Iterator[slice]:
    """Slices of a batch of about ``most`` bytes of text each, so that work space does not follow the batch size."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def sampled(df: DataFrame, columns: list[str], most: int) -> DataFrame:
    """At most ``most`` rows: those whose hash over ``columns`` lies below a threshold that four fifths of ``most`` rows
    are expected to pass. Only a count moves; rows are not sorted."""
    share = min(1.0, 0.8 * most / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).limit(most) if share < 1 else df.limit(most)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Lineage cut by a table in the shared folder."""
    return write_and_read(df, label)


def small_or_shuffled(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint where a count of the stored table shows it is small."""
    return F.broadcast(df) if df.count() <= most else df
