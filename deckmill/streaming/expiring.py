"""Dedup whose memory expires: a key passes, is held back for a period, and passes again when it comes after that.

A ledger remembers for ever and a watermark alone drops late rows; crawls that re-visit a URL after some weeks need neither.
``first_per_period`` keeps one number per key, the event time up to which the key is held back, in the state store. It is cleared
once the watermark has passed that time, at the bucket's next rows or by an event-time timer, so state holds the keys of one period
(and the watermark's delay), not all keys ever seen; a row that comes before that is judged by the number itself, so timers change
no result.

Keys hash to ``buckets``, and rows and numbers of a bucket reach a worker together: a call for each key costs a thousand times
what a key's few rows do. A task holds one bucket at a time, its rows of the micro-batch and its keys of a period.

Rows of a micro-batch are judged per key in order of event time, then of ``order``; a row that passes starts a new period. Rows
behind the watermark (at first 1970-01-01) are dropped by Spark. A row that is late but not behind it is held back if its key's period began after
it. Null keys are one key; rows with a null event time never pass. A key's rows of one micro-batch stand in one task: bound the
micro-batch (``maxFilesPerTrigger``, ``rows_per_batch``) where one key may hold many.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_AT, _KEY, _BUCKET = "event_us", "key", "bucket"
BUCKETS = 4096


def use_rocksdb(spark: SparkSession) -> str | None:
    """State that lives on disk and may outgrow memory, as this kind of state needs it. Returns the setting before."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    return before


def _timer(until: int) -> int:
    """Timers count milliseconds, event times microseconds."""
    return until // 1000 + 1


def _judge(period_us: int, order: list[str], columns: list[str]):
    """The rows of a bucket's keys in one micro-batch against the numbers of these keys."""

    def run(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        until = dict(zip(*state.get)) if state.exists else {}
        if not state.hasTimedOut:
            rows = pd.concat(list(frames), ignore_index=True).sort_values([_AT, *order], kind="stable", ignore_index=True)
            passed = []
            for place, (key, at) in enumerate(zip(rows[_KEY].tolist(), rows[_AT].tolist())):
                if at >= until.get(key, at):
                    passed.append(place)
                    until[key] = at + period_us
            if passed:
                yield rows[columns].take(passed)
        # no row to come is before the watermark: numbers that it has passed hold nothing back
        watermark = state.getCurrentWatermarkMs()
        until = {key: number for key, number in until.items() if _timer(number) > watermark}
        if until:
            state.update((list(until), list(until.values())))
            state.setTimeoutTimestamp(_timer(min(until.values())))
        elif state.exists:
            state.remove()

    return run


def _key_text(key: Column, kind: T.DataType) -> Column:
    """Equal for equal keys only; null for null."""
    if isinstance(kind, T.BinaryType):
        return F.hex(key)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key).cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (key + F.lit(0).cast(kind)).cast("string")  # one zero
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(key, {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return key.cast("string")


def first_per_period(stream: DataFrame, keys: Sequence[str], event_time: str, period_seconds: int, delay: str,
                     order: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """The rows of a stream that come a period or more after the last row of their key that passed. Needs ``use_rocksdb``.

    ``buckets`` is kept for the life of a checkpoint."""
    # plain names on the way: whatever the columns are called, none is taken for another
    names = {column: f"c{i}" for i, column in enumerate(stream.columns)}
    plain = stream.select(*[F.col(f"`{column}`").alias(name) for column, name in names.items()])
    kinds = {f.name: f.dataType for f in plain.schema.fields}
    text = F.to_json(F.array(*[_key_text(F.col(names[k]), kinds[names[k]]) for k in keys]))
    timed = plain.where(F.col(names[event_time]).isNotNull()).withColumns({
        _AT: F.unix_micros(names[event_time]), _KEY: text, _BUCKET: F.pmod(F.xxhash64(text), F.lit(buckets))})
    # whole numbers stay whole beside null ones: zero, and a mark
    marks = {name: f"{name}_null" for name, kind in kinds.items() if isinstance(kind, T.IntegralType)}
    timed = timed.withColumns({mark: F.col(name).isNull() for name, mark in marks.items()})
    timed = timed.withColumns({name: F.coalesce(name, F.lit(0).cast(kinds[name])) for name in marks})
    carried = [*names.values(), *marks.values()]
    by = [c for o in order for c in ([marks[names[o]]] if names[o] in marks else []) + [names[o]]]  # nulls last
    passed = timed.withWatermark(names[event_time], delay).groupBy(_BUCKET).applyInPandasWithState(
        _judge(period_seconds * 1_000_000, by, carried), outputStructType=timed.select(*carried).schema,
        stateStructType="keys array<string>, until array<bigint>", outputMode="append", timeoutConf=GroupStateTimeout.EventTimeTimeout)
    return passed.select(*[(F.when(~F.col(marks[name]), F.col(name)) if name in marks else F.col(name)).alias(column) for column, name in names.items()])
