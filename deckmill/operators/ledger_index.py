"""A ledger kept as a stored index: keys in hash buckets, with a Bloom sketch per bucket and run.

A ledger of all keys ever seen only grows, while a run brings few new ones. The index is a folder that all executors see:

* ``keys/run=R/bucket=B/``: the distinct keys a run added, by the bucket of their hash;
* ``sketches/run=R/``: for every bucket of the run an array of 64-bit words, in each of which a key sets up to four bits. It
  is written last and makes the run visible: a run that broke off before is not there, and running it again
  replaces what it left;
* ``settings``: the number of buckets and the bits per key, fixed when the index is made.

``known`` asks the sketches first, with the asked keys broadcast where a count shows that they are few. Only the files of the
(run, bucket) pairs that a sketch lets through are read, and their rows meet the keys that passed in a broadcast
join: the ledger itself never crosses a shuffle. Every hit is decided on the keys, so a sketch can only cost a read.
Where very many keys pass, they are joined with the let-through buckets by a shuffle.

Null keys are never in the ledger and never known. Pairs of run and bucket that come to the driver are bounded by their
number, buckets x runs; ``compact`` writes all runs as one into a new folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deckmill.operators import ledger, scale
from deckmill.session import write_and_read

BUCKETS = 256
BITS_PER_KEY = 16
FEWEST_WORDS = 16
# Keys that crossed a sketch, or are asked, up to this number are broadcast: tags and digests make some tens of MB.
FEW_KEYS = 500_000
# Asked keys of one bucket in one row of the sketch test.
KEYS_A_ROW = 10_000

_BITS = "(shiftleft(1L, cast(__hash & 63 as int)) | shiftleft(1L, cast(shiftrightunsigned(__hash, 6) & 63 as int)) " \
        "| shiftleft(1L, cast(shiftrightunsigned(__hash, 12) & 63 as int)) | shiftleft(1L, cast(shiftrightunsigned(__hash, 18) & 63 as int)))"


def _or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


class LedgerIndex:
    """The index at ``path``; made with ``buckets`` and ``bits_per_key`` where there is none yet."""

    def __init__(self, spark: SparkSession, path: str, key_types: str, buckets: int = BUCKETS, bits_per_key: int = BITS_PER_KEY):
        self.spark, self.path, self.key_types = spark, path.rstrip("/"), key_types
        self.keys = [f.name for f in T.StructType.fromDDL(key_types).fields]
        settings = f"{self.path}/settings"
        spark.createDataFrame([(buckets, bits_per_key)], "buckets int, bits int").coalesce(1).write.mode("ignore").json(settings)
        self.buckets, self.bits = spark.read.schema("buckets int, bits int").json(settings).first()

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Distinct whole keys with their bucket and sketch hash."""
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        fields = T.StructType.fromDDL(self.key_types).fields
        keys = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]).where(whole).distinct()
        return keys.select(*self.keys, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket"),
                           F.xxhash64(F.lit("sketch"), *self.keys).alias("__hash"))

    @staticmethod
    def _word(words: Column | str) -> Column:
        """The word of a key's bits, from hash bits that choose neither."""
        return F.pmod(F.shiftrightunsigned("__hash", 24), words)

    def append(self, rows: DataFrame, run: str) -> None:
        """Add the keys of ``rows`` as run ``run``; a run of that name is replaced."""
        if not run or "/" in run:
            raise ValueError("a run needs a name without slashes")
        at = f"{self.path}/keys/run={run}"
        placed = self._placed(rows)
        # all keys of a bucket in one file
        placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(at)
        schema = f"{self.key_types}, bucket int"
        stored = self._placed(_or_empty(self.spark, at, schema))
        needed = F.log2(F.col("count") * F.lit(self.bits) / F.lit(64))
        sizes = stored.groupBy("bucket").count().select(
            "bucket", "count", F.greatest(F.lit(FEWEST_WORDS), F.pow(F.lit(2), F.ceil(needed))).cast("long").alias("words"))
        # one row per bucket: at most self.buckets of them
        bits = (stored.join(F.broadcast(sizes), "bucket")
                .select("bucket", self._word("words").alias("word"), F.expr(_BITS).alias("bits")))
        empty = sizes.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("words") - 1)).alias("word"), F.lit(0).cast("long").alias("bits"))
        words = bits.unionByName(empty).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        sketch = words.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("s"))
        (sketch.select("bucket", F.transform("s", lambda w: w["bits"]).alias("sketch")).sortWithinPartitions("bucket")
         .write.mode("overwrite").parquet(f"{self.path}/sketches/run={run}"))

    def sketches(self) -> DataFrame:
        return _or_empty(self.spark, f"{self.path}/sketches", "bucket int, sketch array<bigint>, run string")

    def entries(self) -> DataFrame:
        """All keys of the visible runs; a key comes once per run that added it."""
        runs = [r["run"] for r in self.sketches().select("run").distinct().collect()]
        rows = _or_empty(self.spark, f"{self.path}/keys", f"{self.key_types}, run string, bucket int")
        return rows.where(F.col("run").isin(runs)).select(*self.keys)

    def let_through(self, rows: DataFrame, without_run: str | None = None) -> DataFrame:
        """(keys, bucket, run) of the keys of ``rows`` that a sketch lets through; stored."""
        asked = write_and_read(self._placed(rows), "ledger-asked")
        count = asked.count()
        slices = max(1, -(-count // (self.buckets * KEYS_A_ROW)))
        groups = (asked.groupBy("bucket", F.pmod(F.shiftrightunsigned("__hash", 40), F.lit(slices)).alias("slice"))
                  .agg(F.collect_list(F.struct(*self.keys, "__hash", F.expr(_BITS).alias("bits"))).alias("asked")))
        sketches = self.sketches()
        if without_run is not None:
            sketches = sketches.where(F.col("run") != without_run)
        if count <= FEW_KEYS:
            buckets = [r["bucket"] for r in asked.select("bucket").distinct().collect()]
            sketches, groups = sketches.where(F.col("bucket").isin(buckets)), F.broadcast(groups)

        def passes(key: Column) -> Column:
            word = F.pmod(F.shiftrightunsigned(key["__hash"], 24), F.size("sketch"))
            return F.get("sketch", word.cast("int")).bitwiseAND(key["bits"]) == key["bits"]

        passed = sketches.join(groups, "bucket").select("bucket", "run", F.explode(F.filter("asked", passes)).alias("key"))
        return write_and_read(passed.select(*[F.col(f"key.{k}").alias(k) for k in self.keys], "bucket", "run"), "ledger-let-through")

    def candidates_in(self, passed: DataFrame) -> DataFrame:
        """The stored keys of the (run, bucket) pairs that occur in ``passed``; other files are not read."""
        pairs: dict[str, list[int]] = {}
        for run, bucket in passed.select("run", "bucket").distinct().collect():
            pairs.setdefault(run, []).append(bucket)
        rows = _or_empty(self.spark, f"{self.path}/keys", f"{self.key_types}, run string, bucket int")
        these = [(F.col("run") == run) & F.col("bucket").isin(sorted(buckets)) for run, buckets in sorted(pairs.items())]
        return rows.where(reduce(lambda a, b: a | b, these, F.lit(False)))

    def known(self, rows: DataFrame, without_run: str | None = None) -> DataFrame:
        """The distinct keys of ``rows`` that are in the ledger."""
        passed = self.let_through(rows, without_run)
        stored = self.candidates_in(passed).select(*self.keys)
        asked = passed.select(*self.keys).distinct()
        if passed.count() <= FEW_KEYS:
            return stored.join(F.broadcast(asked), self.keys, "left_semi").distinct()
        return asked.join(stored.distinct(), self.keys, "left_semi")

    def drop_seen(self, rows: DataFrame, spread_on: Sequence[str], without_run: str | None = None) -> DataFrame:
        """The rows whose key is not in the ledger; rows with a null key stay. A key repeated very often crosses no
        shuffle more than once (see ``ledger.flag_seen``)."""
        known = write_and_read(self.known(rows, without_run), "ledger-known")
        return ledger.drop_seen(rows, known, self.keys, spread_on)

    def add_new(self, rows: DataFrame, run: str) -> DataFrame:
        """Append the keys the ledger lacks as run ``run``, and return them. Repeating a run gives the same keys."""
        known = write_and_read(self.known(rows, without_run=run), "ledger-known")
        fresh = self._placed(rows).select(*self.keys).join(scale.broadcast_if_small(known, FEW_KEYS), self.keys, "left_anti")
        self.append(fresh, run)
        return _or_empty(self.spark, f"{self.path}/keys/run={run}", f"{self.key_types}, bucket int").select(*self.keys)

    def compact(self, path: str, run: str = "compacted") -> LedgerIndex:
        """All visible runs as one run of a new index, with buckets for its size."""
        size = self.entries().distinct().count()
        made = LedgerIndex(self.spark, path, self.key_types, max(BUCKETS, self.buckets, 1 << (size // 1_000_000).bit_length()), self.bits)
        made.append(self.entries(), run)
        return made
