"""Incremental runs as Structured Streaming jobs.

A file source with a checkpoint replaces the polling loop: a file is seen once.
Each micro-batch writes its tables under its own part, named by the query's id
(which its checkpoint keeps) and the micro-batch, so that a repeated micro-batch
replaces what it wrote before, nothing is counted twice, and no job writes over
what another one wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from deckmill.operators import dedup, ledger
from deckmill.operators.ledger_index import LedgerIndex
from deckmill.plans import curate
from deckmill.sinks import tables as sinks
from deckmill.sources import arrivals, decks

Batch = Callable[[DataFrame, int], None]


def start(stream: DataFrame, batch: Batch, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ``batch`` per micro-batch: all there is now, or again every so often."""
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def for_many_files(spark: SparkSession) -> SparkSession:
    """A session like this one for streams over very many small files, for which a stream asks the session it was read with:
    a micro-batch looks each of its files up once more, by Spark a task for each file, and reads them as if each were megabytes long."""
    wanted = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
              "spark.sql.files.openCostInBytes": str(64 << 10)}
    session = spark.newSession()
    for key, value in {**spark.conf.getAll, **wanted}.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def watch_decks(spark: SparkSession, folder: str, max_files: int | None = None, state: str | None = None, content: bool = True) -> DataFrame:
    """Arriving deck files with their bytes, unless these are not wanted.

    Spark's file source keeps the paths of all files in the driver. With a folder for the stream's ``state``, beside its
    checkpoint, they are kept there (``sources.arrivals``), and a micro-batch takes all there is: its files cost the driver nothing."""
    if state is not None:
        if max_files:
            raise ValueError("max_files goes with Spark's file source: with a state, a micro-batch takes all there is")
        arrivals.register(spark)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
        raw = (spark.readStream.format("arriving_files").option("path", root).option("state", state).option("suffixes", ".ppt,.pptx")
               .option("content", str(content).lower()).load())
    else:
        reader = for_many_files(spark).readStream.format("binaryFile").option("pathGlobFilter", "*.{ppt,pptx}").option("recursiveFileLookup", "true")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", str(max_files))
        raw = reader.schema("path string, modificationTime timestamp, length bigint, content binary").load(folder)
    return decks.with_name_columns(raw.select("path", F.col("length").alias("file_size"), F.col("modificationTime").alias("mtime"),
                                              *(["content"] if content else [])))


def watch_table(spark: SparkSession, folder: str, schema: T.StructType | str, pattern: str | None = None,
                file_format: str = "parquet", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(file_format)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(folder)


def _part(spark: SparkSession, epoch: int) -> str:
    """Name of a micro-batch's part: a restart from one checkpoint has the same query id, any other job another one."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{epoch}" if query else str(epoch)


def _written(spark: SparkSession, path: str, schema: str, part: str) -> DataFrame:
    """All rows written so far, in whatever way, but for the part that is being repeated; nothing yet gives an empty table."""
    # Files beside the parts would be ignored if the parts were read as partitions.
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    try:
        rows = reader.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)
    return rows.where(~F.contains(F.col("_metadata.file_path"), F.lit(f"/part_id={part}/")))


def delivery_batch(out: str, batch: str, now: Column, sidecars: DataFrame | None = None) -> Batch:
    """Micro-batch of the delivery watcher: metadata, audit and delivered ledger."""

    def run(files: DataFrame, epoch: int) -> None:
        spark = files.sparkSession
        part = _part(spark, epoch)
        delivered = _written(spark, f"{out}/ledger", "filename string, status string", part)
        given = _written(spark, f"{out}/numbers", "batch_id string, sequence_number bigint", part)
        last = curate.numbering.last_used(given, batch)
        parsed = decks.parse_decks(files, ["path", "name", "extension", "file_size"])
        facts = curate.deck_facts(parsed).drop("parts")
        if sidecars is not None:
            from deckmill.sources import tables

            facts = tables.with_sidecars(facts, sidecars)
        else:
            from deckmill.sources.tables import CATALOGUE_SIDECAR_SCHEMA

            facts = facts.withColumn("sidecar", F.lit(None).cast(CATALOGUE_SIDECAR_SCHEMA))
        # Facts are stored first, so that the decks are parsed once per micro-batch.
        sinks.append_parquet(facts, f"{out}/facts", part)
        stored = spark.read.schema(facts.schema).parquet(f"{out}/facts/part_id={part}")
        done = curate.deliver(stored, delivered, batch, now, last)
        # The ledger goes last: a crash before it repeats the micro-batch as a whole.
        sinks.append_json(done["metadata"], f"{out}/metadata", part)
        sinks.append_json(done["audit"], f"{out}/audit", part)
        sinks.append_parquet(done["metadata"].select("batch_id", "sequence_number"), f"{out}/numbers", part)
        sinks.append_ledger(done["ledger"], f"{out}/ledger", ["filename", "status"], part)

    return run


def dedup_batch(out: str, keys: Sequence[str], order: Sequence[str], key_types: str,
                keep: Callable[[DataFrame], DataFrame] | None = None) -> Batch:
    """Micro-batch of cross-run dedup: new keys pass and enter the ledger.

    The ledger grows without bound by design; it is a table, not task state.
    """

    def run(rows: DataFrame, epoch: int) -> None:
        part = _part(rows.sparkSession, epoch)
        known = _written(rows.sparkSession, f"{out}/ledger", key_types, part)
        first = dedup.keep_one(rows, list(keys), list(order))
        fresh = ledger.drop_seen(first, known, list(keys), list(keys))
        fresh = keep(fresh) if keep else fresh
        sinks.append_parquet(fresh, f"{out}/accepted", part)
        written = rows.sparkSession.read.schema(fresh.schema).parquet(f"{out}/accepted/part_id={part}")
        sinks.append_ledger(written, f"{out}/ledger", keys, part)

    return run


def indexed_dedup_batch(out: str, index: LedgerIndex, order: Sequence[str]) -> Batch:
    """Micro-batch of cross-run dedup against a stored index: only the buckets its sketches let through are read, however
    long the ledger has grown. The micro-batch is a run of the index, so a repeated one replaces itself."""

    def run(rows: DataFrame, epoch: int) -> None:
        part = _part(rows.sparkSession, epoch)
        first = dedup.keep_one(rows, index.keys, list(order))
        fresh = index.drop_seen(first, index.keys, without_run=part)
        sinks.append_parquet(fresh, f"{out}/accepted", part)
        index.append(rows.sparkSession.read.schema(fresh.schema).parquet(f"{out}/accepted/part_id={part}"), part)

    return run


def dedup_within(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Bounded-state variant where an event time exists."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def publish_batch(out: str, rows: Callable[[DataFrame], DataFrame]) -> Batch:
    """Micro-batch that publishes metadata or audit rows; one part per micro-batch."""

    def run(batch: DataFrame, epoch: int) -> None:
        sinks.append_json(rows(batch), out, _part(batch.sparkSession, epoch))

    return run


def audit_stream(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append-only audit sink."""
    return (rows.writeStream.format("json").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def running_counts(stream: DataFrame, source: str = "source") -> DataFrame:
    """Rows and bytes per source so far, for output mode ``complete``."""
    return stream.groupBy(source).agg(F.count("*").alias("files"), F.sum("file_size").alias("bytes"))


def counts_query(stream: DataFrame, out: str, checkpoint: str, source: str = "source") -> StreamingQuery:
    """Running counters whose latest state replaces the table of the one before."""

    def run(state: DataFrame, epoch: int) -> None:
        state.write.mode("overwrite").parquet(out)

    return (running_counts(stream, source).writeStream.outputMode("complete").foreachBatch(run)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
