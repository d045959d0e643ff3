"""Registered streaming queries: the given tables are the arriving data.

Each runs its stream to the end of what is there, twice, and returns what
the sink holds; the second run finds nothing new.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from deckmill.catalog.common import Catalog, deck_files, table
from deckmill.operators.ledger_index import LedgerIndex
from deckmill.session import scratch_path
from deckmill.sources import shards
from deckmill.streaming import expiring, watch

CATALOG = Catalog()


def stream_of(spark, d, name):
    """A table as arriving files, be it one file or a folder of parts: the braces make a pattern of the path, which may name either."""
    return watch.watch_table(spark, f"{d.rstrip('/')}/{{{name}.parquet}}", table(spark, d, name).schema)


@CATALOG.add("stream_dedup_ledger", """
SELECT file_hash, min(doc_id) AS doc_id FROM (SELECT sha256(text) AS file_hash, doc_id FROM documents) t GROUP BY 1""")
def stream_dedup_ledger(spark, d):
    out = scratch_path(spark, "stream-dedup")
    arriving = stream_of(spark, d, "documents").select(F.sha2("text", 256).alias("file_hash"), "doc_id")
    for _ in range(2):
        watch.start(arriving, watch.dedup_batch(out, ["file_hash"], ["doc_id"], "file_hash string"), f"{out}/checkpoint").awaitTermination()
    return spark.read.schema("file_hash string, doc_id bigint").option("basePath", f"{out}/accepted").parquet(f"{out}/accepted").select("file_hash", "doc_id")


@CATALOG.add("stream_dedup_index", """
SELECT file_hash, min_by(doc_id, doc_id % 3 * 1000000000 + doc_id) AS doc_id FROM (SELECT sha256(text) AS file_hash, doc_id FROM documents) t
WHERE file_hash IS NOT NULL GROUP BY 1""")
def stream_dedup_index(spark, d):
    """Three files arrive one after the other; each micro-batch meets the index of those before it."""
    out = scratch_path(spark, "stream-index")
    hashed = table(spark, d, "documents").select(F.sha2("text", 256).alias("file_hash"), "doc_id").where(F.col("file_hash").isNotNull())
    for wave in range(3):
        hashed.where(F.col("doc_id") % 3 == wave).write.mode("append").parquet(f"{out}/arriving")
        index = LedgerIndex(spark, f"{out}/index", "file_hash string", buckets=32)
        arriving = watch.watch_table(spark, f"{out}/arriving", "file_hash string, doc_id bigint")
        watch.start(arriving, watch.indexed_dedup_batch(out, index, ["doc_id"]), f"{out}/checkpoint").awaitTermination()
    return spark.read.schema("file_hash string, doc_id bigint").option("basePath", f"{out}/accepted").parquet(f"{out}/accepted").select("file_hash", "doc_id")


@CATALOG.add("stream_source_counters", """
SELECT source, count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY 1""")
def stream_source_counters(spark, d):
    out = scratch_path(spark, "stream-counts")
    files = stream_of(spark, d, "documents").select("source", F.octet_length("text").cast("bigint").alias("file_size"))
    watch.counts_query(files, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema("source string, files bigint, bytes bigint").parquet(f"{out}/table")


@CATALOG.add("stream_audit_log", "SELECT event_id, event_type AS decision FROM events")
def stream_audit_log(spark, d):
    out = scratch_path(spark, "stream-audit")
    rows = stream_of(spark, d, "events").select("event_id", F.col("event_type").alias("decision"))
    for _ in range(2):
        watch.audit_stream(rows, f"{out}/log", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema("event_id bigint, decision string").json(f"{out}/log")


@CATALOG.add("stream_publish_metadata", "SELECT doc_id, source, strlen(text) AS file_size FROM documents WHERE doc_id % 10 <> 0")
def stream_publish_metadata(spark, d):
    out = scratch_path(spark, "stream-publish")

    def rows(batch):
        f = deck_files(batch)
        return f.where(F.col("extension") == ".pptx").select("doc_id", "source", "file_size")

    for _ in range(2):
        watch.start(stream_of(spark, d, "documents"), watch.publish_batch(f"{out}/metadata", rows), f"{out}/checkpoint").awaitTermination()
    return spark.read.schema("doc_id bigint, source string, file_size bigint").json(f"{out}/metadata").select("doc_id", "source", "file_size")


@CATALOG.add("stream_dedup_within_watermark", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup_within_watermark(spark, d):
    out = scratch_path(spark, "stream-within")
    rows = watch.dedup_within(stream_of(spark, d, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")),
                              ["user_id", "event_type"], "ts", "3650 days")
    query = (rows.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema("user_id bigint, event_type string").parquet(f"{out}/rows")


@CATALOG.add("stream_shard_rows", "SELECT event_id, event_type, CAST(1 AS BIGINT) AS times_read FROM events")
def stream_shard_rows(spark, d):
    """Shards harvested in two waves that part in the middle of a shard; a third one finds nothing left."""
    shards.register(spark)
    out = scratch_path(spark, "stream-shards")
    events = table(spark, d, "events").select("event_id", "event_type")
    events.repartitionByRange(5, "event_id").write.parquet(f"{out}/shards")
    first_wave = events.count() * 3 // 5 + 1
    for _ in range(3):
        rows = (spark.readStream.format("shard_rows").option("path", f"{out}/shards").option("cursor", f"{out}/cursor.json")
                .option("rows_per_batch", str(first_wave)).load())
        (rows.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    got = spark.read.schema("event_id bigint, event_type string").parquet(f"{out}/rows")
    return got.groupBy("event_id", "event_type").agg(F.count("*").alias("times_read"))


@CATALOG.add("stream_dedup_expiring", """
WITH RECURSIVE e AS (SELECT user_id, event_type, epoch_us(ts) AS at_us FROM events WHERE ts IS NOT NULL),
passed AS (
  SELECT user_id, event_type, min(at_us) AS at_us FROM e GROUP BY ALL
  UNION ALL
  SELECT e.user_id, e.event_type, min(e.at_us) FROM passed p JOIN e ON e.user_id = p.user_id AND e.event_type = p.event_type
    AND e.at_us >= p.at_us + 3 * 86400000000 GROUP BY ALL)
SELECT user_id, event_type, at_us FROM passed""")
def stream_dedup_expiring(spark, d):
    """A user's event of one kind is held back for three days after the last one that passed. Three waves arrive in order of time."""
    out = scratch_path(spark, "stream-expiring")
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    first, last = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    wave = F.least(F.lit(2), F.floor((F.unix_micros("ts") - F.lit(first)) * 3 / F.lit(max(1, (last or 0) - (first or 0)))))
    before = expiring.use_rocksdb(spark)
    try:
        for number in range(3):
            events.where(wave == number).write.mode("append").parquet(f"{out}/arriving")
            arriving = watch.watch_table(spark, f"{out}/arriving", events.schema)
            rows = expiring.first_per_period(arriving, ["user_id", "event_type"], "ts", 3 * 86400, "1 hour", ["event_id"])
            (rows.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
             .trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.unset(expiring.PROVIDER) if before is None else spark.conf.set(expiring.PROVIDER, before)
    got = spark.read.schema("user_id bigint, event_type string, ts timestamp").parquet(f"{out}/rows")
    return got.select("user_id", "event_type", F.unix_micros("ts").alias("at_us"))
