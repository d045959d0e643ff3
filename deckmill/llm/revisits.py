"""Resolution of not-modified revisits: each to the latest earlier full response of its canonical URL.

Records are rows of (record_id, url, fetched_at, kind, etag, last_modified, headers): ``kind`` is ``response`` or
``revisit``, ``headers`` a map of lower-case names. Responses and revisits are sorted together by URL, time and id over a
range partitioning, so that one URL with a third of all records spans many partitions. The last response before a row is
a window within its partition, or else the last one of the partitions before, a table of one row per partition.

Status of a revisit:

* ``resolved``: a validator that both sides carry agrees, and none disagrees. Entity tags compare weakly; the time of
  modification counts where there are no two tags.
* ``mismatch``: the validator disagrees. ``unverified``: they share no validator. ``no_response``: nothing earlier.

Merged headers are those of the response, with the ones a not-modified answer may update taken from the revisit.

Edge cases: a null URL or time matches nothing; at one time the lesser record_id is the earlier; rows that repeat give
repeated results; null headers are none; other kinds are left out; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deckmill.llm.common import stored

# fixed values: headers that a not-modified answer may carry to update a stored response
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, then path and query without tracking parameters; no scheme, no fragment."""
    rest = F.regexp_replace(F.regexp_replace(url, r"(?s)#.*", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r":(80|443)$", "")
    tail = F.regexp_extract(rest, r"(?s)^[^/?]*(.*)$", 1)
    tail = F.regexp_replace(tail, r"(?<=[?&])utm_[^&]*(&|$)", "")  # looking back: the next one may follow at once
    tail = F.regexp_replace(tail, r"[?&]+$", "")
    return F.concat(host, F.when(tail == "", F.lit("/")).otherwise(tail))


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def latest_before(rows: DataFrame, key: str, order: list[str], source: Column, found: list[str]) -> DataFrame:
    """``rows`` with ``before``: a struct of ``found`` of the last row before it, by key and order, for which ``source``
    holds; null where there is none of the same key."""
    placed = stored(rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
                    .withColumn("__place", F.monotonically_increasing_id()), "placed")
    offered = F.when(source, F.struct(F.col(key).alias("__key"), *found))
    part = F.shiftright("__place", 33)
    earlier = Window.partitionBy("__part").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    rows_in = placed.withColumn("__part", part).withColumn("__within", F.last(offered, ignorenulls=True).over(earlier))
    lasts = placed.groupBy(part.alias("__part")).agg(F.max_by(offered, F.when(source, F.col("__place"))).alias("__last"))
    parts = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    carried = lasts.select("__part", F.last("__last", ignorenulls=True).over(parts).alias("__carried"))
    joined = rows_in.join(F.broadcast(carried), "__part").withColumn("__b", F.coalesce("__within", "__carried"))
    same = F.col("__b")["__key"] == F.col(key)
    return joined.select(*rows.columns, F.when(same, F.struct(*[F.col("__b")[c].alias(c) for c in found])).alias("before"))


def resolve(records: DataFrame) -> DataFrame:
    """(record_id, url_key, response_id, status, headers) of every revisit."""
    rows = records.where("kind IN ('response', 'revisit')").select(
        F.col("record_id").cast("long"), canonical_url(F.col("url")).alias("url_key"), "fetched_at", "kind", "etag", "last_modified",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"))
    found = latest_before(rows, "url_key", ["fetched_at", "record_id"], (F.col("kind") == "response") & F.col("fetched_at").isNotNull(),
                          ["record_id", "etag", "last_modified", "headers"])
    old = F.when(F.col("fetched_at").isNotNull(), F.col("before"))
    revisits = found.where("kind = 'revisit'").withColumn("old", old)
    tags = F.col("etag").isNotNull() & F.col("old.etag").isNotNull()
    times = F.col("last_modified").isNotNull() & F.col("old.last_modified").isNotNull()
    agrees = F.when(tags, _strong(F.col("etag")) == _strong(F.col("old.etag"))).when(times, F.col("last_modified") == F.col("old.last_modified"))
    status = F.when(F.col("old").isNull(), "no_response").when(agrees.isNull(), "unverified").when(agrees, "resolved").otherwise("mismatch")
    fresh = F.map_filter("headers", lambda k, _: F.lower(k).isin(PERMITTED))
    kept = F.map_filter(F.col("old.headers"), lambda k, _: ~F.array_contains(F.map_keys("fresh"), k))
    return (revisits.withColumn("fresh", fresh).withColumn("status", status)
            .select("record_id", "url_key", F.col("old.record_id").alias("response_id"), "status",
                    F.when(F.col("status") == "resolved", F.map_concat(kept, F.col("fresh"))).alias("headers")))
