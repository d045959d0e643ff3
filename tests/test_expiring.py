"""Dedup with expiring state against the plain rule, over several micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from deckmill.streaming import expiring, watch


@pytest.fixture
def rocksdb(spark):
    before = expiring.use_rocksdb(spark)
    yield
    spark.conf.unset(expiring.PROVIDER) if before is None else spark.conf.set(expiring.PROVIDER, before)


def plain(rows, period):
    until, out = {}, []
    for key, at, n in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in until or at >= until[key]:
            until[key] = at + period
            out.append(n)
    return sorted(out)


def run_waves(spark, tmp_path, waves, period, delay):
    state_rows = []
    for wave in waves:
        df = spark.createDataFrame(wave, "key string, at bigint, n bigint").select("key", F.timestamp_seconds(F.col("at") + 1_000_000).alias("at"), "n")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = watch.watch_table(spark, f"{tmp_path}/in", "key string, at timestamp, n bigint")
        rows = expiring.first_per_period(stream, ["key"], "at", period, delay, ["n"])
        query = (rows.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        state_rows.append(query.lastProgress["stateOperators"][0]["customMetrics"].get("numValueStateVars"))
    out = spark.read.schema("key string, at timestamp, n bigint").parquet(f"{tmp_path}/out")
    return sorted(r["n"] for r in out.collect())


def test_keys_pass_again_after_their_period(spark, rocksdb, tmp_path):
    waves = [[("a", 0, 1), ("a", 50, 2), ("b", 10, 3), ("a", 100, 4), ("a", 199, 5)],
             [("a", 200, 6), ("b", 109, 7), (None, 150, 8), (None, 160, 9)],
             [("b", 205, 10), ("a", 260, 11), ("c", 1000, 12)],
             [("a", 1001, 13), ("b", 1002, 14), ("c", 1050, 15)]]
    want = plain([r for w in waves for r in w], 100)
    assert run_waves(spark, tmp_path, waves, 100, "100 seconds") == want and {1, 4, 6, 13, 14} <= set(want)


def test_random_rows_in_order(spark, rocksdb, tmp_path):
    random.seed(5)
    at, rows = 0, []
    for n in range(300):
        at += random.randrange(4)
        rows.append((random.choice("abcdefgh"), at, n))
    waves = [rows[:120], rows[120:200], rows[200:]]
    assert run_waves(spark, tmp_path, waves, 37, "10 seconds") == plain(rows, 37)


def test_state_holds_one_period_only(spark, rocksdb, tmp_path):
    sizes = []
    for wave in range(4):
        rows = [(f"k{wave}-{i}", wave * 1000 + i, i) for i in range(50)]
        df = spark.createDataFrame(rows, "key string, at bigint, n bigint").select("key", F.timestamp_seconds(F.col("at") + 1_000_000).alias("at"), "n")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = watch.watch_table(spark, f"{tmp_path}/in", "key string, at timestamp, n bigint")
        query = (expiring.first_per_period(stream, ["key"], "at", 100, "1 second").writeStream.format("parquet").option("path", f"{tmp_path}/out")
                 .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
        sizes.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    # each wave lies beyond the period of the one before, whose keys are gone
    assert max(sizes[1:]) <= sizes[0] * 2 and sizes[-1] <= sizes[1]


def test_keys_of_one_bucket_keep_apart(spark, rocksdb, tmp_path):
    """Null and very large numbers, texts that look alike and both zeros meet in one bucket, over two micro-batches."""
    big = (1 << 53) + 1
    rows = [(big, "a", 0.0, 0, 1), (big + 1, "a", 0.0, 1, 2), (None, "a", 0.0, 2, None), (big, "a", -0.0, 3, 4), (None, "null", 0.0, 4, 5), (None, None, 0.0, 5, big)]
    for wave in (0, 10):
        df = spark.createDataFrame([(k, t, z, at + wave, n) for k, t, z, at, n in rows], "k bigint, t string, z double, at bigint, n bigint")
        df.withColumn("at", F.timestamp_seconds(F.col("at") + 1_000_000)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = watch.watch_table(spark, f"{tmp_path}/in", "k bigint, t string, z double, at timestamp, n bigint")
        passed = expiring.first_per_period(stream, ["k", "t", "z"], "at", 60, "1 minute", ["n"], buckets=1)
        (passed.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    out = spark.read.schema("k bigint, t string, z double, at timestamp, n bigint").parquet(f"{tmp_path}/out")
    assert {(r.k, r.t, r.n) for r in out.collect()} == {(big, "a", 1), (big + 1, "a", 2), (None, "a", None), (None, "null", 5), (None, None, big)}
    assert out.count() == 5
