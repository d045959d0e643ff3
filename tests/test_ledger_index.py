"""The stored ledger index: what is known, what is read, and what a broken run leaves."""

import re

import pytest
from pyspark.sql import functions as F

from deckmill.operators import ledger_index
from deckmill.operators.ledger_index import LedgerIndex
from deckmill.streaming import watch


def tags(spark, numbers):
    return spark.createDataFrame([(f"tag{i}",) for i in numbers], "tag string")


def values(df):
    return sorted(r[0] for r in df.collect())


def files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan


def test_known_keys_over_runs(spark, tmp_path):
    index = LedgerIndex(spark, str(tmp_path), "tag string", buckets=8)
    assert values(index.known(tags(spark, range(5)))) == []
    index.append(tags(spark, [*range(0, 100), *range(0, 100)]), "a")
    index.append(tags(spark, range(90, 200)), "b")
    assert values(index.known(tags(spark, range(150, 260)))) == sorted(f"tag{i}" for i in range(150, 200))
    assert values(index.known(tags(spark, range(0, 260)), without_run="b")) == sorted(f"tag{i}" for i in range(100))
    again = LedgerIndex(spark, str(tmp_path), "tag string", buckets=99)
    assert again.buckets == 8 and again.entries().distinct().count() == 200


def test_false_positives_are_checked_on_the_keys(spark, tmp_path):
    # so few bits that nearly every sketch lets nearly every key through
    index = LedgerIndex(spark, str(tmp_path), "tag string", buckets=2, bits_per_key=1)
    index.append(tags(spark, range(5000)), "a")
    passed = index.let_through(tags(spark, range(5000, 6000)))
    assert passed.count() > 100
    assert values(index.known(tags(spark, range(4990, 6000)))) == sorted(f"tag{i}" for i in range(4990, 5000))


def test_few_keys_read_few_files_and_the_ledger_is_not_shuffled(spark, tmp_path):
    index = LedgerIndex(spark, str(tmp_path), "tag string", buckets=64)
    index.append(tags(spark, range(4000)), "a")
    index.append(tags(spark, range(4000, 8000)), "b")
    passed = index.let_through(tags(spark, [5, 4005, 100_000, 100_001]))
    pairs = {(r["run"], r["bucket"]) for r in passed.collect()}
    assert {r for r, _ in pairs} == {"a", "b"} and len(pairs) <= 3
    read = {tuple(re.search(r"run=(\w+)/bucket=(\d+)", r[0]).groups()) for r in index.candidates_in(passed).select(F.input_file_name()).distinct().collect()}
    assert read == {(run, str(bucket)) for run, bucket in pairs}
    plan = index.known(tags(spark, [5, 4005]))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters: [((run" in line or "PartitionFilters: [(((run" in line or "/keys" in line)
    assert "bucket" in scan
    join = plan[:plan.index(scan)]
    # between the ledger's scan and the join there is no exchange: the asked keys are broadcast
    assert "BroadcastHashJoin" in join and "SortMergeJoin" not in plan


def test_many_keys_take_the_shuffled_way(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger_index, "FEW_KEYS", 10)
    monkeypatch.setattr(ledger_index, "KEYS_A_ROW", 7)
    index = LedgerIndex(spark, str(tmp_path), "tag string", buckets=4)
    index.append(tags(spark, range(300)), "a")
    assert values(index.known(tags(spark, range(200, 500)))) == sorted(f"tag{i}" for i in range(200, 300))


def test_a_run_without_sketches_is_not_there(spark, tmp_path):
    index = LedgerIndex(spark, str(tmp_path), "tag string", buckets=4)
    index.append(tags(spark, range(10)), "a")
    # what a run leaves that breaks off before its sketches
    tags(spark, range(10, 20)).select("tag", F.lit(0).alias("bucket")).write.partitionBy("bucket").parquet(f"{tmp_path}/keys/run=b")
    assert values(index.known(tags(spark, range(20)))) == sorted(f"tag{i}" for i in range(10)) and index.entries().count() == 10
    index.append(tags(spark, range(15, 18)), "b")
    assert values(index.known(tags(spark, range(10, 20)))) == ["tag15", "tag16", "tag17"]


def test_add_new_and_compact(spark, tmp_path):
    index = LedgerIndex(spark, f"{tmp_path}/i", "tag string", buckets=4)
    assert len(values(index.add_new(tags(spark, range(10)), "a"))) == 10
    for _ in range(2):
        assert values(index.add_new(tags(spark, range(5, 15)), "b")) == sorted(f"tag{i}" for i in range(10, 15))
    small = index.compact(f"{tmp_path}/j")
    assert small.entries().count() == 15 and values(small.known(tags(spark, range(12, 30)))) == ["tag12", "tag13", "tag14"]
    with pytest.raises(ValueError):
        index.append(tags(spark, [1]), "a/b")


def test_two_columns_nulls_hot_keys_and_empty_tables(spark, tmp_path):
    index = LedgerIndex(spark, str(tmp_path), "kind string, user bigint", buckets=4)
    known = spark.createDataFrame([("a", 1), ("a", None), (None, 2), ("b", 2)], "kind string, user bigint")
    index.append(known, "first")
    index.append(known.limit(0), "nothing")
    rows = spark.createDataFrame([(i, *k) for i, k in enumerate([("a", 1)] * 50 + [("a", 2), ("b", 2), (None, 2), ("a", None)])],
                                 "bucket int, kind string, user bigint")
    left = index.drop_seen(rows, ["bucket"])
    assert left.columns == rows.columns and sorted(r["bucket"] for r in left.collect()) == [50, 52, 53]
    assert index.drop_seen(rows.limit(0), ["bucket"]).count() == 0


def test_a_repeated_micro_batch_replaces_itself(spark, tmp_path):
    index = LedgerIndex(spark, f"{tmp_path}/index", "tag string", buckets=4)
    run = watch.indexed_dedup_batch(str(tmp_path), index, ["n"])
    rows = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "tag string, n int")
    for epoch in (0, 0, 1):
        run(rows, epoch)
    accepted = spark.read.schema("tag string, n int, part_id string").parquet(f"{tmp_path}/accepted")
    assert sorted((r["tag"], r["n"]) for r in accepted.collect()) == [("x", 1), ("y", 3)]
