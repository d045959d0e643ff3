"""The building blocks for skewed keys against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from deckmill.operators import batches, dedup, ledger, policy, scale


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; some keys are null."""
    rnd = random.Random(5)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rnd.randrange(200)}", rnd.randrange(50)) for i in range(6000)]
    return rows, spark.createDataFrame(rows, "id int, key string, v int").repartition(7)


def test_attach_hot_and_null_keys(skewed):
    rows, df = skewed
    counts = Counter(k for _, k, _ in rows if k is not None)
    facts = df.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    for limit in (0, 100, 10 ** 9):
        got = {r.id: r.n for r in scale.attach(df, facts, ["key"], "n", ["id"], hot_rows=limit).collect()}
        assert got == {i: counts[k] if k is not None else None for i, k, _ in rows}


def test_attach_spreads_hot_rows(skewed):
    _, df = skewed
    facts = df.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    plan = scale.attach(df, facts, ["key"], "n", ["id"], hot_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "__salt" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_number_rows_is_a_total_order(skewed):
    rows, df = skewed
    got = sorted((r.seq, r.v, r.id) for r in scale.number_rows(df, ["v", "id"], "seq", 5).collect())
    assert [(v, i) for _, v, i in got] == sorted((v, i) for i, _, v in rows)
    assert [s for s, _, _ in got] == list(range(5, 5 + len(rows)))


def test_number_in_group(skewed):
    rows, df = skewed
    groups = defaultdict(list)
    for i, k, v in rows:
        if k is not None:
            groups[k].append((v, i))
    want = {i: n for g in groups.values() for n, (_, i) in enumerate(sorted(g), 1)}
    got = {r.id: r.seq for r in scale.number_in_group(df.where("key is not null"), ["key"], ["v", "id"], "seq", ["id"]).collect()}
    assert got == want


@pytest.mark.parametrize("cap", [1, 7, 5000])
def test_top_per_key(skewed, cap):
    rows, df = skewed
    groups = defaultdict(list)
    for i, k, v in rows:
        groups[k].append((-v, i))
    want = {i for g in groups.values() for _, i in sorted(g)[:cap]}
    assert {r.id for r in scale.top_per_key(df, ["key"], [F.desc("v"), "id"], cap, ["id"]).collect()} == want


def test_first_and_last_per_key(skewed):
    rows, df = skewed
    first = {r.key: r.id for r in scale.first_per_key(df, ["key"], ["v", "id"]).collect()}
    last = {r.key: r.id for r in scale.last_per_key(df, ["key"], ["v", "id"]).collect()}
    groups = defaultdict(list)
    for i, k, v in rows:
        groups[k].append((v, i))
    assert first == {k: min(g)[1] for k, g in groups.items()}
    assert last == {k: max(g)[1] for k, g in groups.items()}


def test_first_rows_beyond_the_small_limit(spark):
    df = spark.range(30_000).withColumn("r", F.xxhash64("id"))
    want = [r.id for r in df.orderBy("r").limit(25_000).collect()]
    assert sorted(r.id for r in scale.first_rows(df, ["r"], 25_000).collect()) == sorted(want)


def test_mark_copies_is_idempotent(skewed):
    _, df = skewed
    kept = dedup.mark_copies(df, ["key"], ["v", "id"], ["id"]).where("not is_copy").drop("is_copy", "keeper")
    again = dedup.mark_copies(kept, ["key"], ["v", "id"], ["id"])
    assert again.where("is_copy").count() == 0
    assert kept.where("key is null").count() == df.where("key is null").count()


@pytest.mark.parametrize("small", [0, 10 ** 6])
def test_ledger_flags_and_repeat_append(spark, skewed, small):
    rows, df = skewed
    seen = spark.createDataFrame([("hot",), ("k1",), ("k1",), ("absent",)], "key string")
    left = {r.id for r in ledger.drop_seen(df, seen, ["key"], ["id"], small_rows=small).collect()}
    assert left == {i for i, k, _ in rows if k not in ("hot", "k1")}
    fresh = ledger.new_entries(df, seen, "key")
    assert ledger.new_entries(df, seen.union(fresh), "key").count() == 0


def test_release_keeps_repeats(spark):
    lines = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "tag string")
    gone = spark.createDataFrame([("a",), ("a",)], "tag string")
    assert sorted(r.tag for r in ledger.release(lines, gone).collect()) == ["b", "b", "c"]


def test_policy_join_equals_literals(spark):
    hosts = ["http://a.x.org/1", "http://x.org", "http://notx.org", "http://x.org:8080/", "https://B.GOV", "http://m.mit.edu/a",
             "http://any.edu", "mailto:x", "", "http://.x.org", "http://deep.sub.lab.gov.uk/", "ftp://y.us", "http://us"]
    df = spark.createDataFrame(list(enumerate(hosts)), "id int, url string")
    table = spark.createDataFrame([("pirate", "X.org"), ("tld", ".gov"), ("tld", ".us"), ("institution", "mit.edu"), ("commercial", "lab.gov.uk")],
                                  "rule string, value string")
    literal = policy.with_block_reason(df, "url", table)
    joined = policy.block_reason_by_join(df, "url", table, ["id"])
    want = {0: "pirate", 1: "pirate", 2: None, 3: None, 4: "tld", 5: "institution", 6: "edu", 7: None, 8: None, 9: "pirate",
            10: "commercial", 11: "tld", 12: None}
    assert {r.id: r.block_reason for r in literal.collect()} == want
    assert {r.id: r.block_reason for r in joined.collect()} == want


def test_policy_table_beyond_the_limit_is_joined(spark, monkeypatch):
    monkeypatch.setattr(policy.DomainPolicy, "from_table", classmethod(lambda cls, *a: None))
    df = spark.createDataFrame([(1, "http://a.x.org/1")], "id int, url string")
    table = spark.createDataFrame([("pirate", "x.org")], "rule string, value string")
    assert policy.with_block_reason(df, "url", table, ["id"]).first().block_reason == "pirate"


def test_size_checks(spark):
    df = spark.range(30)
    assert scale.is_small(df, 30) and not scale.is_small(df, 29)
    assert len(scale.small_table(df, 30)) == 30 and scale.small_table(df, 29) is None


def test_long_policy_table_is_joined(spark):
    """More entries than the small-set limit, one of them hit by most hosts."""
    entries = spark.range(scale.SMALL_ROWS + 5).select(F.lit("commercial").alias("rule"), F.concat(F.lit("c"), F.col("id").cast("string"), F.lit(".org")).alias("value"))
    entries = entries.union(spark.createDataFrame([("pirate", "hot.net"), ("tld", ".gov")], "rule string, value string"))
    urls_ = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("http://h"), F.col("id").cast("string"), F.lit(".hot.net/")))
                                     .when(F.col("id") % 3 == 1, F.concat(F.lit("http://a.c"), F.col("id").cast("string"), F.lit(".org/")))
                                     .otherwise("http://x.gov/").alias("url"))
    got = policy.with_block_reason(urls_, "url", entries, ["id"]).groupBy("block_reason").count().collect()
    assert {r.block_reason: r["count"] for r in got} == {"pirate": 1000, "commercial": 1000, "tld": 1000}


def test_collisions_end_unique(spark):
    names = ["a.pptx", "a.pptx", "a_1.pptx", "a.pptx", "b", "b", "a_1.pptx", "c.ppt"]
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    taken = spark.createDataFrame([("c.ppt",)], "name string")
    got = {r.id: r.dest_name for r in dedup.resolve_collisions(df, "name", ["id"], taken=taken).collect()}
    assert len(set(got.values())) == len(names) and "c.ppt" not in got.values()
    assert got[0] == "a.pptx" and got[2] == "a_1.pptx" and got[4] == "b" and got[5] == "b_1"


def test_medium_quota():
    for high in range(3000):
        assert batches.medium_cap(high) == int((high / 0.70) * 0.30)


@pytest.mark.parametrize("available,target", [({"a": 5, "b": 100, "c": 100}, 90), ({"a": 50, "b": 50}, 60), ({"c": 9}, 2), ({}, 10), ({"a": 99, "b": 99, "c": 99}, 2)])
def test_source_allocation_follows_the_loop(available, target):
    sources, total, want = ["a", "b", "c"], 0, {}
    for i, source in enumerate(sources):
        if total >= target:
            break
        share = max(target - total if i == 2 else target // 3, 1)
        want[source] = min(share, available.get(source, 0))
        total += want[source]
    assert batches.source_allocation(available, sources, target) == want
