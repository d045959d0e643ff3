"""Suffix rules, long term lists, one file per row, and groups of a fixed size."""

import json
import random

import pytest
from pyspark.sql import functions as F

from deckmill.functions import terms
from deckmill.functions import text as tx
from deckmill.operators import batches, policy, suffixes
from deckmill.sinks import files
from deckmill.sources import tables
from deckmill.streaming import groups, watch

RULES = ["com", "uk", "co.uk", "*.ck", "!www.ck", "*.kawasaki.jp", "!city.kawasaki.jp", "jp", "blogspot.com", " // nothing", "// more", ""]


def test_suffix_rules(spark):
    want = {"example.com": ("com", "example.com"), "a.b.example.com": ("com", "example.com"), "com": ("com", None), "co.uk": ("co.uk", None),
            "x.co.uk": ("co.uk", "x.co.uk"), "y.x.co.uk": ("co.uk", "x.co.uk"), "ck": ("ck", None), "test.ck": ("test.ck", None), "b.test.ck": ("test.ck", "b.test.ck"),
            "a.b.test.ck": ("test.ck", "b.test.ck"), "www.ck": ("ck", "www.ck"), "www.www.ck": ("ck", "www.ck"), "c.kawasaki.jp": ("c.kawasaki.jp", None),
            "b.c.kawasaki.jp": ("c.kawasaki.jp", "b.c.kawasaki.jp"), "city.kawasaki.jp": ("kawasaki.jp", "city.kawasaki.jp"), "www.city.kawasaki.jp": ("kawasaki.jp", "city.kawasaki.jp"),
            "kawasaki.jp": ("jp", "kawasaki.jp"), "a.blogspot.com": ("blogspot.com", "a.blogspot.com"), "blogspot.com": ("blogspot.com", None),
            "a.local": ("local", "a.local"), "local": ("local", None), "": ("", None)}
    hosts = spark.createDataFrame([(h, 7) for h in want], "host string, __n long").drop("__n")
    parts = suffixes.suffix_and_domain(F.col("host"), suffixes.suffix_labels(F.col("host"), suffixes.SuffixRules.of(RULES)))
    assert {r[0]: (r[1], r[2]) for r in hosts.select("host", *parts).collect()} == want
    rules = spark.createDataFrame([(r,) for r in RULES], "rule string")
    assert {r["host"]: (r["public_suffix"], r["registered_domain"]) for r in suffixes.with_suffix(hosts, "host", rules, ["host"]).collect()} == want


def test_joined_rules_equal_literal_ones(spark):
    rng = random.Random(4)

    def name(most):
        return ".".join(rng.choice("abc") for _ in range(rng.randrange(1, most)))
    rules = [rng.choice(["", "", "*.", "!x."]) + name(4) for _ in range(60)]
    hosts = spark.createDataFrame([(i, rng.choice(["", "x.", "x."]) + name(6)) for i in range(800)] + [(900, None), (901, "")], "id long, host string")
    parts = suffixes.suffix_and_domain(F.col("host"), suffixes.suffix_labels(F.col("host"), suffixes.SuffixRules.of(rules)))
    want = {tuple(r) for r in hosts.where("host is not null").select("id", *parts).collect()}
    got = suffixes.with_suffix(hosts, "host", spark.createDataFrame([(r,) for r in rules], "rule string"), ["id"])
    assert {tuple(r) for r in got.where("host is not null").select("id", "public_suffix", "registered_domain").collect()} == want
    assert got.where("id = 900").first()["public_suffix"] == "" and got.count() == 802
    assert suffixes.with_suffix(hosts.limit(0), "host", spark.createDataFrame([], "rule string"), ["id"]).count() == 0


def test_long_lists_of_suffixes_are_joined(spark, monkeypatch):
    rng = random.Random(3)
    listed = [(rng.choice(["tld", "tld", "pirate"]), rng.choice(["", "."]) + "".join(rng.choice("ab.") for _ in range(rng.randrange(1, 7)))) for _ in range(30)]
    listed += [("tld", "z" * 300), ("tld", ""), ("research", "b.a")]
    table = spark.createDataFrame(listed, "rule string, value string")
    rows = spark.createDataFrame([(i, "http://" + "".join(rng.choice("ab.") for _ in range(rng.randrange(9))) + "/x") for i in range(400)] + [(900, None), (901, "x")], "id long, url string")
    want = {r["id"]: r["block_reason"] for r in policy.with_block_reason(rows, "url", table).collect()}
    assert {"tld", "pirate", None} <= set(want.values())
    monkeypatch.setattr(policy.scale, "small_table", lambda df, limit=0: None)
    assert {r["id"]: r["block_reason"] for r in policy.with_block_reason(rows, "url", table, ["id"]).collect()} == want


def test_thousands_of_terms_hit_as_single_ones_do(spark):
    rng = random.Random(1)
    listed = sorted({"".join(rng.choice("abcdeé漢 ") for _ in range(rng.randrange(2, 6))) for _ in range(6000)})[:5000] + ["", "ab", "ab"]
    texts = ["".join(rng.choice("abcdeé漢 ") for _ in range(rng.randrange(400))) for _ in range(60)] + ["", None, "zzz"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = {r["id"]: r["h"] for r in rows.select("id", terms.term_hits(F.col("text"), listed).alias("h")).collect()}
    assert found == {i: None if t is None else sorted({x for x in listed if x and x in t}) for i, t in enumerate(texts)}
    few = listed[:40]
    same = rows.select(terms.term_hits(F.col("text"), few).alias("a"), tx.keyword_hits(F.col("text"), few).alias("b"),
                       terms.contains_any_term(F.col("text"), few).alias("c"), tx.contains_any(F.col("text"), few).alias("d"))
    assert all(r.a == r.b or r.a is None for r in same.collect()) and all(bool(r.c) == bool(r.d) for r in same.collect())
    assert [r.h for r in rows.select(terms.term_hits(F.col("text"), []).alias("h")).collect()] == [None if t is None else [] for t in texts]
    words = [t for t in listed if t]
    flagged = policy.keyword_policy(rows, ["text"], words).collect()
    assert {r["id"]: r["keyword_hit"] for r in flagged} == {i: any(w in (t or "") for w in words) for i, t in enumerate(texts)}


def test_one_file_per_row(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{i % 3}/f{i}.pptx", bytes([i]) * i) for i in range(40)] + [(None, b"x"), ("empty.ppt", None)], "name string, body binary")
    for _ in range(2):  # a repeated job leaves one copy
        files.write_files(rows.repartition(5), str(tmp_path), F.col("name"), F.col("body"))
    found = {str(p.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assert found == {**{f"d{i % 3}/f{i}.pptx": bytes([i]) * i for i in range(40)}, "empty.ppt": b""}
    files.write_files(rows.limit(0), str(tmp_path / "none"), F.col("name"), F.col("body"))
    assert not [p for p in (tmp_path / "none").rglob("*") if p.is_file()]


@pytest.mark.parametrize("bad", ["../out.pptx", "/etc/x", ""])
def test_a_failed_task_leaves_no_file_behind(spark, tmp_path, bad):
    rows = spark.createDataFrame([(f"f{i}.pptx", b"x") for i in range(30)] + [(bad, b"x")], "name string, body binary")
    with pytest.raises(Exception):
        files.write_files(rows.repartition(4), str(tmp_path / "out"), F.col("name"), F.col("body"))
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_sidecar_files(spark, tmp_path):
    rows = spark.createDataFrame([("a.pptx", "é"), ("b.ppt", "t")], "filename string, title string")
    files.write_sidecar_files(rows, str(tmp_path), F.to_json(F.struct("title")), F.col("filename"))
    assert {p.name: json.loads(p.read_text()) for p in tmp_path.glob("*.json")} == {"a.pptx.meta.json": {"title": "é"}, "b.ppt.meta.json": {"title": "t"}}


def test_groups_are_full_whatever_arrives(spark, tmp_path):
    out, schema = str(tmp_path), "id long, s string"
    run = groups.group_batch(out, 10, ["id"], schema)
    at, want = 0, []
    for epoch, n in enumerate([3, 0, 25, 2, 9, 10, 4]):
        rows = spark.createDataFrame([(i, "x") for i in range(at, at + n)], schema).repartition(3)
        for _ in range(2 if epoch in (2, 4, 5) else 1):  # repeated micro-batches
            run(rows, epoch)
        at += n
        want = [(i, i // 10 + 1) for i in range(at // 10 * 10)]
        assert sorted((r["id"], r["group_no"]) for r in groups.published(spark, out, schema).collect()) == want
    # a part without a commit is not read
    spark.createDataFrame([(999, "x", 99)], schema + ", group_no long").write.json(f"{out}/groups/part_id=lost")
    for _ in range(2):
        groups.flush(spark, out, 10, ["id"], schema)
    got = sorted((r["id"], r["group_no"]) for r in groups.published(spark, out, schema).collect())
    assert got == [(i, i // 10 + 1) for i in range(at)]
    run(spark.createDataFrame([(1000, "y")] * 12, schema), 7)
    got = [r["group_no"] for r in groups.published(spark, out, schema).where("id = 1000").collect()]
    assert got == [7] * 10 and watch._part(spark, 3) == "3"


def test_a_large_dump_is_split_by_record(spark, tmp_path):
    good = "<record>\n<recordInfo/><metadata><dc><d:identifier>http://r.org/{}.pptx</d:identifier></dc></metadata></record>\n"
    bad = "<record><metadata><dc><d:identifier>http://r.org/bad{}.pptx</d:identifier></metadata></record>\n"
    text = "<OAI-PMH xmlns:d='e'><ListRecords>\n" + "".join((bad if i % 10 == 3 else good).format(i) + "<record id='1'><recordInfo>http://r.org/x.ppt</recordInfo></record><record/>" for i in range(3000)) + "</ListRecords></OAI-PMH>"
    (tmp_path / "dump.xml").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        found = tables.harvest_dump_links(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() >= 4
        assert sorted(r.link for r in found.collect()) == sorted(f"http://r.org/{i}.pptx" for i in range(3000) if i % 10 != 3)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_source_quota_equals_counting_all(spark):
    rng = random.Random(7)
    for target in (1, 5, 20, 200):
        rows = [(i, rng.choice(["a", "a", "a", "b", "c", None, "d"])) for i in range(120)]
        df = spark.createDataFrame(rows, "path long, source string")
        own = {s: [p for p, x in rows if x == s] for s in ("b", "a", "c")}
        taken = batches.source_allocation({s: len(p) for s, p in own.items()}, ["b", "a", "c"], target)
        got = batches.source_quota(df, ["b", "a", "c"], target, ["path"]).collect()
        assert sorted((r.path, r.source_seq) for r in got) == sorted((p, n + 1) for s, k in taken.items() for n, p in enumerate(own[s][:k]))


def test_deck_stream_reads_many_small_files_in_few_tasks(spark, tmp_path):
    from deckmill.streaming import watch

    (tmp_path / "in").mkdir()
    for i in range(600):
        (tmp_path / "in" / f"{i}.pptx").write_bytes(b"x")
    before, tasks = spark.conf.get("spark.sql.files.openCostInBytes"), []
    watch.start(watch.watch_decks(spark, f"{tmp_path}/in"), lambda rows, epoch: tasks.append((rows.rdd.getNumPartitions(), rows.count())), f"{tmp_path}/checkpoint").awaitTermination()
    assert len(tasks) == 1 and tasks[0][0] <= spark.sparkContext.defaultParallelism and tasks[0][1] == 600
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_deck_stream_keeps_its_list_on_disk(spark, tmp_path):
    """What is met, and the order in which it is handed on, as with Spark's file source; paths and bytes too."""
    import os
    import time

    src, seen = tmp_path / "in %41", {"own": [], "spark": []}
    (src / "sub").mkdir(parents=True)

    def once():
        for kind, options in (("own", {"state": f"{tmp_path}/state"}), ("spark", {})):
            def run(rows, epoch, kind=kind):
                found = sorted((r.path, r.name, r.folder, r.extension, r.file_size, r.mtime, bytes(r.content)) for r in rows.collect())
                seen[kind] += [found] if found else []
            watch.start(watch.watch_decks(spark, str(src), **options), run, f"{tmp_path}/checkpoint-{kind}").awaitTermination()
        assert seen["own"] == seen["spark"]
        return [[r[1] for r in batch] for batch in seen["own"]]

    assert once() == []
    for name in ("b.pptx", "sub/a c.ppt", "sub/B.PPTX", "x.txt", ".h.pptx", "_h.pptx", "_k=1.ppt", "c.pptx._COPYING_"):
        (src / name).write_bytes(name.encode())
    (src / "_gone").mkdir()
    (src / "_gone" / "d.pptx").write_bytes(b"d")
    first = [["_k=1.ppt", "b.pptx", "a c.ppt"]]
    assert once() == first and once() == first
    (src / "a.pptx").write_bytes(b"a")
    (src / "empty.pptx").write_bytes(b"")
    os.utime(src / "a.pptx", (time.time() - 86400,) * 2)  # an older file that was moved in
    (src / "b.pptx").write_bytes(b"again")
    assert once() == [*first, ["a.pptx"]]
    assert once() == [*first, ["a.pptx"]]
    listing = watch.watch_decks(spark, str(src), state=f"{tmp_path}/state", content=False)
    again = []
    watch.start(listing, lambda rows, epoch: again.append(sorted(rows.columns)) or again.append(sorted(r.name for r in rows.collect())), f"{tmp_path}/checkpoint-new").awaitTermination()
    assert again == [["extension", "file_size", "folder", "mtime", "name", "path"], ["_k=1.ppt", "a c.ppt", "a.pptx", "b.pptx"]]
    with pytest.raises(ValueError, match="max_files"):
        watch.watch_decks(spark, str(src), max_files=1, state=f"{tmp_path}/state")


def test_arrivals_are_sorted_and_merged_in_runs(tmp_path):
    from deckmill.sources import arrivals

    rng, state = random.Random(2), arrivals.State(f"{tmp_path}/state")
    left, met = [(f"file:/in/{i}.ppt", i, i * 10) for i in range(1000)], []
    rng.shuffle(left)
    for wave, count in enumerate((300, 1, 699), 1):
        there = [*met, *left[:count]]
        rng.shuffle(there)
        scratch = tmp_path / f"scratch-{wave}"
        scratch.mkdir()
        assert state.advance(arrivals.in_order(there, str(scratch), most=64)) == wave
        assert len(list(scratch.iterdir())) == -(-len(there) // 64)
        with state.open("wave", wave) as table:
            assert list(arrivals._rows(table.iter_batches())) == sorted(left[:count])
        met, left = there, left[count:]
        assert list(state.paths("met", wave)) == sorted(m[0] for m in met) and state.lists() == [wave]
        # a wave that no list counts was not handed on, and is found again
        state.files.copy_file(state.path("wave", wave), state.path("wave", wave + 1))
    assert state.advance(arrivals.in_order(met, str(scratch), most=2000)) == 3
    assert list(arrivals.by_size([("a", 0, 5), ("b", 0, 6), ("c", 0, 1)], 4, 10)) == [[("a", 0, 5), ("b", 0, 6)], [("c", 0, 1)]]


def test_scans_of_many_files_are_gathered(spark):
    from deckmill.operators import scale

    most = max(256, 16 * spark.sparkContext.defaultParallelism)
    assert scale.gathered(spark.range(0, 3000, 1, 1000)).rdd.getNumPartitions() == most and scale.gathered(spark.range(0, 9, 1, 3)).rdd.getNumPartitions() == 3


def test_file_writer_makes_a_folder_once():
    from deckmill.sinks import files

    class Made(list):
        def create_dir(self, folder, recursive):
            self.append(folder)

    made = Made()
    folders = files.Folders(made, "top")
    for folder in ("top", "top/a", "top/b/c", "top/a", "top/b"):
        folders.add(folder)
    assert made == ["top/a", "top/b", "top/b/c"]
