"""The pipeline's stages, each on what the one before kept, against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from deckmill.llm import pairwise

PLAIN = "the of and to in is it for on as with by at from that this".split()


def prose(rng, n, start):
    return " ".join(rng.choice(PLAIN) if rng.random() < 0.4 else f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{start}{rng.randrange(900)}" for _ in range(n))


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute_force_kept(rows):
    """Least id of each group of texts linked at 0.75, and documents without words."""
    sets, group = {i: shingles(t) for i, t, *_ in rows}, {i: i for i, *_ in rows}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {i for i in ids if root(i) == i}


def tables(spark, path):
    rng = random.Random(12)
    texts = [prose(rng, rng.randrange(60, 200), "x") + "." for _ in range(60)]
    items = [prose(rng, 40, "q") for _ in range(3)]
    texts += [texts[0], texts[0].upper(), texts[1] + " and more", " ".join(texts[2].split()[:-2])]
    texts += [f"{prose(rng, 60, 'x')} {items[0]} {prose(rng, 60, 'x')}", items[1]]
    texts += [f"!!! ### {i} $$$ @@@ %%% {i} ###" for i in range(40)] + [None, "", " \t", "one", "one"]
    rows = [(i, t, "en", ["s0", "s1", None][i % 3], len(t or ""), 7, "x") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, hash long, score string").coalesce(2).write.parquet(f"{path}/documents.parquet")
    marked = [(i, int(i < 66), 0) for i in range(len(rows))]
    spark.createDataFrame(marked, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows


def test_stages_against_brute_force(spark, tmp_path):
    rows = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    taught = [(i, int(i < 66)) for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 != 0]
    assert labels.count() == len(rows) and taught
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        kept[name] = (before, docs)
        if name != "token ids":
            assert docs.columns == columns

    def found(frame):
        return sorted(tuple(r) for r in frame.collect())

    by_id = {r[0]: r for r in rows}
    # quality: whole rows, by the score of the operator's own ranking; clean prose stays, junk goes
    before, after = kept["quality classifier"]
    ids = {r["doc_id"] for r in after.collect()}
    ranking = pairwise.train(before, labels.where("crc32(cast(doc_id as string)) % 5 != 0"), most_labelled=20_000, threshold=0.3)
    assert ids == {r[0] for r in before.select("doc_id", pairwise.score(before["text"], ranking).alias("s")).collect() if r["s"] >= 0.3}
    assert set(range(66)) - ids == set() and len(ids & set(range(66, 106))) <= 2
    assert found(after) == sorted((by_id[i] for i in ids), key=lambda r: r[0])
    # near-duplicates
    before, after = kept["near-duplicates"]
    assert {r["doc_id"] for r in after.collect()} == brute_force_kept([tuple(r) for r in before.collect()])
    # decontamination: the two planted documents go, the others stay
    before, after = kept["benchmark decontamination"]
    gone = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in after.collect()}
    assert gone == {64, 65}
    # mixing: words a source takes come near its target
    before, after = kept["mixing"]
    size = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in before.collect()}
    times = {}
    for r in after.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert tuple(r) == by_id[r["doc_id"]]
    own, weights, target, open_sources = {}, {}, {}, []
    for i, n in size.items():
        own[by_id[i][3]] = own.get(by_id[i][3], 0) + n
    for k, source in enumerate(sorted(own, key=lambda s: (s is None, s or ""))):
        weights[source] = (5, 2, 1)[k % 3]
    left, open_sources = float(sum(own.values())), list(own)
    while True:
        share = {s: left * weights[s] / sum(weights[o] for o in open_sources) for s in open_sources}
        above = [s for s in open_sources if share[s] > 3.0 * own[s]]
        if not above:
            target.update(share)
            break
        for s in above:
            target[s] = 3.0 * own[s]
            left -= target[s]
            open_sources.remove(s)
    for source in own:
        taken = sum(times.get(i, 0) * n for i, n in size.items() if by_id[i][3] == source)
        assert abs(taken - target[source]) <= max(size.values())
    assert all(times.get(i, 0) <= 3 for i in size)
    # token ids
    before, after = kept["token ids"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = []
    for r in before.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        want.append((r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = sorted(after.collect(), key=lambda r: r["start"])
    assert sorted(want) == sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got)
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:n]) for n in range(len(got))]


def test_empty_documents_pass_all_stages(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}.parquet")
        docs = spark.read.schema(docs.schema).parquet(f"{tmp_path}/{name}.parquet")
        assert docs.count() == 0
