"""Near-duplicates and mixing against brute force."""

import random
from collections import defaultdict

from deckmill.llm import hamming, mixing
from deckmill.llm.components import components


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t, _ in rows if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1:]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and find(i) != find(j):
                up[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in up}


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 + str(rng.randrange(9999)) if rng.random() < share else w for w in words]


def corpus(seed, families=12, copies=14):
    rng, rows = random.Random(seed), []
    for f in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(4, 160))]
        for _ in range(rng.randrange(1, copies)):
            words = edited(rng, base, rng.choice([0, 0.01, 0.03, 0.05, 0.08]))
            rows.append((len(rows), " ".join(words[:len(words) - rng.choice([0, 0, len(words) // 5])]), f"s{f % 3}"))
    rng.shuffle(rows)
    return [(n, t, s) for n, (_, t, s) in enumerate(rows)]


def test_links_as_brute_force(spark, docs):
    for seed in (1, 2):
        rows = corpus(seed)
        found = {r["doc_id"]: r for r in hamming.near_duplicates(docs(rows)).collect()}
        want = brute(rows)
        assert {i: r["component_id"] for i, r in found.items()} == want
        assert all(r["kept"] == (i == want[i]) and r["n_shingles"] == len(shingle_set(rows[i][1])) for i, r in found.items())


def test_one_large_family_of_near_copies(spark, docs):
    """Most copies are linked to the original only, which is not the least id."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = [(i, " ".join(base if i == 200 else edited(rng, base, 0.03)), "a") for i in range(400)]
    found = {r["doc_id"]: r["component_id"] for r in hamming.near_duplicates(docs(rows)).collect()}
    assert found == brute(rows)


def test_odd_rows(spark, odd, docs):
    rows = hamming.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_shingles"] == 0 and by_id[1]["component_id"] == 1 and by_id[1]["kept"]
    assert by_id[3]["kept"] and by_id[5]["component_id"] == 4 and by_id[7]["component_id"] == 6
    left = hamming.without_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["1", "2", "3", "4", "None", "6", "8", "9"])
    assert hamming.near_duplicates(docs([])).count() == 0
    assert hamming.without_near_duplicates(docs([])).count() == 0


def test_signature_keys_cover_all_errors(spark):
    """Any two signatures that differ in at most 23 symbols share a key."""
    from pyspark.sql import functions as F
    rng = random.Random(3)
    rows = []
    for n in range(60):
        a = bytes(rng.randrange(256) for _ in range(hamming.SYMBOLS))
        b = bytearray(a)
        for at in rng.sample(range(hamming.SYMBOLS), 23):
            b[at] ^= rng.randrange(1, 256)
        rows.append((n, *([int.from_bytes(bytes(x)[c * 6:c * 6 + 6], "little") for c in range(12)] for x in (a, b))))
    df = spark.createDataFrame(rows, "n int, a array<long>, b array<long>")
    shared = df.select(F.size(F.array_intersect(hamming._keys(F.col("a")), hamming._keys(F.col("b")))).alias("k"), hamming._differences(F.col("a"), F.col("b")).alias("d"))
    assert all(r["k"] > 0 and r["d"] == 23 for r in shared.collect())


def test_the_count_of_differences_names_each_chunk_twice():
    """Plans hold this expression several times, and the driver plans them again after every stage."""
    from pyspark.sql import functions as F
    assert str(hamming._differences(F.col("a"), F.col("b"))).count("element_at(a") <= 2 * hamming.CHUNKS


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    for local_edges in (0, 1000):  # in rounds, and in one task
        found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), local_edges=local_edges).collect()}
        assert all(found[i] == 0 for i in range(301)) and all(found[1000 + i] == 1000 for i in range(50))
        assert components(spark.createDataFrame([], "a long, b long"), local_edges=local_edges).count() == 0


def targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest, open_ = total - sum(fixed.values()), [s for s in order if s not in fixed]
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s] + 1e-9]
        if not over:
            return {**fixed, **share}
        fixed |= {s: most * sizes[s] for s in over}


def test_mix_reaches_its_targets(spark, docs):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice(["a", "a", "a", "a", "b", "c", None])) for i in range(900)]
    rows += [(1000 + i, "tiny source", "aa") for i in range(3)]
    found = mixing.mix(docs(rows)).collect()
    again = mixing.mix(docs(rows[::-1])).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want, taken = targets(sizes), defaultdict(int)
    source = {i: s for i, _, s in rows}
    for r in found:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 60 for s in want)
    mixed = mixing.mixed(docs(rows))
    assert mixed.columns == docs(rows).columns and mixed.count() == sum(r["copies"] for r in found)


def test_mix_odd_rows(spark, odd, docs):
    assert mixing.mix(odd).count() == odd.count()
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mix(docs([])).count() == 0 and mixing.mixed(docs([])).count() == 0
    assert [r["taken"] for r in mixing.mix(docs([(1, "", "a"), (2, None, None)])).collect()] == [0, 0]
