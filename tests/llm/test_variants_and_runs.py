"""Spelling variants and periodic runs against brute force."""

import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deckmill.llm import periodic_runs, spelling_variants
from deckmill.llm.queries import op11_spelling_variants, op13_periodic_runs

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute_counts(rows, shortest, least, every=199):
    total = Counter()
    for doc, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
            h = zlib.crc32(f"{doc}:{word}".encode())
            if h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= shortest and n >= least}


def brute_variants(counts, ratio):
    near, by_shape = {}, {}
    for w in counts:
        for i in range(len(w)):
            by_shape.setdefault((i, w[:i] + w[i + 1:]), []).append(w)
            by_shape.setdefault(w[:i] + w[i + 1:], []).append(w)
    for w in counts:
        shapes = {v for i in range(len(w)) for v in by_shape.get((i, w[:i] + w[i + 1:]), ())}
        longer = by_shape.get(w, [])
        shorter = [w[:i] + w[i + 1:] for i in range(len(w))]
        near[w] = {v for v in {*shapes, *longer, *(s for s in shorter if s in counts)} if one_edit(v, w)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    rows = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (form[w], root, n, len(near[w]), None if form[w] is None else counts[form[w]])
    return rows


def collected(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_variants_of_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute_variants(brute_counts(rows, 6, 5), 5)
    assert len(want) > 100 and any(v[0] for v in want.values())
    assert collected(op11_spelling_variants(spark, SF)) == want


@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=60, unique=True))
@settings(max_examples=60, deadline=None)
def test_bit_slices_find_exactly_one_edit(words):
    slices = spelling_variants.BitSlices(words)
    for word in [*words, "abab", "é"]:
        bits = slices.near(word)
        assert {w for i, w in enumerate(words) if bits >> i & 1} == {w for w in words if one_edit(w, word)}
        unlike = slices.near(word, unlike_first=2)
        assert {w for i, w in enumerate(words) if unlike >> i & 1} == {
            w for w in words if one_edit(w, word) and (len(word) < 2 or w[:2] != word[:2])}


def test_large_groups_are_cut_into_blocks(spark):
    # a third of the words share their first half: one group of many blocks
    words = [f"prefix{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{'xyz'[i // 676]}end" for i in range(1200)] + [f"{i:06d}" for i in range(0, 2000, 3)]
    counts = {w: 5 + 7 ** (zlib.crc32(w.encode()) % 6) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert collected(spelling_variants.variants(df, 5, block=100)) == brute_variants(counts, 5)


def test_chains_lead_to_the_last_form(spark):
    chain = ["aaaaaa" + "b" * i for i in range(9)]
    counts = {w: 5 ** (i + 1) for i, w in enumerate(chain)}
    got = collected(spelling_variants.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute_variants(counts, 5) and got[chain[0]][1] == chain[-1]


def test_ties_and_odd_rows_of_variants(spark, docs, odd):
    tie = docs([(1, "abcdefg " * 5 + "abcdefh " * 25 + "abcdefi " * 25, "a"), (None, "abcdefg", "b"), (1, "ABCDEFG", "b")])
    got = collected(spelling_variants.variants(spelling_variants.count_words(tie)))
    assert got["abcdefg"] == (None, "abcdefg", 7, 2, None)
    got = collected(spelling_variants.variants(spelling_variants.count_words(tie, least=8)))
    assert got["abcdefh"] == (None, "abcdefh", 25, 1, None)
    assert collected(spelling_variants.variants(spark.createDataFrame([("abcdefg", 5), ("abcdefh", 25), ("abcdefi", 25)], "word string, n long")))["abcdefg"] \
        == ("abcdefh", "abcdefh", 5, 2, 25)
    assert collected(spelling_variants.variants(spelling_variants.count_words(odd, least=2, shortest=1)))
    assert spelling_variants.variants(spelling_variants.count_words(docs([]))).count() == 0


def brute_runs(x, least=24):
    n, found = len(x), {}
    for q in range(1, n // 3 + 1):
        t = 0
        while t + q < n:
            s = t
            while t + q < n and x[t] == x[t + q]:
                t += 1
            if t + q - s >= max(least, 3 * q):
                found.setdefault((s, t + q), q)
            t += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


@st.composite
def repetitive(draw):
    x = draw(st.lists(st.integers(0, draw(st.sampled_from([0, 1, 2, 9]))), max_size=draw(st.sampled_from([40, 150, 400]))))
    for _ in range(draw(st.integers(0, 4))):
        if len(x) < 30:
            break
        start = draw(st.integers(0, len(x) - 10))
        period = draw(st.integers(1, max(1, (len(x) - start) // 3)))
        for i in range(start + period, min(len(x), start + draw(st.integers(2 * period, len(x))))):
            x[i] = x[i - period]
        if draw(st.booleans()):
            x[draw(st.integers(0, len(x) - 1))] = 99
    return x


@given(repetitive())
@settings(max_examples=300, deadline=None)
def test_runs_are_those_of_all_periods(x):
    assert periodic_runs.find(np.array(x, np.int64)) == brute_runs(x)


def test_two_runs_of_one_period_with_a_break():
    unit = list(range(5))
    for broken in ([77], [0, 1, 77], list(range(5, 40))):
        x = unit * 60 + broken + unit * 60 + broken + unit * 60
        assert periodic_runs.find(np.array(x)) == brute_runs(x)


def test_transform_multiplies_exactly():
    rng = np.random.default_rng(0)
    for size in (32, 256):
        t = periodic_runs.Transform.of(size)
        a, b = rng.integers(0, periodic_runs.PRIME, (2, 3, size), np.int64).astype(np.uint64)
        got = t.inverse(t.forward(a) * t.forward(b) % np.uint64(periodic_runs.PRIME))
        for row in range(3):
            want = [sum(int(a[row, j]) * int(b[row, (i - j) % size]) for j in range(size)) % periodic_runs.PRIME for i in range(size)]
            assert got[row].tolist() == want


def test_numbers_beyond_the_prime_are_told_apart():
    x = np.array([i % 3 for i in range(30)] + [periodic_runs.PRIME + i % 3 for i in range(30)])
    assert periodic_runs.find(x) == [(0, 30, 3), (30, 30, 3)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_row(doc, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    best = None
    for s, m, q in runs:
        if best is None or m * best[2] > best[1] * q:
            best = (s, m, q)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(" ".join(kept)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_runs_of_the_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r[0]: tuple(r[1:]) for r in op13_periodic_runs(spark, SF).collect()}
    assert got == {r["doc_id"]: brute_row(r["doc_id"], r["text"]) for r in rows}
    assert any(v[0] for v in got.values())


def test_odd_rows_of_runs(spark, docs, odd):
    got = periodic_runs.find_runs(odd).collect()
    assert len(got) == 11 and all(not r["runs"] for r in got if r["doc_id"] in (1, 2, 3, 4))
    assert [r["collapsed"] for r in got if r["doc_id"] in (1, 2, 3)] == ["", "", ""]
    text = "x " + "a b c " * 10 + "d\n\n" + "z " * 24
    rows = periodic_runs.find_runs(docs([(1, text, "a"), (1, text, "a"), (None, "a " * 23, "a")])).collect()
    assert sorted((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows) == [
        (0, [], ("a " * 23).strip()), *[(1, [(1, 30, 3), (32, 24, 1)], "x a b c d z")] * 2]
    assert periodic_runs.find_runs(docs([])).count() == 0


def test_strongest_run_compares_exactly(spark):
    runs = spark.createDataFrame([([(9, 24, 8), (0, 30, 10), (50, 300, 100)],), ([(0, 7 * 10 ** 9 + 1, 10 ** 9), (1, 7 * 10 ** 9 + 2, 10 ** 9)],), ([],)],
                                 f"runs {periodic_runs.RUN}")
    assert [r[0] and tuple(r[0]) for r in runs.select(periodic_runs.strongest(runs["runs"])).collect()] == [
        (0, 30, 10), (1, 7 * 10 ** 9 + 2, 10 ** 9), None]
