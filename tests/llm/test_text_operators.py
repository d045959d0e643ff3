"""Ids, personal data, decontamination, fingerprints, quality and language-model scores against brute force."""

import hashlib
import itertools
import json
import math
import pathlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deckmill.llm import bloom_lookup, context_mixing, huffman, latent, pairwise, pii

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# ---- token ids
def test_ids_read_back(spark, odd):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    found = sorted(huffman.token_table(odd, TOKENIZER).collect(), key=lambda r: r["start"])
    want = []
    for i, t in odd.select("doc_id", "text").collect():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((-1 if i is None else i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(want) == sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found)
    assert [r["start"] for r in found] == [sum(r["n_tokens"] for r in found[:n]) for n in range(len(found))]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert ids == sorted(ids)


def test_no_ids(spark, docs):
    assert huffman.token_table(docs([]), TOKENIZER).count() == 0


ALPHABETS = ["ab", "aBé", "ÀÉÞßÿ×÷", "żłЖжΣσςİı", "中文", "e\u0301A\u030a", "\0\x1f\xa0", "12", "'", ".,#*<|>&@`", "<|endoftext|>", "\U0001f600"]


@pytest.mark.parametrize("tokenizer", [TOKENIZER, "no end mark"])
@pytest.mark.parametrize("stretch, pieces, words", [(1 << 20, 1 << 20, 300_000), (40, 30, 5)])
def test_ids_of_odd_words(monkeypatch, tmp_path, tokenizer, stretch, pieces, words):
    """Words of one and of mixed alphabets, around the length of a key, over stretches and full caches."""
    for name, value in (("STRETCH", stretch), ("CACHED_PIECES", pieces), ("CACHED_WORDS", words)):
        monkeypatch.setattr(huffman, name, value)
    if tokenizer != TOKENIZER:  # its words are not cut into letters and marks
        plain = json.loads(pathlib.Path(TOKENIZER).read_text()) | {"normalizer": None}
        tokenizer = str(tmp_path / "words.json")
        pathlib.Path(tokenizer).write_text(json.dumps(plain))
    rng, library, ids = random.Random(5), Tokenizer.from_file(tokenizer), huffman.WordIds(tokenizer, "<u2")

    def word():
        parts = rng.choices(ALPHABETS, k=rng.choice((1, 1, 2, 3)))
        return "".join("".join(rng.choices(p, k=rng.choice((1, 2, 6, 13, 14, 15, 16, 40)))) if p[0] != "<" or rng.random() < 0.5 else p for p in parts)

    vocabulary = [word() for _ in range(400)]
    for _ in range(12):
        texts = ["".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "  \t", " \r\f\v "]) for _ in range(rng.choice((0, 1, 30)))) for _ in range(20)]
        texts += ["", " ", "x" * 100, rng.choice(vocabulary)]
        want = [library.encode(t, add_special_tokens=False).ids + [1] for t in texts]
        assert [np.frombuffer(found, "<u2").tolist() for found in ids.texts([t.encode() for t in texts], b"\1\0")] == want


def test_letters_are_encoded_once():
    """Spellings of the same letters, whatever marks follow, go to the library once."""
    ids, sent = huffman.WordIds(TOKENIZER, "<u2"), []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **options):
            sent.extend(w for t in texts for w in re.split(r" |<\|\w+\|>", t))
            return self.inner.encode_batch_fast(texts, **options)

        def encode(self, text, **options):
            sent.append(text)
            return self.inner.encode(text, **options)

    ids.tokenizer, ids.letters = Counted(ids.tokenizer), Counted(ids.letters)
    ids.texts([b"stone Stone### STONE", "stone*** été ÉTÉ### Été&&& été.".encode()], b"\1\0")
    ids.texts(["STONE&&& ÉTÉ***".encode()], b"\1\0")
    assert sorted(sent) == sorted(["stone", "été", "###", "***", "&&&", "."])


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 700):
        counts = rng.zipf(1.4, n).clip(1, 10**9)
        for limit in (10, 18):
            lengths = huffman.code_lengths(counts, limit).astype(int)
            assert lengths.max() <= max(limit, (n - 1).bit_length()) and (0.5 ** lengths).sum() <= 1
        import heapq
        heap, cost = [int(c) for c in counts], 0
        heapq.heapify(heap)
        while len(heap) > 1:
            joined = heapq.heappop(heap) + heapq.heappop(heap)
            cost += joined
            heapq.heappush(heap, joined)
        assert n == 1 or (huffman.code_lengths(counts, 60) * counts).sum() == cost


def test_blocks_decode_alone():
    rng = np.random.default_rng(2)
    blocks = [rng.zipf(1.3, n).clip(1, 5000).astype(np.int64) for n in (1, 255, 256, 257, 4000)]
    symbols, counts = np.unique(np.concatenate(blocks), return_counts=True)
    book = huffman.Codebook(symbols, huffman.code_lengths(counts))
    coded = [huffman.encode_block(b, *book.encoder()) for b in blocks]
    for some in (slice(0, 5), slice(2, 3), slice(4, 5)):
        out = huffman.decode_blocks([c[0] for c in coded[some]], [c[1] for c in coded[some]], [len(b) for b in blocks[some]], book.decoder(), book.bits)
        assert all((a == b).all() for a, b in zip(out, blocks[some]))


# ---- personal data
EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(x if n % 2 == 0 else sum(divmod(2 * x, 10)) for n, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]


def test_base_spans_as_the_patterns(spark, odd, docs):
    rng = random.Random(4)
    texts = ["".join(rng.choice("a1@.+- ()é9%_\n") for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["call +1 (619) 555-0053 4556737586899855 now", "x@y", "a" * 20000 + "@", "1" * 20000, "+1" * 3000, "."]
    assert [pii.base_spans(t) for t in texts] == [plain_spans(t) for t in texts]
    found = pii.find(odd, pii.train(odd)).collect()
    assert len(found) == odd.count() and all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() and r["spans"] == "" for r in found)
    assert pii.find(docs([]), pii.train(docs([]))).count() == 0


def test_field_adds_what_patterns_drop(spark, docs):
    rng = random.Random(6)

    def luhn(n):
        return next(f"{n}{d}" for d in range(10) if pii.luhn(f"{n}{d}"))

    def entity(kind):
        return {"phone": f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", "card": luhn(rng.randrange(10**14, 10**15)),
                "ip": ".".join(str(rng.randrange(256)) for _ in range(4)), "email": f"ab.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com"}[kind]
    kinds = ["phone", "card", "ip", "email"]
    train = [(i, f"the {rng.choice('abc')} of {entity(kinds[i % 4])} and in {rng.randrange(3000)} to", "a") for i in range(300)]
    field = pii.train(docs(train))
    phone, card = entity("phone"), entity("card")
    text = f"write to {phone} {card} today, not in 2019 or 4556737586899854 of 3.14"
    row = pii.find(docs([(1, text, "a")]), field).first()
    spans = {tuple(s.split(":")[:1]) + tuple(map(int, s.split(":")[1:])) for s in row["spans"].split(",") if s}
    assert row["n_phone"] == 0 and {("phone", 9, 9 + len(phone)), ("card", 10 + len(phone), 10 + len(phone) + len(card))} == spans


@pytest.fixture(scope="module")
def personal_field(docs):
    rng = random.Random(6)

    def entity(kind):
        number = rng.randrange(10**14, 10**15)
        return {"phone": f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", "card": next(f"{number}{d}" for d in range(10) if pii.luhn(f"{number}{d}")),
                "ip": ".".join(str(rng.randrange(256)) for _ in range(4)), "email": f"ab.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com"}[kind]
    kinds = ["phone", "card", "ip", "email"]
    return pii.train(docs([(i, f"the {rng.choice('abc')} of {entity(kinds[i % 4])} and in {rng.randrange(3000)} to", "a") for i in range(300)]))


@pytest.mark.parametrize("before, after", [(" ".join(["x1"] * n) + " ", " x1 x1") for n in (0, 5, 44, 45, 46, 47, 48, 49, 67, 68, 94, 95, 96, 97, 143, 500)]
                         + [("漢" * 80, "字" * 80), ("漢" * 80 + " ", " " + "字" * 80), ("ไทย" * 40, "ไทย" * 40), ("x" * 90 + ",", ";" + "y" * 90)])
def test_spans_are_whole_wherever_windows_part(personal_field, before, after):
    phone, card = "+1 (663) 555-6869", "4465758382889437"
    text, at = f"{before}{phone} {card}{after}", len(before)
    own = pii.base_spans(text)
    found = pii.added_spans([text], [own], personal_field)[0]
    assert {("phone", at, at + 17), ("card", at + 18, at + 34)} == {*own, *found}


def test_window_parts_hold_each_token_once():
    rng = random.Random(8)
    for _ in range(300):
        text = " ".join(rng.choice(["7", "a@b", "w", "word", "漢字9", "漢"]) if rng.random() < 0.6 else rng.choice(["w", "v", "u"]) for _ in range(rng.randrange(400)))
        every = list(pii.tokens(text))
        near = {j for i, t in enumerate(every) if pii.TRIGGER.search(text, *t) for j in range(max(0, i - pii.CONTEXT), min(len(every), i + pii.CONTEXT + 1))}
        for margin in (0, pii.MARGIN):
            parts = list(pii.windows_around(text, margin))
            assert [t for window, first, end in parts for t in window[first:end]] == [every[j] for j in sorted(near)]
            assert all(0 <= first <= margin and end - first <= pii.MOST_TOKENS + margin + pii.CONTEXT and len(window) - end <= margin for window, first, end in parts)


def test_viterbi_and_gradient_equal_enumeration(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(pii, "FEATURES", 6)
    field = pii.Field(rng.normal(size=(6, pii.N_TAGS)), rng.normal(size=(pii.N_TAGS, pii.N_TAGS)), rng.normal(size=pii.N_TAGS))
    windows = [rng.integers(0, 6, (n, 2)).tolist() for n in (1, 2, 3, 4, 4, 2)]

    def score(field, window, path):
        return sum(field.emit[f, t] for own, t in zip(window, path) for f in own) + field.first[path[0]] + sum(field.step[a, b] for a, b in zip(path, path[1:]))

    for window, path in zip(windows, field.decode(windows)):
        assert tuple(path) == max(itertools.product(range(pii.N_TAGS), repeat=len(window)), key=lambda p: score(field, window, p))
    # One step of training from zero moves each weight by rate * slope / |slope|: its sign is that of the enumerated slope.
    short, gold = windows[:4], [[1], [0, 3], [1, 2, 0], [0, 0, 5, 6]]
    flat = pii.Field(np.zeros((6, pii.N_TAGS)), np.zeros((pii.N_TAGS, pii.N_TAGS)), np.zeros(pii.N_TAGS))
    slope = np.zeros_like(flat.step)
    for window, own in zip(short, gold):
        for a, b in zip(own, own[1:]):
            slope[a, b] += 1
        paths = list(itertools.product(range(pii.N_TAGS), repeat=len(window)))
        for path in paths:
            for a, b in zip(path, path[1:]):
                slope[a, b] -= 1 / len(paths)
    assert (np.sign(pii.train_field(short, gold, rounds=1).step) == np.sign(slope)).all()


# ---- benchmark items
def test_copied_and_reworded_items_are_found(spark, docs):
    rng = random.Random(9)

    def prose(n, low=0):
        return [rng.choice(["the", "of", "and", "in", "to"]) if rng.random() < 0.4 else f"w{low + rng.randrange(3000)}" for _ in range(n)]
    items = [(i, " ".join(prose(40, 10_000 * (i + 1)))) for i in range(12)]
    rows, held = [], {}
    for i in range(200):
        words = prose(rng.randrange(60, 300))
        if i % 10 == 0:
            item = items[(i // 10) % 12]
            own = item[1].split()
            if i % 20 == 0:  # reworded: every sixth word is another one
                own = [f"other{k}" if k % 6 == 3 else w for k, w in enumerate(own)]
            words[20:20], held[i] = own, item[0]
        rows.append((i, " ".join(words).capitalize() + ".", "a"))
    benchmark = spark.createDataFrame(items + [(99, None), (98, ""), (0, items[0][1])], "item_id long, text string")
    table = docs(rows + [(900, None, None), (901, "", "a")])
    found = {r["doc_id"]: [m["item_id"] for m in r["f"]] for r in table.select("doc_id", latent.leaks(table, benchmark).alias("f")).collect()}
    assert {i: f[0] for i, f in found.items() if f} == held
    left = latent.decontaminated(table, benchmark)
    assert left.columns == table.columns and left.count() == len(rows) + 2 - len(held)
    assert latent.decontaminated(docs([]), benchmark).count() == 0
    assert latent.decontaminated(table, benchmark.limit(0)).count() == len(rows) + 2


def test_a_basis_by_stretches_is_that_of_the_whole():
    rng = np.random.default_rng(3)
    block = (rng.standard_normal((96, 8)) * np.logspace(0, -4, 8)).astype(np.float32)
    basis = block.copy()
    latent.orthonormalise(basis, rows=16)
    whole = np.linalg.qr(block)[0]
    assert np.allclose(basis.T @ basis, np.eye(8), atol=1e-5)
    assert np.allclose(np.abs((basis * whole).sum(0)), 1, atol=1e-4)
    block[:, 3:] = 0
    block[16:48] = 0
    latent.orthonormalise(basis := block.copy(), rows=16)
    assert np.allclose(basis.T @ basis, np.eye(8), atol=1e-5) and np.allclose(basis @ (basis.T @ block), block, atol=1e-5)


def test_the_driver_holds_little_during_the_fit(spark, docs):
    rng = random.Random(9)
    table = docs([(i, " ".join(f"w{rng.randrange(500)}" for _ in range(60)), "a") for i in range(60)])
    items = table.selectExpr("doc_id AS item_id", "text").limit(5)
    tracemalloc.start()
    try:
        space = latent.fit_space(table.select("doc_id", "text"), items, 0.9, 3000)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert space.directions.shape == (latent.FEATURES, latent.RANK)
    assert most < 4 * latent.FEATURES * (latent.RANK + latent.EXTRA) * 4, most


def test_the_fit_takes_all_passages(spark, docs, monkeypatch):
    rng, fits, whole = random.Random(5), [], latent.range_of
    texts = [" ".join(f"w{int(400 * rng.random() ** 2)}" for _ in range(rng.choice([0, 1, 2, 12, 13, 24, 25, 36, 37, 90]))) for _ in range(3500)]
    items = [" ".join(f"w{rng.randrange(500)}" for _ in range(40)) for _ in range(5)]
    monkeypatch.setattr(latent, "range_of", lambda *fit: fits.append(fit) or whole(*fit))
    latent.leaks(docs([(i, t or None, "a") for i, t in enumerate(texts)]), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    (words, weights, seed), = fits
    hashing, rows = latent.Hashing(), []
    for text in texts + items:
        columns = [c for c in hashing.of(text.encode()) if weights[c] > 0]
        for start, end in zip(*latent.bounds(len(columns))):
            row = np.zeros(latent.FEATURES, np.float32)
            for c in columns[start:end]:
                row[c] += weights[c]
            rows.append(row / max(np.linalg.norm(row), 1e-9))
    used = np.flatnonzero(np.any(rows, axis=0))
    a = np.array([row[used] for row in rows], np.float64)
    found, block = np.zeros((latent.FEATURES, latent.RANK + latent.EXTRA)), latent.random_block(seed).astype(np.float64)
    for at, some in whole(words, weights, seed):
        found[at:at + len(some)] = some
    wanted = a.T @ (a @ block[used])
    assert np.allclose(found[used], wanted, atol=1e-5 * np.abs(wanted).max()) and np.count_nonzero(found) == np.count_nonzero(found[used])
    wanted = a @ block[used]
    assert np.allclose(latent.products_in(words, weights, latent.random_block(seed)), wanted.T @ wanted, rtol=1e-4, atol=1e-3 * np.abs(wanted).max())


def test_passages_of_long_texts_by_pieces(monkeypatch):
    rng = np.random.default_rng(6)
    weights, table = rng.random(latent.FEATURES).astype(np.float32), rng.random((latent.FEATURES + 1, 3)).astype(np.float32)
    table[-1], weights[:20] = 0, 0
    texts = [rng.integers(0, 60, n) for n in (0, 1, 200, 3, 83, 84, 85, 11, 12, 13, 96, 97, 170, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.astype("<u2").tobytes() for t in texts], pa.binary())], ["columns"])

    def rows():
        some = [np.column_stack([p.projected(table), p.squares]) for p in latent.passages_of(iter([batch]), weights)]
        return np.array(sorted(np.concatenate(some).round(3).tolist()))
    whole = rows()
    assert len(whole) == sum(len(latent.bounds(n)[0]) for n in (int((t >= 20).sum()) for t in texts) if n)
    for most in (24, 30, 36, 60):
        monkeypatch.setattr(latent, "ROWS", most)
        assert np.allclose(rows(), whole, atol=2e-3)


def test_the_driver_does_not_read_the_tokenizer(docs, monkeypatch):
    monkeypatch.setattr("tokenizers.Tokenizer", None)  # tasks have their own
    assert [r["n_tokens"] for r in huffman.token_table(docs([(1, None, "a"), (2, "", "a")]), TOKENIZER).collect()] == [1, 1]


def test_items_of_common_words_and_short_items_are_found(spark, docs):
    rng = random.Random(4)
    hot, short, pair, one = " ".join(f"hot{k}" for k in range(30)), "the of and", "lone pair", "single"

    def prose():
        return " ".join(rng.choice(["the", "of", "and"]) if k % 3 == 0 else f"w{rng.randrange(3000)}" for k in range(80))
    rows = [(i, f"{prose()} {hot} {prose()}" if i % 3 == 0 else prose(), "a") for i in range(150)]  # a third of all rows
    rows += [(201, f"{prose()} The (of) and; {prose()}", "a"), (202, f"lone pair. {prose()}", "a"),
             (203, f"{prose()} Single", "a"), (204, f"pair lone singled {prose()}", "a")]
    benchmark = spark.createDataFrame([(1, hot), (2, short), (3, pair), (4, one)], "item_id long, text string")
    table = docs(rows)
    found = {r["doc_id"]: [m["item_id"] for m in r["f"]] for r in table.select("doc_id", latent.leaks(table, benchmark).alias("f")).collect()}
    held = {i: [1] for i in range(0, 150, 3)} | {201: [2], 202: [3], 203: [4]}
    assert {i: f for i, f in found.items() if f} == held


def word_check(columns, items):
    """Items that the word check finds among all passages."""
    out = set()
    for start, end in zip(*latent.bounds(len(columns))):
        for item in items:
            half = len(item.columns) // 2 + 1
            segment = columns[max(0, start - half):end + half].tolist()
            share = latent.common_subsequence(segment, item) / len(item.columns)
            answer = len(set(segment) & item.answers) / len(item.answers)
            if share >= 0.75 or share >= 0.5 and answer >= 0.5:
                out.add(item.item_id)
    return out


def test_recall_of_the_latent_search_against_all_pairs():
    rng = np.random.default_rng(8)
    directions = (rng.standard_normal((latent.FEATURES, latent.RANK)) / 12).astype(np.float16)
    space = latent.Space(np.ones(latent.FEATURES, np.float32), directions)
    texts = {i: [f"i{i}x{k}" for k in range(n)] for i, n in enumerate([9, 15, 24, 39, 59, 90] * 3)}
    usual, common = latent.make_items([(i, " ".join(words)) for i, words in texts.items()] + [(99, ""), (98, None)], space, 4)
    assert len(usual) == 18 and not common
    finder, hashing = latent.Finder(space, usual, common).prepared(), latent.Hashing()
    found, wanted = {}, {}
    for i, words in texts.items():
        kinds = {"verbatim": words, "third": [w if k % 3 else f"o{k}" for k, w in enumerate(words)], "stretch": words[:round(0.6 * len(words))],
                 "kept": [w if rng.random() < 0.65 else f"o{k}" for k, w in enumerate(words)]}
        for kind, copy in kinds.items():
            for before in (0, 5, 17, 100, 3000):
                text = " ".join([f"b{k}" for k in range(before)] + copy + [f"a{k}" for k in range(200)]).encode()
                reference = word_check(hashing.of(text), usual)
                got = {m["item_id"]: m for m in finder.matches([b"other text", text], hashing)[1]}
                assert set(got) <= reference
                wanted[kind] = wanted.get(kind, 0) + len(reference)
                found[kind] = found.get(kind, 0) + len(set(got) & reference)
                if kind == "verbatim":
                    assert got[i]["verbatim"] and got[i]["cosine"] > 0.3 and got[i]["lcs_share"] == 1.0
    assert min(wanted.values()) > 30 and all(found[k] >= 0.9 * wanted[k] for k in wanted), (found, wanted)
    assert found["verbatim"] == wanted["verbatim"]


def test_common_items_alone_see_common_words():
    weights = np.ones(latent.FEATURES, np.float32)
    hashing = latent.Hashing()
    lost = hashing.of(b"the of and")
    weights[lost] = 0
    seen = np.ones(latent.FEATURES, np.float32)
    space = latent.Space(weights, np.ones((latent.FEATURES, 4), np.float16), seen)
    usual, common = latent.make_items([(1, "the of and the of and rare word"), (2, "one two three the of four five six")], space, 4)
    assert [i.item_id for i in common] == [1] and len(common[0].columns) == 8
    assert [i.item_id for i in usual] == [2] and len(usual[0].columns) == 6


def test_words_hash_alike_in_any_place():
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abcXé中,.\n") for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(0, 40))).encode() for _ in range(60)]
    texts += [b"", b" ", b"\0 \0\0", b"x" * 5000]
    whole, pieces = latent.Hashing(), latent.Hashing()
    pieces.PIECE = 50
    for got, small, text in zip(whole.of_texts(texts), pieces.of_texts(texts), texts):
        words = latent.words_of(text)
        assert got.tolist() == small.tolist() == [int(whole.of(w)[0]) for w in words]
    assert len({int(whole.of(b"w%d" % i)[0]) for i in range(3000)}) > 2800
    assert whole.of_texts([]) == []


def test_common_subsequence():
    rng = random.Random(1)
    space = latent.Space(np.ones(latent.FEATURES, np.float32))
    for _ in range(100):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(3, 30))] for _ in range(2))
        places = {}
        for i, c in enumerate(a):
            places[c] = places.get(c, 0) | 1 << i
        row = [0] * (len(a) + 1)
        for y in b:
            row = [0] + [0] * len(a) if False else row
            new = [0]
            for i, x in enumerate(a):
                new.append(row[i] + 1 if x == y else max(row[i + 1], new[i]))
            row = new
        assert latent.common_subsequence(b, latent.Item(1, np.array(a), places, set())) == row[-1]
    assert space.content(np.array([1, 2])).tolist() == [1, 2]


# ---- fingerprints
def test_fingerprints(spark, odd, docs):
    rng = random.Random(2)
    rows = [(i, "\n".join(" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 80))) for _ in range(rng.randrange(0, 12))), "a") for i in range(40)]
    rows[7] = (7, rows[6][1], "a")
    rows.append((40, "\n".join(f"line {i}" for i in range(3000)), "a"))
    found = {r["doc_id"]: r for r in bloom_lookup.fingerprints(docs(rows)).collect()}

    def pieces(t):
        return set(re.findall(r"[^\n]{1,200}", t))

    def alike(a, b):
        d = len(a ^ b)
        return 1.0 if not a and not b else (len(a) + len(b) - d) / (len(a) + len(b) + d)
    for n, (i, t, _) in enumerate(rows):
        nxt = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = found[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert math.isclose(r["near_edited"], alike(pieces(t), pieces(edited))) and math.isclose(r["near_next"], alike(pieces(t), pieces(nxt)))
    assert found[6]["fingerprint"] == found[7]["fingerprint"] != found[8]["fingerprint"]
    assert bloom_lookup.fingerprints(odd).count() == odd.count()
    assert bloom_lookup.fingerprints(docs([])).count() == 0
    alone = bloom_lookup.fingerprints(docs([(5, "ab\ncd", "a")])).first()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"ab\nab").hexdigest()


def test_digests_with_equal_key_bits_are_told_apart(spark, docs, monkeypatch):
    # the documents that peeled in no attempt while attempts shared their key bits
    rows = [(1, "line 94499\nline 366370", "a"), (2, "other one", "a"), (3, "third", "a")]
    found = {r["doc_id"]: r for r in bloom_lookup.fingerprints(docs(rows)).collect()}
    assert [found[i]["near_next"] for i in (1, 2, 3)] == [0.0, 0.0, 0.0]
    # so few key bits that digests of one side and of both sides agree in them all the time
    monkeypatch.setattr(bloom_lookup, "KEY_BITS", 20)
    rng = random.Random(12)
    pairs = [([rng.randrange(1 << 60) for _ in range(rng.randrange(12))], [rng.randrange(1 << 60) for _ in range(rng.randrange(12))]) for _ in range(150)]
    pairs = [(a + b[:3], b) for a, b in pairs] + [([], [])]
    df = spark.createDataFrame(pairs, "x array<bigint>, y array<bigint>")
    got = df.select("x", "y", bloom_lookup._recovered(df["x"], df["y"]).alias("d")).collect()
    assert all(r["d"] == len(set(r["x"]) ^ set(r["y"])) for r in got)


# ---- quality
def test_quality_of_held_out_rows(spark, odd, docs):
    rng = random.Random(3)

    def text(good):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(20, 120))]
        return " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words) if rng.random() < 0.5 else " ".join(w for w in words[:9] for _ in range(9))
    rows = [(i, text(i % 5 > 0), "a") for i in range(400)]
    table = docs(rows)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(300)] + [(1, None), (None, 1), (2, 1)], "doc_id long, quality int")
    ranking = pairwise.train(table, labels)
    scores = {r[0]: r[1] for r in table.select("doc_id", pairwise.score(F.col("text"), ranking)).collect()}
    assert all((scores[i] >= 0.3) == (i % 5 > 0) for i in range(300, 400))
    assert all(0 <= r[0] <= 1 for r in odd.select(pairwise.score(F.col("text"), ranking)).collect())
    assert docs([]).select(pairwise.score(F.col("text"), ranking)).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert pairwise.train(table, none) is None
    assert table.select(pairwise.score(F.col("text"), None).alias("s")).first()["s"] == 0.5


# ---- language model
def test_scores(spark, odd, docs):
    rng = random.Random(7)
    vocabulary = [["de", "la", "el"] + [f"pal{i}a" for i in range(60)], ["the", "of", "in"] + [f"wor{i}d" for i in range(60)]]
    rows = [(i, " ".join(rng.choice(vocabulary[i % 2]) for _ in range(rng.randrange(30, 120))), "a") for i in range(300)]
    rows += [(500, None, "a"), (501, "Unseen unseen unseen", "a"), (502, "The of", "a"), (502, "The of", "a")]
    held = (F.col("doc_id") % 7 == 2) | (F.col("doc_id") > 499)
    found = context_mixing.score(docs(rows), held, frequent=100).collect()
    seen = Counter(t for i, text, _ in rows if i % 7 != 2 and i < 500 for t in context_mixing.tokens((text or "").encode()))
    total, kinds = sum(seen.values()), len(seen)
    texts = {i: t for i, t, _ in rows}
    assert len(found) == len(rows)
    for r in found:
        own = context_mixing.tokens((texts[r["doc_id"]] or "").encode())
        base = sum(math.log10((seen[t] + 1) / (total + kinds + 1)) for t in own)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["train_tokens"] == total
        assert r["n_tokens"] == len(own) and r["n_known"] == sum(seen[t] > 0 for t in own) and r["score"] < 0
    model, base = (sum(r[c] for r in found if r["held_out"] and r["doc_id"] < 500) for c in ("score", "base_score"))
    assert model > 0.95 * base  # two kinds of text are told apart
    assert context_mixing.score(odd, F.col("doc_id") % 7 == 2).count() == odd.count()
    assert context_mixing.score(docs([]), F.lit(False)).count() == 0
    assert context_mixing.score(docs(rows[:5]), F.lit(True)).count() == 5


def test_weights_are_refined_after_every_token(monkeypatch):
    """Against a loop over tokens and bits: texts of all lengths, those of one step and less too."""
    cm, rng = context_mixing, np.random.default_rng(4)
    code = cm.make_code([(f"w{i}", int(2000 / (i + 1)) + 2) for i in range(600)], 40, 9000, 700)
    code.kinds = np.concatenate([np.log(rng.dirichlet(np.ones(cm.TOP), cm.KINDS).T + 1e-6), np.zeros((1, cm.KINDS))])
    model = cm.Predictors.of([rng.integers(0, 6, (n, 2)).astype(float) for n in code.sizes])
    model.mixer = cm.Mixer(rng.random((9, 5)), rng.random((9, cm.CELLS)))
    sizes = np.array([1, 5, 0, 40, 2, 300, 128, 129, 2])
    symbols = np.minimum(rng.zipf(1.3, int(sizes.sum())) - 1, code.escape + 1)
    past, wanted, first = cm.Past.of(symbols, sizes, code), [], np.cumsum(sizes) - sizes
    silent = cm.stretch(np.zeros(1), np.zeros(1))[0]
    for start, size in zip(first, sizes):
        weights, total = model.mixer.weights.copy(), 0.0
        for token in range(start, start + size):
            slope, seen = np.zeros_like(weights), np.zeros(9)
            for at in range(code.start[symbols[token]], code.start[symbols[token]] + code.length[symbols[token]]):
                node, bit, kind = code.nodes[at], code.bits[at], past.kind[token]
                slots = cm.shallow_slots(*(np.array([v]) for v in (node, past.one[token], past.two[token], kind)))
                shallow = code.depth[at] < cm.SHALLOW
                x = np.array([model.stretched[0][node], model.stretched[1][node * cm.KINDS + kind],
                              *(model.stretched[2 + j][slots[j][0]] if shallow else silent for j in (0, 1)), 1])
                gate = int(model.sure[1][node * cm.KINDS + kind]) + (3 * int(model.sure[3][slots[1][0]]) if shallow else 0)
                mixed = float(weights[gate] @ x)
                plain, p = model.mixer.refined(np.array([mixed]), np.array([gate]))
                slope[gate] += x * (bit - plain[0])
                seen[gate] += 1
                total += math.log10(p[0] if bit else 1 - p[0])
            weights += cm.RATE * slope / np.sqrt(cm.STEP * seen + 1)[:, None]
        wanted.append(total)
    scorer = cm.Scorer(model, code)
    for together in (1, 7, 1 << 14):
        monkeypatch.setattr(cm, "TOGETHER", together)
        assert np.allclose(scorer.log10_of(symbols, sizes), wanted, rtol=1e-4, atol=1e-6)
    assert len(scorer.log10_of(symbols[:0], sizes[:0])) == 0


def test_mixers_learn_from_every_bit_of_all_training_texts(docs, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{int(rng.expovariate(0.05))}" for _ in range(rng.randrange(5, 60))), "a") for i in range(400)]
    held = F.col("doc_id") % 7 == 2
    seen, texts = [], []
    train, kinds = context_mixing.train_mixer, context_mixing.learn_kinds

    def counting(sums, gates, k):
        moments = sums(np.zeros((gates, k))).reshape(gates, -1)
        seen.append(moments[:, k + k * k:k + k * k + context_mixing.CELLS].sum())
        return train(sums, gates, k)

    def looking(training, code):
        texts.extend([np.frombuffer(r[0], code.width) for r in training.select("symbols").collect()] + [code])
        return kinds(training, code)
    monkeypatch.setattr(context_mixing, "train_mixer", counting)
    monkeypatch.setattr(context_mixing, "learn_kinds", looking)
    context_mixing.score(docs(rows), held, frequent=40)
    code = texts.pop()
    own = [context_mixing.tokens(t.encode()) for i, t, _ in rows if i % 7 != 2]
    assert len(texts) == len(own) and sum(map(len, texts)) == sum(map(len, own))
    assert seen[0] == pytest.approx(sum(code.length[t].sum() for t in texts))
    rare = Counter(t for some in own for t in some if t not in code.ids)
    assert seen[1] == pytest.approx(sum(8 * (len(t) + 1) * min(n, 3) for t, n in rare.items())) and len(rare) > 20


def test_tally_joins_its_runs(monkeypatch):
    monkeypatch.setattr(context_mixing, "GRAMS", 50)
    rng, tally, want, got = np.random.default_rng(2), context_mixing.Tally(), Counter(), Counter()
    for _ in range(60):
        keys = rng.integers(-40, 40, 30)
        want.update(keys.tolist())
        if tally.add(keys):
            got.update(dict(zip(*(c.to_pylist() for c in tally.emptied().columns))))
    got.update(dict(zip(*(c.to_pylist() for c in tally.emptied().columns))))
    assert got == want


def test_probabilities_of_all_spellings_sum_to_one_at_most():
    """Over all one-byte words, the spelling model is a distribution."""
    words = [bytes([b]) for b in range(33, 127)] * 3
    word, bits, slots = context_mixing.byte_events(words)
    counts = [np.zeros((context_mixing.BYTE_SLOTS, 2)) for _ in slots]
    for c, own in zip(counts, slots):
        np.add.at(c, (own, bits), 1)
    model = context_mixing.Predictors.of(counts)
    model.fit(counts, slots, bits)
    every = [bytes([b]) for b in range(256) if b not in (9, 10, 11, 12, 13, 32)]
    word, bits, slots = context_mixing.byte_events(every)
    p = np.exp(np.bincount(word, np.log(model.probabilities(slots, bits))))
    assert p.sum() == pytest.approx(min(1, p.sum())) and p.sum() > 0.5
