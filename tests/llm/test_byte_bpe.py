"""The byte-level transducer against the tiktoken library, and the streaming decoder against Python's own."""

import codecs
import hashlib
import os

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import example, given, settings
from hypothesis import strategies as st

from deckmill.llm import byte_bpe
from deckmill.llm.queries import op12_byte_transducer

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
RANKS = byte_bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = byte_bpe.Encoder(RANKS, PATTERN)
VOCABULARY = byte_bpe.Vocabulary(RANKS)
TOKENS = list(RANKS)


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


@given(st.one_of(st.text(), st.text("abcdeé \n'st0"), st.text("aeinthsor"), st.lists(st.sampled_from(["the", "ing", " ", "é", "中", "́", "12"])).map("".join)))
@example("aaaa" * 300)
@example(" " * 999 + "x")
@example("it's we'll\x1c\x85᠎​ x")
@settings(max_examples=400, deadline=None)
def test_texts_are_encoded_as_by_the_library(text):
    ids = numbers(ENCODER.encode(text))
    assert ids == LIBRARY.encode_ordinary(text)
    assert byte_bpe.Decoder(VOCABULARY).feed(ids) == text.encode()


def merged(ranks, piece):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        rank, i = min([(ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1)], default=(1 << 62, 0))
        if rank == 1 << 62:
            return [ranks[p] for p in parts]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@given(st.lists(st.binary(min_size=2, max_size=5).map(lambda b: bytes(97 + c % 3 for c in b)), min_size=1, max_size=25, unique=True),
       st.lists(st.text("abc", max_size=25), max_size=20))
@settings(max_examples=150, deadline=None)
def test_any_vocabulary_in_which_merges_form_the_tokens(tokens, pieces):
    ranks = {bytes([b]): b for b in range(256)}
    for token in sorted(tokens, key=len):
        # a vocabulary as training leaves it: each new token joins the last two parts of what there is
        if len(merged(ranks, token)) == 2:
            ranks[token] = len(ranks)
    transducer = byte_bpe.Transducer(byte_bpe.Merges(ranks), most_states=50)
    for piece in pieces:
        assert transducer.encode(piece.encode()) == (merged(ranks, piece.encode()) if piece else [])


def test_tokens_that_merges_do_not_form_stand_for_whole_pieces_only():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bcd": 257}
    transducer = byte_bpe.Transducer(byte_bpe.Merges(ranks))
    assert transducer.encode(b"bcd") == [257] and transducer.encode(b"abcd") == [256, 99, 100]
    with pytest.raises(ValueError):
        byte_bpe.Merges({b"a": 0})


def test_tokens_come_out_after_bounded_lookahead():
    transducer = byte_bpe.Transducer(byte_bpe.Merges(RANKS))
    longest, state, given_out = max(map(len, TOKENS)), transducer.start, 0
    for i, byte in enumerate(b"incomprehensibilities" * 200):
        state, out = state.get(byte) or transducer._move(state, byte)
        given_out += sum(len(transducer.merges.tokens[t]) for t in out)
        assert i + 1 - given_out <= 2 * longest


def test_few_states_give_the_same_ids():
    small = byte_bpe.Transducer(byte_bpe.Merges(RANKS), most_states=20)
    for piece in [b" therefore", "éàü".encode(), b"antidisestablishmentarianism", b"zzzzzzzz"] * 3:
        assert small.encode(piece) == LIBRARY._encode_single_piece(piece)
    assert len(small.states) < 120


@given(st.lists(st.one_of(st.sampled_from(["é", "中文", "\U0001f600", "a b", "߿ࠀ"]).map(str.encode), st.binary(max_size=4)), max_size=8).map(b"".join), st.data())
@settings(max_examples=300, deadline=None)
def test_decoder_gives_whole_code_points(raw, data):
    ids = [RANKS[raw[i:i + 1]] for i in range(len(raw))]
    decoder, library, out, at = byte_bpe.Decoder(VOCABULARY), codecs.getincrementaldecoder("utf-8")(), b"", 0
    while at < len(ids):
        step = data.draw(st.integers(1, 4))
        part = decoder.feed(ids[at:at + step])
        try:
            text = library.decode(raw[at:at + step])
        except UnicodeDecodeError:
            assert not decoder.valid
            break
        assert decoder.valid and part.decode() == text
        out, at = out + part, at + step
    else:
        out += decoder.close()
        assert out == raw
        try:
            raw.decode()
            assert decoder.valid
        except UnicodeDecodeError:
            assert not decoder.valid


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_whole_table(spark):
    got = {r["doc_id"]: tuple(r[1:]) for r in op12_byte_transducer(spark, SF).collect()}
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        text = row["text"] or ""
        ids = LIBRARY.encode_ordinary(text)
        assert got[row["doc_id"]] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_odd_rows(spark, docs, odd):
    coded = byte_bpe.encode(odd, PATH, PATTERN)
    rows = byte_bpe.decode(coded, PATH).collect()
    texts = {(r["doc_id"], r["decoded"].decode()) for r in rows}
    assert len(rows) == 11 and texts == {(r["doc_id"], r["text"] or "") for r in odd.collect()} and all(r["valid"] for r in rows)
    assert byte_bpe.decode(byte_bpe.encode(docs([]), PATH, PATTERN), PATH).count() == 0
    strange = spark.createDataFrame([(1, None), (2, bytearray(np.array([RANKS[b"\xff"], RANKS[b"\xc3"]], "<u4").tobytes()))], "doc_id long, ids binary")
    assert [(r["decoded"] and bytes(r["decoded"]), r["valid"]) for r in byte_bpe.decode(strange, PATH).collect()] == [(None, None), (b"\xff\xc3", False)]
