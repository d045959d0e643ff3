"""Byte-level BPE as a finite-state transducer, and a streaming decoder over a UTF-8 state machine.

Encoding. A sequence of tokens is what the merges give for its bytes if and only if each two neighbours are what the merges
give for theirs. Whether two tokens may stand side by side follows from their merge trees: at no time may the last part of
the left one and the first part of the right one, both there at that time, be the next pair to merge (``Merges.neighbours``).
This makes the merges a finite-state transducer that reads bytes and guesses token ends:

* A guess is (last token, place in the trie of tokens, tokens not yet given out). Reading a byte moves every guess down the
  trie; where a token ends that may follow the last one, a new guess starts at the root. Of all guesses just one ends a token
  after each byte, and none lasts longer than the longest token. Where few tokens are left below a place, the guess keeps
  those of them that may follow instead of the last token, and ends if there are none: guesses that can go on alike are one.
* ``Transducer`` determinises this: a state is the set of all guesses, and what they share at the front of their pending
  tokens is given out, so a token comes out after a bounded lookahead. States and moves are made when a text first needs
  them and dropped all at once beyond ``MOST_STATES``, which bounds memory and changes no result.
* At the end of a piece the guess that stands at the root gives its pending tokens.

A text is first cut into the matches of the vocabulary's pattern, and each is encoded on its own; ids of frequent short
matches are remembered, in two generations of bounded size. Work is linear in the text, long matches included.

Decoding. ``Decoder`` takes ids in chunks of any size and gives out whole code points at once, holding back at most three
bytes. The UTF-8 state machine rejects overlong forms, surrogates and code points above U+10FFFF; its step over a whole token is one
look-up in a table made from its steps over bytes.

Texts are rows of their own: nothing is shuffled. Edge cases: null and empty texts have no ids and decode to no bytes; a null
doc_id is kept; repeated rows are encoded each; special tokens are ordinary text; an empty table gives no row; other columns
are left out. Ids of bytes that are no UTF-8 decode to those bytes, with ``valid`` false; a null id array gives null bytes.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from deckmill.llm.common import as_bytes, id_text, kept, map_arrow, text_chunks

MOST_STATES = 100_000
FEW_BELOW = 8
REMEMBERED = 100_000
LONGEST_REMEMBERED = 48
DECODED_AT_ONCE = 1 << 16
LAST = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Token -> rank of a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """A vocabulary of merges: the trie of its tokens, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for byte {missing[0]}")
        self.ranks, self.tokens = ranks, {rank: token for token, rank in ranks.items()}
        # tokens that merges do not form stand for a piece that equals them, and nowhere else
        self.whole: dict[bytes, int] = {}
        self.children: list[dict[int, int]] = [{}]
        self.token_at = [-1]
        halves = {}
        for token, rank in ranks.items():
            parts = self._merge(token, 2)
            if len(parts) > 1 and b"".join(parts[:2]) != token:
                self.whole[token] = rank
                continue
            if len(parts) == 2:
                halves[rank] = (ranks[parts[0]], ranks[parts[1]])
            node = 0
            for byte in token:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = self.children[node][byte]
            self.token_at[node] = rank
        # the tokens below each place of the trie that has few of them; children come after their parents
        below: list[list[int] | None] = [[] for _ in self.children]
        for node in range(len(below) - 1, -1, -1):
            inner = [below[child] for child in self.children[node].values()]
            rest = None if None in inner else [t for some in inner for t in some]
            below[node] = rest if rest is None or len(rest) <= FEW_BELOW else None
            if below[node] is not None and self.token_at[node] >= 0:
                below[node] = [*rest, self.token_at[node]]
        self.below = below
        self.halves = halves
        self.edges: tuple[dict, dict] = ({}, {})  # of the tokens that were met: from the left, from the right
        self.known: dict[int, bool] = {}
        self.following: dict[tuple[int, int], frozenset[int]] = {}

    def _merge(self, piece: bytes, parts_left: int) -> list[bytes]:
        """The parts of a piece when no merge is left, or when so many parts are left: least rank first, leftmost of equals."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > parts_left:
            rank, i = min(((self.ranks.get(parts[i] + parts[i + 1], LAST), i) for i in range(len(parts) - 1)))
            if rank == LAST:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _edge(self, whole: int, side: int) -> list[tuple[bytes, int, int]]:
        """The outermost parts of a token over time, first the single byte: (part, from which rank on, up to which)."""
        out = self.edges[side].get(whole)
        if out is None:
            out, token, until = [], whole, LAST
            while token in self.halves:
                out.append((self.tokens[token], token, until))
                token, until = self.halves[token][side], token
            out = self.edges[side][whole] = [(self.tokens[token], 0, until), *out[::-1]]
        return out

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens leaves these two tokens."""
        key = left << 32 | right
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= MOST_STATES:
                self.known.clear()
            found = self.known[key] = self._neighbours(left, right)
        return found

    def that_may_follow(self, left: int, node: int) -> frozenset[int]:
        """The tokens below a place of the trie that may follow a token (-1: none before)."""
        key = (left, node)
        found = self.following.get(key)
        if found is None:
            if len(self.following) >= MOST_STATES:
                self.following.clear()
            found = self.following[key] = frozenset(t for t in self.below[node] if left < 0 or self._neighbours(left, t))
        return found

    def _neighbours(self, left: int, right: int) -> bool:
        lefts, rights, joint_rank = iter(self._edge(left, 1)), iter(self._edge(right, 0)), self.ranks.get
        a, a_from, a_until = next(lefts)
        b, b_from, b_until = next(rights)
        while True:
            joint = joint_rank(a + b)
            # of equal ranks the leftmost merges first: before the pair's own turn for a, after it for b
            if joint is not None and max(joint, a_from, b_from) < a_until and max(joint, a_from, b_from) <= b_until:
                return False
            if a_until <= b_until:
                if a_until == LAST:
                    return True
                a, a_from, a_until = next(lefts)
            else:
                b, b_from, b_until = next(rights)


class State(dict):
    """byte -> (next state, tokens given out); ``guesses`` are (last token or set of the tokens that may end, trie place, pending
    tokens), the last one at the root."""

    __slots__ = ("guesses",)


class Transducer:
    """The determinised transducer of a vocabulary, as far as texts have needed it."""

    def __init__(self, merges: Merges, most_states: int = MOST_STATES):
        self.merges, self.most_states = merges, most_states
        self.states: dict[tuple, State] = {}
        self.start = self._state(((-1, 0, ()),))

    def _state(self, guesses: tuple) -> State:
        state = self.states.get(guesses)
        if state is None:
            state = self.states[guesses] = State()
            state.guesses = guesses
        return state

    def _move(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        merges, moved, ended = self.merges, [], None
        for last, node, pending in state.guesses:
            node = merges.children[node].get(byte)
            if node is None:
                continue
            token, below = merges.token_at[node], merges.below[node]
            if below is not None:
                last = merges.that_may_follow(last, node) if isinstance(last, int) else last.intersection(below)
                if token in last:
                    ended = (token, 0, (*pending, token))
                    last -= {token}
                if last:
                    moved.append((last, node, pending))
            else:
                if token >= 0 and ended is None and (last < 0 or merges.neighbours(last, token)):
                    ended = (token, 0, (*pending, token))
                moved.append((last, node, pending))
        moved.append(ended)
        shared, first = 0, moved[0][2]
        most = min(len(g[2]) for g in moved)
        while shared < most and all(g[2][shared] == first[shared] for g in moved):
            shared += 1
        if shared:
            moved = [(last, node, pending[shared:]) for last, node, pending in moved]
        move = state[byte] = (self._state(tuple(moved)), first[:shared])
        return move

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        if piece in self.merges.whole:
            return [self.merges.whole[piece]]
        if len(self.states) > self.most_states:
            # no piece is under way; states point at each other and go only once they are empty
            for state in self.states.values():
                state.clear()
            self.states = {}
            self.start = self._state(((-1, 0, ()),))
        state, out = self.start, []
        for byte in piece:
            move = state.get(byte)
            if move is None:
                move = self._move(state, byte)
            state, given = move
            if given:
                out += given
        out += state.guesses[-1][2]
        return out


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.split = regex.compile(pattern).findall
        self.transducer = Transducer(Merges(ranks))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        found = array("I", ids)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def _ids(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self._bytes(self.transducer.encode(piece.encode()))
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        pieces = self.split(text)
        ids = list(map(self.young.get, pieces))
        if None in ids:
            ids = [self._ids(p) if i is None else i for p, i in zip(pieces, ids)]
        return b"".join(ids)


def utf8_steps() -> np.ndarray:
    """The UTF-8 state machine as [state, byte] -> state. 0: between code points; 1, 2, 3: so many continuation bytes are
    due; 4 to 7: the same after E0, ED, F0 and F4, whose next byte is restricted; 8: no UTF-8."""
    steps = np.full((9, 256), 8, np.uint8)
    steps[0, :0x80] = 0
    steps[0, 0xC2:0xE0], steps[0, 0xE0:0xF0], steps[0, 0xF0:0xF5] = 1, 2, 3
    steps[0, [0xE0, 0xED, 0xF0, 0xF4]] = [4, 5, 6, 7]
    for state in (1, 2, 3):
        steps[state, 0x80:0xC0] = state - 1
    steps[4, 0xA0:0xC0], steps[5, 0x80:0xA0] = 1, 1
    steps[6, 0x90:0xC0], steps[7, 0x80:0x90] = 2, 2
    return steps


class Vocabulary:
    """The bytes of every id, and the state machine's step over them."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        byte_steps = utf8_steps()
        after = np.tile(np.arange(9, dtype=np.uint8), (size, 1))
        lengths = np.array([len(t) for t in self.tokens])
        for place in range(int(lengths.max())):
            rows = np.flatnonzero(lengths > place)
            bytes_here = np.array([self.tokens[r][place] for r in rows.tolist()])
            after[rows] = byte_steps[after[rows], bytes_here[:, None]]
        self.steps = [bytes(column) for column in after.T]


class Decoder:
    """Ids in, bytes of whole code points out. ``valid`` turns false at the first byte that is no UTF-8, from where on bytes
    pass as they come."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.state, self.held = vocabulary, 0, b""

    @property
    def valid(self) -> bool:
        return self.state != 8

    def feed(self, ids: list[int]) -> bytes:
        steps, state = self.vocabulary.steps, self.state
        for token in ids:
            state = steps[state][token]
        self.state = state
        out = self.held + b"".join(map(self.vocabulary.tokens.__getitem__, ids))
        self.held = b""
        if state not in (0, 8):
            # the code point that is still open starts at its lead byte, three bytes back at most
            lead = max(i for i in range(max(0, len(out) - 3), len(out)) if out[i] >= 0xC0)
            out, self.held = out[:lead], out[lead:]
        return out

    def close(self) -> bytes:
        """The bytes of a code point that never ended."""
        out, self.held = self.held, b""
        if self.state:
            self.state = 8
        return out


def decoded(ids: bytes, vocabulary: Vocabulary) -> tuple[bytes, bool]:
    """The bytes of an id array, decoded in chunks, and whether they are UTF-8."""
    decoder, numbers = Decoder(vocabulary), np.frombuffer(ids, "<u4")
    parts = [decoder.feed(numbers[i:i + DECODED_AT_ONCE].tolist()) for i in range(0, len(numbers), DECODED_AT_ONCE)]
    return b"".join([*parts, decoder.close()]), decoder.valid


ROW = "doc_id long, ids binary, decoded binary, valid boolean"


def _row_batch(doc_ids: pa.Array, ids: list[bytes | None] | pa.Array, vocabulary: Vocabulary) -> pa.RecordBatch:
    ids = pa.array(ids, pa.binary())
    found = [(None, None) if i is None else decoded(i, vocabulary) for i in ids.to_pylist()]
    return pa.RecordBatch.from_arrays([doc_ids, ids, pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.bool_())],
                                      ["doc_id", "ids", "decoded", "valid"])


def encode(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text; ids are little-endian unsigned 32-bit integers in a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("byte bpe", ranks, pattern), lambda: Encoder(read_ranks(ranks), pattern))
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for some in text_chunks(texts):
                ids = [encoder.encode(t.decode()) for t in texts[some]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[some.start:some.stop], pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return map_arrow(id_text(docs, id_column, text_column), run, "doc_id long, ids binary")


def decode(rows: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids, decoded, valid) of (doc_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = kept(("byte vocabulary", ranks), lambda: Vocabulary(read_ranks(ranks)))
        for batch in batches:
            yield _row_batch(batch.column(0), batch.column(1), vocabulary)

    return map_arrow(rows.select("doc_id", "ids"), run, ROW)


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids, decoded, valid) of every whole text: ``encode`` and ``decode`` in one pass, in the same workers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("byte bpe", ranks, pattern), lambda: Encoder(read_ranks(ranks), pattern))
        vocabulary = kept(("byte vocabulary", ranks), lambda: Vocabulary(encoder.transducer.merges.ranks))
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for some in text_chunks(texts):
                ids = [encoder.encode(t.decode()) for t in texts[some]]
                yield _row_batch(batch.column(0)[some.start:some.stop], ids, vocabulary)

    return map_arrow(id_text(docs, id_column, text_column), run, ROW)
