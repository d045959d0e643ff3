"""Token ids in canonical length-limited Huffman code, in blocks that decode on their own.

``tokenize`` turns texts into id rows, ``write_ids`` codes them with one code from the global counts, ``read_ids``
decodes. An id file is a folder of two tables, written by Spark and read by any of its readers:

* ``codebook``: (symbol, bits), the code lengths. Codes are canonical: in order of (bits, symbol).
* ``blocks``: (part, first, doc_ids, counts, checkpoints, payload), whole documents in ascending doc_id by part and
  ``first``, the number of ids in the part before the block. ``payload`` is the bit string, most significant bit first, ``checkpoints`` holds little-endian unsigned 32-bit
  bit offsets of every SEGMENT-th id of the block. A block or a segment can be decoded without any other.

Edge cases: null texts are empty and hold the end id alone; a null doc_id stands before all others; rows that repeat a
doc_id stay separate, in order of a hash of their ids; an empty table writes an empty codebook and no block.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deckmill.llm.common import as_bytes, id_text, kept, map_arrow, stored, text_chunks
from deckmill.session import scratch_path

SEGMENT = 256
BLOCK_IDS = 1 << 15
MAX_BITS = 18
CACHED_WORDS = 300_000
LONGEST_CACHED = 64
CACHED_PIECES = 900_000
STRETCH = 1 << 20
# Letters in lower case and normal form that most new words consist of; others are looked at one by one.
LATIN = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+").fullmatch
SPACE = re.compile(rb"[\x20\x09-\x0D]").search

# Kinds of bytes; letters of two bytes are found by their first byte, LEAD, and their second one.
GAP, LETTER, MARK, OTHER = range(4)
LEAD = 0xC3
KINDS = np.full(256, OTHER, np.uint8)
KINDS[[c for c in range(33, 127) if not chr(c).isalnum()]] = MARK
KINDS[[c for c in range(128) if chr(c).isalpha()]] = LETTER
WORDS_ONLY = np.full(256, OTHER, np.uint8)
for kinds in (KINDS, WORDS_ONLY):
    kinds[[9, 10, 11, 12, 13, 32]] = GAP
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SECOND = np.array([0x80 <= c <= 0xBF and c not in (0x97, 0xB7) for c in range(256)])
SECOND_LOWER = np.arange(256, dtype=np.uint8)
SECOND_LOWER[[c for c in range(0x80, 0x9F) if c != 0x97]] += 32
# What a byte begins, by the kind before it and its own: a word, the gap after one, the marks after letters, or a word that is
# not just letters with marks after them.
WORD_START, WORD_STOP, TAIL, NOT_PLAIN = 1, 2, 4, 8
STEPS = np.array([[(own != GAP and before == GAP) * WORD_START | (own == GAP and before != GAP) * WORD_STOP
                   | (own == MARK and before == LETTER) * TAIL
                   | (own == OTHER != before or own == LETTER and before == MARK or own == MARK and before == GAP) * NOT_PLAIN
                   for own in range(4)] for before in range(4)], np.uint8).reshape(-1)
# A piece of up to KEYED bytes is its own key: its bytes in two 64-bit numbers, with its length in the last byte.
KEYED = 15
FIRST_8 = np.array([(1 << 8 * min(n, 8)) - 1 for n in range(KEYED + 2)], np.uint64)
NEXT_7 = np.array([(1 << 8 * min(max(n - 8, 0), 7)) - 1 for n in range(KEYED + 2)], np.uint64)


def slices(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of the slices that begin ``at`` and have ``sizes``, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(at - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Pieces:
    """Key (two 64-bit numbers) -> ids: numpy columns and an open-addressing index, so that a batch is looked up at once."""

    def __init__(self, width: str):
        self.n = 0
        self.first, self.second = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64)
        self.at = np.zeros((1 << 12) + 1, np.int64)
        self.hit = np.zeros(1 << 12, bool)
        self.ids = np.zeros(1 << 14, width)
        self.slots = np.zeros(1 << 13, np.int32)

    def _places(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        h = first * np.uint64(0x9E3779B97F4A7C15) ^ second * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where there is none."""
        place = self._places(first, second)
        found = self.slots[place].astype(np.int64) - 1
        open_ = np.flatnonzero((found >= 0) & ((self.first[found] != first) | (self.second[found] != second)))
        while len(open_):
            place[open_] = place[open_] + 1 & len(self.slots) - 1
            found[open_] = now = self.slots[place[open_]].astype(np.int64) - 1
            open_ = open_[(now >= 0) & ((self.first[now] != first[open_]) | (self.second[now] != second[open_]))]
        return found

    def _index(self, start: int) -> None:
        place = self._places(self.first[start:self.n], self.second[start:self.n])
        number = np.arange(start, self.n, dtype=np.int32) + 1
        while len(place):
            free = self.slots[place] == 0
            self.slots[place[free]] = number[free]
            left = self.slots[place] != number
            place, number = place[left] + 1 & len(self.slots) - 1, number[left]

    def room(self, ids: int) -> None:
        """Room for so many ids behind those in use."""
        if self.at[self.n] + ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(ids, len(self.ids)), self.ids.dtype)])

    def add(self, first: np.ndarray, second: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keys that are all different and not there yet."""
        self.room(len(ids))
        start, self.n = self.n, self.n + len(first)
        if self.n > len(self.first):
            more = max(self.n - len(self.first), len(self.first))
            self.first, self.second, self.hit, self.at = (
                np.concatenate([c, np.zeros(more, c.dtype)]) for c in (self.first, self.second, self.hit, self.at))
        self.first[start:self.n], self.second[start:self.n], self.hit[start:self.n] = first, second, False
        self.ids[self.at[start]:self.at[start] + len(ids)] = ids
        self.at[start + 1:self.n + 1] = self.at[start] + np.cumsum(sizes)
        if 2 * self.n > len(self.slots):
            self.slots = np.zeros(1 << (2 * self.n).bit_length(), np.int32)
            start = 0
        self._index(start)

    def drop(self, most: int) -> None:
        """At most ``most`` keys stay, of those met again since the last time."""
        stay = np.flatnonzero(self.hit[:self.n])[:most]
        sizes = self.at[stay + 1] - self.at[stay]
        first, second, ids = self.first[stay], self.second[stay], self.ids[slices(self.at[stay], sizes)]
        self.n, self.slots[:] = 0, 0
        self.add(first, second, ids, sizes)


class WordIds:
    """Word -> its ids as little-endian bytes. A word-level tokenizer that drops white space cuts at it too, so a text's
    ids are those of its words in turn.

    Where the tokenizer lower-cases and cuts letters from punctuation (``_plain``), a word of Latin letters and marks after them is
    two pieces, so that only the letters are encoded, once for all their spellings; any other word is one piece. Pieces of up to KEYED
    bytes are cut and looked up by numpy, a stretch of text at a time, in a table of about ``CACHED_PIECES``. Longer ones are
    remembered in two generations of ``CACHED_WORDS`` each: a full one becomes the old one, from which words in use come back.
    """

    MARKS = bytes(np.flatnonzero(KINDS == MARK).astype(np.uint8))

    def __init__(self, path: str, width: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.width = Tokenizer.from_file(path), width
        special = [(i, t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized]
        self.mark_id, self.mark = special[-1] if special else (None, b"")
        self.pieces = Pieces(width)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {b"": b""}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        self.letters = Tokenizer.from_file(path)
        for tokenizer in (self.tokenizer, self.letters):  # words come once: the library's own cache would only be filled
            if hasattr(tokenizer.model, "_resize_cache"):
                tokenizer.model._resize_cache(0)
        if suffix and self._plain():
            # letters in normal form and lower case already
            self.letters.normalizer = None
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _plain(self) -> bool:
        """Whether letters are lower-cased and cut from marks: asked of the tokenizer, for every mark."""
        same = all(self._alone(a + m + n) == self._alone(b) + self._alone(m + n)
                   for a, b in (("aB", "ab"), ("aÉ", "aé")) for m in self.MARKS.decode() for n in ("", "!", ".", "'"))
        capitals = "".join(map(chr, [*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]))
        return same and self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str(capitals) == capitals.lower()

    def _alone(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _cut(self, tokenizer, group: list[bytes], joint: bytes, is_end: Callable[[np.ndarray], np.ndarray], keep: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words in groups of 64, cut after (``keep`` 1) or before and after (0) the ids that end a word, and the
        number of each word's ids."""
        groups = [group[i:i + 64] for i in range(0, len(group), 64)]
        found, sizes = [np.zeros(0, self.width)], [np.zeros(0, np.int64)]
        for some, coded in zip(groups, tokenizer.encode_batch_fast([joint.join(g).decode() for g in groups], add_special_tokens=False)):
            ids = np.array(coded.ids, self.width)
            ends = np.flatnonzero(is_end(ids))
            if len(ends) + 1 - keep != len(some) or keep and ends[-1] + 1 != len(ids):
                apart = [np.array(self._alone(w.decode()), self.width) for w in some]
                found += apart
                sizes.append(np.array([len(a) for a in apart], np.int64))
            elif keep:
                found.append(ids)
                sizes.append(np.diff(ends, prepend=-1))
            else:
                found.append(np.delete(ids, ends))
                sizes.append(np.diff(ends, prepend=-1, append=len(ids)) - 1)
        return np.concatenate(found), np.concatenate(sizes)

    def _each(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        raw, stops = ids.tobytes(), np.cumsum(sizes) * ids.itemsize
        return [raw[s:e] for s, e in zip([0, *stops.tolist()], stops.tolist())]

    def _letters(self, words: list[bytes]) -> tuple[list[bytes], list[bytes | None]]:
        """For each word its letters, A-Z in lower case, and the marks after them; None in place of the marks for other words."""
        stems = [w.rstrip(self.MARKS) for w in words]
        tails: list[bytes | None] = [w[len(s):] for w, s in zip(words, stems)]
        stems = [s.lower() if s.isascii() else s for s in stems]
        for i in [i for i, s in enumerate(stems) if not s.isalpha() and not LATIN(s)]:  # of bytes: ASCII letters only
            # lower case letter by letter, whatever stands around; letters that normal form takes apart are left to the tokenizer
            text = "".join(map(str.lower, stems[i].decode()))
            if text.isalpha() and unicodedata.is_normalized("NFC", stems[i].decode()) and unicodedata.is_normalized("NFC", text):
                stems[i] = text.encode()
            else:
                tails[i] = None
        return stems, tails

    def _new_letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of lower-case letters alone. Such a word is one piece, whose last token alone carries the end mark."""
        return self._cut(self.letters, words, b" ", lambda ids: self.ends[ids], 1)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Many words at once, each by itself."""
        stems, tails = self._letters(words) if self.ends is not None else (words, [None] * len(words))
        known: dict[bytes, bytes] = {}
        wanted = {s for s, tail in zip(stems, tails) if tail is not None}
        for stem in wanted:
            ids = self.young.get(stem) or self.old.get(stem)
            if ids is not None:
                known[stem] = ids
        new = list(wanted.difference(known))
        known.update(zip(new, self._each(*self._new_letters(new)) if new else ()))
        self.young.update((s, ids) for s, ids in known.items() if len(s) <= LONGEST_CACHED)
        others = list({w for w, tail in zip(words, tails) if tail is None})
        joined = [w for w in others if self.mark and self.mark[:1] not in w]
        apart = dict(zip(joined, self._each(*self._cut(self.tokenizer, joined, self.mark, lambda ids: ids == self.mark_id, 0))))
        for word in set(others).difference(apart):
            apart[word] = np.array(self._alone(word.decode()), self.width).tobytes()
        if len(self.tails) > 1000:
            self.tails = {b"": b""}
        for tail in set(tails).difference(self.tails, [None]):
            self.tails[tail] = np.array(self._alone(tail.decode()), self.width).tobytes()
        marks = self.tails
        return [apart[w] if tail is None else known[s] + marks[tail] for w, s, tail in zip(words, stems, tails)]

    def _remembered(self, words: list[bytes]) -> list[bytes]:
        """The ids of words that are too long for a key."""
        if len(self.young) >= CACHED_WORDS:
            self.old, self.young = self.young, {}
        missing = set(words).difference(self.young)
        new = [w for w in missing if w not in self.old]
        self.young.update((w, self.old[w]) for w in missing.difference(new))
        self.young.update(zip(new, self.encode(new)))
        found = [self.young[w] for w in words]
        for word in [w for w in new if len(w) > LONGEST_CACHED]:
            del self.young[word]
        return found

    def _find(self, text: bytes, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        """Pieces of a stretch that ends in white space, and its ``separators``: where they start and stop, whether they are words as
        they stand (not letters in lower case, or marks after letters), and the stretch in lower case."""
        size = len(text)
        data = np.frombuffer(text, np.uint8)
        kind, low = (KINDS if self.ends is not None else WORDS_ONLY)[data], data
        if self.ends is not None:
            low = LOWER[data]
            second = np.flatnonzero(data[:-1] == LEAD) + 1
            second = second[SECOND[data[second]]]
            kind[second], kind[second - 1] = LETTER, LETTER
            low[second] = SECOND_LOWER[data[second]]
        before = kind << 2
        before[1:], before[0] = before[:-1].copy(), GAP
        steps = STEPS[before | kind]
        words = np.flatnonzero(steps & WORD_START)
        whole = np.zeros(len(words), bool)
        whole[np.searchsorted(words, np.flatnonzero(steps & NOT_PLAIN), "right") - 1] = True
        tails = np.flatnonzero(steps & TAIL)
        tails = tails[~whole[np.searchsorted(words, tails, "right") - 1]]
        begin, end = np.zeros(size, bool), np.zeros(size + 1, bool)
        begin[words] = begin[tails] = begin[separators] = True
        end[:-1] = steps & WORD_STOP
        end[tails] = end[separators + 1] = True
        starts, stops = np.flatnonzero(begin), np.flatnonzero(end)
        as_is = np.zeros(len(starts), bool)
        as_is[np.searchsorted(starts, words[whole])] = True
        return starts, stops, as_is, low.tobytes()

    def _stretch(self, text: bytes, separators: np.ndarray, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a stretch, with ``end`` for each separator, and the number of ids up to and with each of these."""
        pieces = self.pieces
        if pieces.n > CACHED_PIECES:
            pieces.drop(CACHED_PIECES // 2)
        starts, stops, as_is, low = self._find(text, separators)
        n = np.minimum(stops - starts, KEYED + 1)

        def key(source: bytes, some) -> tuple[np.ndarray, np.ndarray]:
            windows = np.ndarray(len(source) + 8, "<u8", source + bytes(16), 0, (1,))
            return windows[starts[some]] & FIRST_8[n[some]], windows[starts[some] + 8] & NEXT_7[n[some]]

        first, second = key(low, slice(None))
        first[as_is], second[as_is] = key(text, as_is)
        second |= (n + as_is * 16).astype(np.uint64) << np.uint64(56)
        found, breaks = pieces.find(first, second), np.searchsorted(starts, separators)
        keyed = n <= KEYED
        keyed[breaks] = False
        pieces.hit[found[keyed & (found >= 0)]] = True

        new = np.flatnonzero(keyed & (found < 0))
        if len(new):
            self._learn(text, low, starts, stops, as_is, first, second, new)
            found[new] = pieces.find(first[new], second[new])
        at, counts = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
        at[keyed] = pieces.at[found[keyed]]
        counts[keyed] = pieces.at[found[keyed] + 1] - at[keyed]

        # the ids of end and of longer words lie behind those of the table until they are copied
        long = np.flatnonzero(n > KEYED)
        words = [(text if whole else low)[s:e] for s, e, whole in zip(starts[long].tolist(), stops[long].tolist(), as_is[long].tolist())]
        coded = [end, *self._remembered(words)]
        behind = np.frombuffer(b"".join(coded), self.width)
        sizes = np.array([*map(len, coded)], np.int64) // behind.itemsize
        top = int(pieces.at[pieces.n])
        pieces.room(len(behind))
        pieces.ids[top:top + len(behind)] = behind
        at[long], counts[long] = (top + np.cumsum(sizes) - sizes)[1:], sizes[1:]
        at[breaks], counts[breaks] = top, sizes[0]
        return pieces.ids[slices(at, counts)], np.cumsum(counts)[breaks]

    def _learn(self, text: bytes, low: bytes, starts, stops, as_is, first, second, new: np.ndarray) -> None:
        """The ids of the pieces at ``new``, which the table does not have, each once."""
        new = new[np.lexsort((second[new], first[new]))]
        differs = np.ones(len(new), bool)
        differs[1:] = (first[new[1:]] != first[new[:-1]]) | (second[new[1:]] != second[new[:-1]])
        new = new[differs]
        stem = ~as_is[new] & (KINDS[np.frombuffer(low, np.uint8)[starts[new]]] != MARK)
        stems, others = new[stem], new[~stem]
        if len(stems):
            self.pieces.add(first[stems], second[stems], *self._new_letters(self._bytes(low, starts[stems], stops[stems])))
        if len(others):
            coded = self.encode(self._bytes(text, starts[others], stops[others]))
            ids = np.frombuffer(b"".join(coded), self.width)
            self.pieces.add(first[others], second[others], ids, np.array([len(c) for c in coded], np.int64) // ids.itemsize)

    @staticmethod
    def _bytes(text: bytes, starts: np.ndarray, stops: np.ndarray) -> list[bytes]:
        return [text[s:e] for s, e in zip(starts.tolist(), stops.tolist())]

    def texts(self, texts: list[bytes], end: bytes) -> list[bytes]:
        """The ids of texts, each followed by ``end``. They are taken in stretches of about STRETCH bytes, however long a text is."""
        if not texts:
            return []
        joined = b" ".join(texts) + b" "
        separators = np.cumsum([len(t) + 1 for t in texts]) - 1
        found, stops, start, before = [], [], 0, 0
        while start < len(joined):
            stop = SPACE(joined, min(start + STRETCH, len(joined)) - 1).end()
            inside = separators[np.searchsorted(separators, start):np.searchsorted(separators, stop)]
            ids, at = self._stretch(joined[start:stop], inside - start, end)
            found.append(ids)
            stops.append(at + before)
            start, before = stop, before + len(ids)
        return self._each(np.concatenate(found), np.diff(np.concatenate(stops), prepend=0))


def id_width(spark: SparkSession, path: str) -> str:
    """Found out by a task: a driver that reads the tokenizer's file does not get that memory back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([Tokenizer.from_file(path).get_vocab_size()], pa.int64())], ["size"])

    return "<u2" if map_arrow(spark.range(0, 1, 1, 1), run, "size long").first()["size"] <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 1, width: str | None = None) -> DataFrame:
    """(doc_id, ids) of every whole text; ids are little-endian integers of ``width``, with ``end_id`` at the end.

    For tokenizers that drop white space and cut at it (words are then independent of each other).
    """
    width = width or id_width(docs.sparkSession, tokenizer)
    end = np.array([end_id], width).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = kept(("word ids", tokenizer, width), lambda: WordIds(tokenizer, width))
        for batch in batches:
            texts, out = as_bytes(batch.column(1)), []
            for some in text_chunks(texts):
                out += cache.texts(texts[some], end)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "ids"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, ids binary")


def count_ids(rows: DataFrame, width: str) -> DataFrame:
    """(symbol, n) over all id rows; one array of counts per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), width))
            if len(found) > len(total):
                total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
            total[:len(found)] += found
        symbols = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(symbols, pa.int64()), pa.array(total[symbols], pa.int64())], ["symbol", "n"])

    return map_arrow(rows.select("ids"), run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge) for positive counts."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.uint8)
    max_bits = max(max_bits, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(max_bits):
        merged = np.concatenate([leaves, packages])
        rank = np.argsort(merged, kind="stable")
        merged, is_leaf = merged[rank], rank < n
        levels.append(is_leaf)
        pairs = len(merged) // 2
        packages = merged[:2 * pairs].reshape(pairs, 2).sum(1)
    lengths, take = np.zeros(n, np.uint8), 2 * n - 2
    for is_leaf in reversed(levels):
        own = int(is_leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.uint8)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes and the decoding table of (symbols, lengths)."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((symbols, lengths))
        self.symbols, self.lengths = symbols[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(self.lengths.max()) if len(order) else 1
        # the i-th code, filled up to the longest length, is what the codes before it use up
        spans = np.left_shift(1, self.bits - self.lengths)
        self.starts = np.cumsum(spans) - spans
        self.spans = spans

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.symbols.max()) + 1 if len(self.symbols) else 0
        codes, lengths = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        codes[self.symbols], lengths[self.symbols] = self.starts >> (self.bits - self.lengths), self.lengths
        return codes, lengths

    def decoder(self) -> np.ndarray:
        """symbol * 64 + length at every bit pattern of the longest length."""
        filled = np.repeat(self.symbols * 64 + self.lengths, self.spans)
        return np.concatenate([filled, np.full((1 << self.bits) - len(filled), 1)]).astype(np.int64)


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """(payload, checkpoints) of one block."""
    length = lengths[ids]
    ends = np.cumsum(length)
    starts = ends - length
    # a code of at most 32 bits lies in two neighbouring 32-bit words; bits never overlap, so sums are unions
    word = starts >> 5
    placed = codes[ids] << (64 - (starts & 31) - length).astype(np.uint64)
    words = int(ends[-1] + 31 >> 5) + 1
    bits = np.bincount(word, (placed >> np.uint64(32)).astype(np.float64), words)
    bits += np.bincount(word + 1, (placed & np.uint64(0xFFFFFFFF)).astype(np.float64), words)[:words] if len(ids) else 0
    payload = bits.astype(np.uint64).astype(">u4").tobytes()[:int(ends[-1] + 7 >> 3)]
    return payload, starts[::SEGMENT].astype("<u4").tobytes()


def decode_blocks(payloads: list[bytes], checkpoints: list[bytes], totals: list[int], table: np.ndarray, bits: int) -> list[np.ndarray]:
    """Ids of several blocks: all their segments advance together, one id a step, by table look-up."""
    base, lanes, firsts = 0, [], []
    for payload, marks in zip(payloads, checkpoints):
        firsts.append(sum(map(len, lanes)))
        lanes.append(np.frombuffer(marks, "<u4").astype(np.int64) + base * 8)
        base += len(payload)
    at = np.concatenate(lanes)
    buffer = np.frombuffer(b"".join(payloads) + bytes(8 + SEGMENT * bits // 8), np.uint8)
    windows = np.ndarray(len(buffer) - 7, ">u8", buffer, 0, (1,))
    out = np.empty((SEGMENT, len(at)), np.int64)
    drop = np.uint64(64 - bits)
    for step in range(SEGMENT):
        window = windows[np.minimum(at >> 3, len(windows) - 1)].astype(np.uint64)
        hit = table[((window << (at & 7).astype(np.uint64)) >> drop).astype(np.int64)]
        out[step] = hit >> 6
        at = at + (hit & 63)
    flat = out.T.reshape(-1)
    return [flat[f * SEGMENT:f * SEGMENT + n] for f, n in zip(firsts, totals)]


def write_ids(rows: DataFrame, path: str, width: str = "<u2", max_bits: int = MAX_BITS, block_ids: int = BLOCK_IDS) -> None:
    """Write (doc_id, ids) rows as an id file at ``path``, in ascending doc_id. ``rows`` should be a stored table: it is
    read for the counts, for the range bounds and for the sort. Counts come to the driver: one per symbol of the vocabulary."""
    spark = rows.sparkSession
    found = count_ids(rows, width).toPandas()
    symbols = found["symbol"].to_numpy(np.int64)
    lengths = code_lengths(found["n"].to_numpy(np.int64), max_bits)
    spark.createDataFrame([(int(s), int(b)) for s, b in zip(symbols, lengths)], "symbol long, bits int") \
        .write.parquet(f"{path}/codebook")
    codes, code_bits = Codebook(symbols, lengths).encoder()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        docs, held, size, first = [], [], 0, 0

        def block() -> pa.RecordBatch:
            payload, marks = encode_block(np.concatenate(held), codes, code_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                 pa.array([[len(h) for h in held]], pa.list_(pa.int64())), pa.array([marks], pa.binary()),
                 pa.array([payload], pa.binary())], ["part", "first", "doc_ids", "counts", "checkpoints", "payload"])

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                docs.append(doc)
                held.append(np.frombuffer(raw, width).astype(np.int64))
                size += len(held[-1])
                if size >= block_ids:
                    yield block()
                    docs, held, size, first = [], [], 0, first + size
        if docs:
            yield block()

    # the sample that range bounds are drawn from goes to the driver: it holds a hash of the ids, not the ids of long texts
    order = ["doc_id", F.xxhash64("ids")]
    ordered = rows.select("doc_id", "ids").repartitionByRange(*order).sortWithinPartitions(*order)
    map_arrow(ordered, run, "part int, first long, doc_ids array<long>, counts array<long>, checkpoints binary, payload binary") \
        .write.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, batch_ids: int = 1 << 20) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of an id file, from its decoded ids; ``start`` counts the
    ids of all documents before it. One row per part goes into the running sum."""
    book = spark.read.parquet(f"{path}/codebook").toPandas()
    code = Codebook(book["symbol"].to_numpy(np.int64), book["bits"].to_numpy(np.int64))
    table, bits = code.decoder(), code.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, before, docs, counts, marks, payloads = (c.to_pylist() for c in batch.columns)
            totals = [sum(c) for c in counts]
            first = 0
            while first < len(part):
                last, size = first, 0
                while last < len(part) and (last == first or size + totals[last] <= batch_ids):
                    size, last = size + totals[last], last + 1
                some, rows = slice(first, last), []
                decoded = decode_blocks(payloads[some], marks[some], totals[some], table, bits)
                for p, start, ids, ns, block in zip(part[some], before[some], docs[some], counts[some], decoded):
                    raw, at = block.astype("<u4").tobytes(), 0
                    for doc, n in zip(ids, ns):
                        rows.append((p, doc, start + at, n, zlib.crc32(raw[4 * at:4 * (at + n)])))
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), *[pa.int64()] * 4])],
                    ["part", "doc_id", "first", "n_tokens", "ids_crc32"])
                first = last

    blocks = spark.read.parquet(f"{path}/blocks")
    ids = F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)
    sizes = blocks.groupBy("part").agg(F.sum(ids).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    decoded = map_arrow(blocks.select("part", "first", "doc_ids", "counts", "checkpoints", "payload"), run,
                        "part int, doc_id long, first long, n_tokens long, ids_crc32 long")
    return decoded.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokenize, write the id file (``path``, or a new folder in the shared one) and return what reading it gives."""
    spark = docs.sparkSession
    width = id_width(spark, tokenizer)
    rows = stored(tokenize(id_text(docs, id_column, text_column), tokenizer, end_id, width), "token-ids")
    path = path or scratch_path(spark, "id-file")
    write_ids(rows, path, width)
    return read_ids(spark, path)
