"""Benchmark decontamination by latent semantic retrieval, for verbatim and reworded passages.

1. Words hash to FEATURES columns; document frequencies are counted over all texts. Content words are those in at most
   ``common_share`` of the documents; their weight is log(documents / frequency). An item of SHORT words or more that would
   keep fewer than half of them (an item copied all over) is a common item: it keeps all its words, which weigh at least
   log(1 / common_share), and is looked for on its own among content words and the words of common items. Other items, and
   their passages, never see these words.
2. Passages (WINDOW content words, every STRIDE) of all documents, and all benchmark items, form a
   sparse TF-IDF matrix A. A randomised SVD finds its leading right singular vectors: tasks add up A'(A Q) for a random
   block Q, and (A Q)'(A Q) for the orthonormal range of that; the driver sees blocks of FEATURES x rank numbers only. Words are
   hashed once, and stored as columns for both rounds.
3. Every passage of every text is projected, and its cosine with every item is one product of matrices per stretch of texts.
   Candidates are the pairs whose cosine reaches the item's bound (``cosine_bounds``): ``slack`` times the cosine of a
   passage that shares ``lcs_share`` of as many words as item and passage can share at all.
4. A candidate is checked on words: the longest common subsequence of the item's content words and the passage with half
   an item on either side, as a share of the item, and the share of the item's ``answers`` rarest words in there.
   A copy has ``copy_share`` in common; a reworded one ``lcs_share``, and half of the answer words. Candidates that do not even
   hold enough words of the item are left out by a count before.
5. Beside the search, the word sequence of every item, of one word or more and common words included, is looked up in every
   text: by the heaviest pair of neighbouring words first, then word by word. Such a match is ``verbatim`` with shares of 1; its
   cosine is that of the search, null where only the look-up found it.

The latent space is fitted on the passages of all texts, as they are looked up in it. Items are taken in blocks of
``item_block``, so that any number of them fits a worker.

Edge cases: null texts are empty and match nothing; null or repeated items match like any other text of theirs, items
without words match nothing, those with fewer than three content words only verbatim; texts shorter than a window are one passage; without items or documents nothing is
found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.llm.common import as_bytes, by_value, id_text, map_arrow, sampled, stored, text_chunks

FEATURES = 1 << 15
WINDOW, STRIDE = 24, 12
RANK, EXTRA = 120, 8
SLACK = 0.65
ROWS = 1 << 16  # words projected, and numbers compared, at a time
CODE = "<u2"  # of a column
AT_ONCE = 1024  # sums made side by side, so that they stay in the processor's cache
CHECKED = 1 << 19  # words of candidates counted at a time: some 30 bytes each, in every worker
SHORT = 8
PAIRS = 1 << 20
# punctuation becomes white space
APART = bytes(32 if chr(b) in ".,;:!?\"'()[]{}<>|*#$%&" else b for b in range(256))
MATCHES = "array<struct<item_id:bigint,cosine:double,lcs:bigint,lcs_share:double,answer_share:double,verbatim:boolean>>"


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(APART).split()


class Hashing:
    """Columns of words, for many texts at once: a polynomial hash of every word from running sums over the bytes."""

    FACTOR = 0x9E3779B97F4A7C15
    PIECE = 1 << 16  # bytes: what is made of them stays in the processor's cache

    def __init__(self):
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.up, self.down = self._powers(self.FACTOR, 1), self._powers(1, 1)

    @staticmethod
    def _powers(factor: int, count: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < count:
            out = np.concatenate([out, out * np.uint64(pow(factor, len(out), 1 << 64))])
        return out

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, column) of the words of bytes that begin and end between words."""
        if len(self.up) <= len(data):
            self.up = self._powers(self.FACTOR, len(data) + 1)
            self.down = self._powers(pow(self.FACTOR, -1, 1 << 64), len(data) + 1)
        inside = np.concatenate([[False], ~self.space[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)])])
        value = (sums[ends] - sums[starts]) * self.down[starts]
        value = (value ^ value >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
        return starts, ((value ^ value >> np.uint64(29)) % np.uint64(FEATURES)).astype(np.int64)

    def of_texts(self, texts: list[bytes]) -> list[np.ndarray]:
        """The columns of each text's words, in order."""
        data = np.frombuffer(b" ".join(texts).lower().translate(APART) + b" ", np.uint8)
        places, columns, at = [], [], 0
        while at < len(data):
            end = at + self.PIECE
            while end < len(data) and not self.space[data[end]]:
                end += 1
            some, found = self._piece(data[at:end])
            places.append(some + at)
            columns.append(found)
            at = end
        first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        cuts = np.searchsorted(np.concatenate(places), first[1:]) if texts else []
        return np.split(np.concatenate(columns), cuts) if texts else []

    def of(self, text: bytes) -> np.ndarray:
        return self.of_texts([text])[0]


def pair_keys(columns: np.ndarray) -> np.ndarray:
    """Of each word and the next."""
    return (columns[:-1] * 40503 + columns[1:]) % PAIRS


@dataclass
class Space:
    """Weights of the columns (0: not a content word), weights that common items see, and the latent directions, not weighted."""
    weights: np.ndarray
    directions: np.ndarray = field(default_factory=lambda: np.zeros((FEATURES, 0), np.float32))
    common_weights: np.ndarray | None = None

    def content(self, columns: np.ndarray) -> np.ndarray:
        return columns[self.weights[columns] > 0]

    def of_common_items(self) -> Space:
        return Space(self.weights if self.common_weights is None else self.common_weights, self.directions)


@dataclass
class Item:
    item_id: int
    columns: np.ndarray
    places: dict
    answers: set
    words: list[bytes] = field(default_factory=list)
    every: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # columns of all words


def bounds(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the passages of n content words."""
    starts = np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)
    return starts, np.minimum(starts + WINDOW, n)


def coded(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(counted, columns) of every text, which counts, and of every item, which does not: the columns of its words in order, in two
    bytes each. Stored, so that a text is cut into words once for all that the fit asks of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = Hashing()
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for some in text_chunks(texts):
                columns = pa.array([c.astype(CODE).tobytes() for c in hashing.of_texts(texts[some])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[some.start:some.stop], columns], ["counted", "columns"])

    rows = texts.select(F.lit(True).alias("counted"), "text").unionAll(items.select(F.lit(False), "text"))
    return stored(map_arrow(rows, run, "counted boolean, columns binary"), "columns")


def document_frequencies(words: DataFrame) -> tuple[np.ndarray, int]:
    """(frequency of each column, number of documents) over the rows that count; FEATURES rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(FEATURES + 1, np.int64), 0
        for batch in batches:
            raw = batch.column(0).to_pylist()
            n += len(raw)
            raw = [r for r in raw if r]  # so that texts of a stretch are fewer than ROWS
            for some in text_chunks(raw, 2 * ROWS):
                sizes = [len(r) // 2 for r in raw[some]]
                held = np.repeat(np.arange(len(sizes), dtype=np.uint32) * np.uint32(FEATURES), sizes) | np.frombuffer(b"".join(raw[some]), CODE)
                held.sort()
                counts[:FEATURES] += np.bincount(held[np.append(True, held[1:] != held[:-1])] % FEATURES, minlength=FEATURES)
        counts[FEATURES] = n
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts[found], pa.int64())], ["c", "n"])

    rows = map_arrow(words.where("counted").select("columns"), run, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(FEATURES + 1, np.int64)
    counts[rows["c"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts[:-1], int(counts[-1])


def column_weights(frequencies: np.ndarray, documents: int, common_share: float) -> np.ndarray:
    weights = np.log((documents + 1) / (frequencies + 1.0)) + 1e-3
    return np.where(frequencies > max(common_share * documents, 3), 0, weights).astype(np.float32)


def is_common(columns: np.ndarray, weights: np.ndarray) -> bool:
    """Whether common words are more than half of an item of these columns."""
    return len(columns) >= SHORT and 2 * int((weights[columns] == 0).sum()) > len(columns)


def with_words_of_common_items(weights: np.ndarray, frequencies: np.ndarray, documents: int, items: DataFrame, common_share: float) -> np.ndarray:
    """Weights in which the words of common items have one; at most FEATURES rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, lost = Hashing(), np.zeros(FEATURES, bool)
        for batch in batches:
            for columns in hashing.of_texts(as_bytes(batch.column(0))):
                if is_common(columns, weights):
                    lost[columns[weights[columns] == 0]] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(lost), pa.int64())], ["c"])

    lost = map_arrow(items.select("text"), run, "c long").distinct().toPandas()["c"].to_numpy(np.int64)
    least = max(np.log(1 / max(common_share, 1e-3)), 1e-3)
    out = weights.copy()
    out[lost] = np.maximum(np.log((documents + 1) / (frequencies[lost] + 1.0)), least)
    return out


def contents_of(columns: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The columns, and the sizes, of the content words of texts that stand one after the other."""
    held, ends = weights[columns] > 0, np.cumsum(sizes)
    upto = np.concatenate([[0], np.cumsum(held)])
    return columns[held], upto[ends] - upto[ends - sizes]


def in_strides(columns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words of each stride, FEATURES standing for no word; strides of each text)."""
    counts = -(-sizes // STRIDE)
    words = np.full(int(counts.sum()) * STRIDE, FEATURES, np.int32)
    words[np.arange(len(columns)) + np.repeat(STRIDE * (np.cumsum(counts) - counts) - (np.cumsum(sizes) - sizes), sizes)] = columns
    return words.reshape(-1, STRIDE), counts


def sums_of(table: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each row of words, the sum of their rows of the table."""
    sums, held = np.empty((len(words), table.shape[1]), np.float32), np.empty((AT_ONCE, table.shape[1]), np.float32)
    for at in range(0, len(words), AT_ONCE):
        places, out = words[at:at + AT_ONCE].T.astype(np.intp, order="C"), sums[at:at + AT_ONCE]
        np.take(table, places[0], axis=0, out=out, mode="clip")
        for own in places[1:]:
            out += np.take(table, own, axis=0, out=held[:len(out)], mode="clip")
    return sums


class Passages:
    """All passages of some texts, given by the columns of their content words one after the other: strides of a text, of
    which a passage is one and the next of its text, or the only one."""

    def __init__(self, columns: np.ndarray, sizes: np.ndarray, weights: np.ndarray):
        self.words, counts = in_strides(columns, sizes)
        owner = np.repeat(np.arange(len(sizes)), counts)
        joined = np.append(owner[1:] == owner[:-1], False)
        self.heads = np.flatnonzero(joined | (counts[owner] == 1))
        self.two = joined[self.heads]
        self.squares = self._squares(np.append(weights, 0))

    def _squares(self, weights: np.ndarray) -> np.ndarray:
        """The squared length of each passage's weighted counts: a word that stands in it n times weighs n * n times its square."""
        words = np.full((len(self.heads), WINDOW), FEATURES, CODE)
        words[:, :STRIDE] = self.words[self.heads]
        words[self.two, STRIDE:] = self.words[self.heads[self.two] + 1]
        words.sort(axis=1)  # no word comes last: its weight is zero
        change = np.ones(words.shape, bool)
        change[:, 1:] = words[:, 1:] != words[:, :-1]
        starts = np.flatnonzero(change)
        times = np.diff(starts, append=words.size)
        return np.bincount(starts // WINDOW, times * times * (weights.astype(np.float64) ** 2)[words.ravel()[starts]], len(words))

    def projected(self, table: np.ndarray) -> np.ndarray:
        """The sum of a table's rows over the words of each passage."""
        sums = sums_of(table, self.words)
        vectors = sums[self.heads]
        vectors[self.two] += sums[self.heads[self.two] + 1]
        return vectors

    def spread(self, vectors: np.ndarray, total: np.ndarray) -> None:
        """Add each passage's vector to the rows of its words."""
        strides = np.zeros((len(self.words) + 1, vectors.shape[1]), np.float32)  # the last one is zero
        strides[self.heads] = vectors
        strides[self.heads[self.two] + 1] += vectors[self.two]
        columns = self.words.ravel()
        order = np.argsort(columns.astype(CODE), kind="stable")  # no word comes last
        columns = columns[order[:int((columns < FEATURES).sum())]]
        add_rows(total, columns, order[:len(columns)] // STRIDE, strides)


def add_rows(total: np.ndarray, columns: np.ndarray, rows: np.ndarray, table: np.ndarray) -> None:
    """Add rows of a table, whose last row is zero, to the total's rows of ``columns``, which are in order: two by two of one
    column, then two by two of these sums, until there is one for each."""
    first = np.flatnonzero(np.append(True, columns[1:] != columns[:-1])) if len(columns) else columns
    columns, counts = columns[first], np.diff(first, append=len(rows))
    alone = counts == 1
    total[columns[alone]] += table[rows[first[alone]]]
    columns, rows, counts = columns[~alone], rows[np.repeat(~alone, counts)], counts[~alone]
    while len(columns):
        halves = (counts + 1) // 2
        first = np.repeat(np.cumsum(counts) - counts, halves)
        place = 2 * (np.arange(len(first)) - np.repeat(np.cumsum(halves) - halves, halves))
        left, single = first + place, place + 1 == np.repeat(counts, halves)
        right = np.where(single, len(table) - 1, rows[np.minimum(left + 1, len(rows) - 1)])
        left = rows[left]
        sums, held = np.empty((len(left) + 1, table.shape[1]), np.float32), np.empty((AT_ONCE, table.shape[1]), np.float32)
        sums[-1] = 0
        for at in range(0, len(left), AT_ONCE):
            end = min(at + AT_ONCE, len(left))
            np.take(table, left[at:end], axis=0, out=sums[at:end], mode="clip")
            sums[at:end] += np.take(table, right[at:end], axis=0, out=held[:end - at], mode="clip")
        done = halves == 1
        own = np.cumsum(halves) - halves
        total[columns[done]] += sums[own[done]]
        rows = np.flatnonzero(np.repeat(~done, halves))
        columns, counts, table = columns[~done], halves[~done], sums


def passages_of(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[Passages]:
    """The passages of coded texts, of some at a time; texts without content words have none."""
    for batch in batches:
        raw = batch.column(0).to_pylist()
        for some in text_chunks(raw, 2 * ROWS):
            columns, sizes = contents_of(np.frombuffer(b"".join(raw[some]), CODE), np.array([len(r) // 2 for r in raw[some]], np.int64), weights)
            if sizes.max() <= 2 * ROWS:
                if len(columns):
                    yield Passages(columns, sizes, weights)
            else:
                for own in np.split(columns, np.cumsum(sizes)[:-1]):
                    for piece in pieces_of(own):
                        yield Passages(piece, np.array([len(piece)], np.int64), weights)


def pieces_of(columns: np.ndarray) -> Iterator[np.ndarray]:
    """The content words of a long text by pieces, each of which begins with the last stride of the one before: a passage of the text is one
    of just one piece."""
    step = ROWS // STRIDE * STRIDE
    for at in range(0, len(columns) if len(columns) <= STRIDE else len(columns) - STRIDE, step):
        yield columns[at:at + step + STRIDE]


def with_no_word(table: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.concatenate([table.astype(np.float32) * weights[:, None], np.zeros((1, table.shape[1]), np.float32)])


def added(parts: DataFrame, kind: str) -> DataFrame:
    """The sum of the (at, part) arrays of each place."""
    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": [key[0]], "part": [np.sum([np.frombuffer(p, kind) for p in rows["part"]], axis=0, dtype=kind).tobytes()]})

    return parts.groupBy("at").applyInPandas(by_value(add), "at long, part binary")


def range_of(words: DataFrame, weights: np.ndarray, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """A'(A block) of a random block as (first row, rows): each task adds up its passages, the sums of tasks meet by ranges of columns."""
    wide = 512

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = with_no_word(random_block(seed), weights)
        total = np.zeros((FEATURES, RANK + EXTRA), np.float32)
        for passages in passages_of(batches, weights):
            passages.spread(passages.projected(table) / passages.squares[:, None].astype(np.float32), total)
        total *= weights[:, None]
        for at in range(0, len(total), wide):
            if total[at:at + wide].any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total[at:at + wide].tobytes()], pa.binary())], ["at", "part"])

    sums = added(map_arrow(words, run, "at long, part binary"), "<f4")
    # a partition at a time: the driver holds no more of the sums than it keeps
    for at, part in sums.toLocalIterator():
        yield at, np.frombuffer(part, np.float32).reshape(-1, RANK + EXTRA)


def products_in(words: DataFrame, weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """(A basis)'(A basis), which is basis' A'A basis: a small matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = with_no_word(basis, weights), np.zeros((RANK + EXTRA, RANK + EXTRA))
        for passages in passages_of(batches, weights):
            vectors = passages.projected(table) / np.sqrt(passages.squares)[:, None].astype(np.float32)
            total += vectors.T @ vectors
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["at", "part"])

    found = added(map_arrow(words, run, "at long, part binary"), "<f8").collect()
    return sum((np.frombuffer(r["part"]).reshape(RANK + EXTRA, -1) for r in found), np.zeros((RANK + EXTRA, RANK + EXTRA)))


def random_block(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((FEATURES, RANK + EXTRA), dtype=np.float32).astype(np.float16)


def orthonormalise(block: np.ndarray, rows: int = 4096) -> None:
    """Put an orthonormal basis of the columns in their place: a QR of each stretch of rows, no fewer than the columns, and one
    of their triangles. A QR of the whole would hold five times the block beside it."""
    pieces = [block[at:at + rows] for at in range(0, len(block), rows)]
    triangles = [np.linalg.qr(piece.astype(np.float64), mode="r") for piece in pieces]
    turns = np.split(np.linalg.qr(np.concatenate(triangles))[0], len(pieces))
    for piece, turn in zip(pieces, turns):
        piece[:] = np.linalg.qr(piece.astype(np.float64))[0] @ turn


def fit_space(texts: DataFrame, items: DataFrame, common_share: float, fit_documents: int | None = None, seed: int = 5) -> Space:
    """Weights and directions over all texts: a randomised SVD of all passages of theirs and of the items. ``fit_documents``: a
    caller may leave the directions to a sample of so many texts."""
    words = coded(texts, items)
    frequencies, documents = document_frequencies(words)
    content_weights = column_weights(frequencies, documents, common_share)
    weights = with_words_of_common_items(content_weights, frequencies, documents, items, common_share)
    space = Space(content_weights, common_weights=weights)
    if fit_documents is not None:
        words = coded(sampled(texts, ["doc_id", "text"], fit_documents), items)
    # a task's sums are as long as the basis, however few passages it has: no more tasks than there are cores
    words = words.select("columns").coalesce(max(4, texts.sparkSession.sparkContext.defaultParallelism))
    basis = np.zeros((FEATURES, RANK + EXTRA), np.float32)
    for at, rows in range_of(words, weights, seed):
        basis[at:at + len(rows)] = rows
    orthonormalise(basis)
    # half the bytes to every task; sums are not halved
    values, vectors = np.linalg.eigh(products_in(words, weights, basis.astype(np.float16)))
    top = np.argsort(values)[::-1][:RANK]
    # divided by the singular values: else the first directions, common to most texts, would make all passages alike
    scale = 1 / np.sqrt(np.maximum(values[top], 1e-9 * max(values.max(), 1e-9)))
    space.directions = (basis @ (vectors[:, top] * scale / scale.max()).astype(np.float32)).astype(np.float16)
    return space


def make_items(rows: list, space: Space, answers: int) -> tuple[list[Item], list[Item]]:
    """(items on content words, common items) of (item_id, text) rows; items without words are left out."""
    hashing, usual, common = Hashing(), [], []
    for item_id, text in rows:
        every = hashing.of((text or "").encode())
        if not len(every):
            continue
        kind, into = (space.of_common_items(), common) if is_common(every, space.weights) else (space, usual)
        columns = kind.content(every)
        places: dict = {}
        for i, c in enumerate(columns.tolist()):
            places[c] = places.get(c, 0) | 1 << i
        rare = sorted(set(columns.tolist()), key=lambda c: (-kind.weights[c], c))[:answers]
        into.append(Item(item_id, columns, places, set(rare), words_of((text or "").encode()), every))
    return usual, common


def common_subsequence(segment: list[int], item: Item) -> int:
    """Length of the longest common subsequence: one bit per word of the item, one addition per word of the segment."""
    full = (1 << len(item.columns)) - 1
    row = full
    for column in segment:
        hits = row & item.places.get(column, 0)
        if hits:
            row = (row + hits | row - hits) & full
    return len(item.columns) - row.bit_count()


def cosine_bounds(lengths: np.ndarray, lcs_share: float, slack: float) -> np.ndarray:
    """The least cosine of a candidate, by an item's content words: of m words, a passage of WINDOW ones can share the smaller
    number, and shares ``lcs_share`` of it; all words weighing alike, that gives lcs_share * sqrt(smaller / larger)."""
    smaller, larger = np.minimum(lengths, WINDOW), np.maximum(lengths, WINDOW)
    return (slack * lcs_share * np.sqrt(smaller / larger)).astype(np.float32)


@dataclass
class Search:
    """Latent search for items of one kind."""
    space: Space
    items: list[Item]
    lcs_share: float = 0.5
    copy_share: float = 0.75
    slack: float = SLACK

    def prepared(self) -> Search:
        """What tasks work out for themselves, rather than have it sent."""
        self.items = [i for i in self.items if len(i.columns) >= 3]
        directions = self.space.directions.astype(np.float32) * self.space.weights[:, None]
        self.weighted = np.concatenate([directions, np.zeros((1, directions.shape[1]), np.float32)])  # the last row stands for no word
        vectors = np.array([self.weighted[i.columns].sum(0) for i in self.items], np.float32).reshape(len(self.items), self.weighted.shape[1])
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        # row by row, and candidates in order of items, so that a look-up stays in one row
        self.member = np.zeros((len(self.items), FEATURES), bool)
        for i, item in enumerate(self.items):
            self.member[i, item.columns] = True
        lengths = np.array([len(i.columns) for i in self.items], np.int64)
        self.half = lengths // 2 + 1
        self.needed = np.ceil(min(self.lcs_share, self.copy_share) * lengths - 1e-9).astype(np.int64)
        self.bounds = cosine_bounds(lengths, self.lcs_share, self.slack)
        return self

    def matches_of(self, texts: list[np.ndarray]) -> list[dict[int, dict]]:
        """For each text, given by the columns of its words, item -> its best passage."""
        found: list[dict[int, dict]] = [{} for _ in texts]
        if not self.items or not any(map(len, texts)):
            return found
        columns, sizes = contents_of(np.concatenate(texts).astype(np.int32), np.array([len(t) for t in texts], np.int64), self.space.weights)
        if not len(columns):
            return found
        words, counts = in_strides(columns, sizes)
        sums = sums_of(self.weighted, words)
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = (ends - sizes)[owner] + STRIDE * place
        last = np.minimum(first + STRIDE, ends[owner])
        # a passage is a stride and the next one of its text; the last stride alone only where it is the only one
        joined = np.append(owner[1:] == owner[:-1], False)
        heads = np.flatnonzero(joined | (counts[owner] == 1))
        rows = max(1, (1 << 22) // len(self.items))
        for at in range(0, len(heads), rows):
            some = heads[at:at + rows]
            vectors = sums[some]
            two = joined[some]
            vectors[two] += sums[some[two] + 1]
            vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
            near = vectors @ self.vectors.T
            row, item = np.nonzero(near >= self.bounds)
            stop = np.where(two, last[np.minimum(some + 1, len(last) - 1)], last[some])
            self._check(columns, owner[some][row], first[some][row], stop[row], (ends - sizes)[owner[some]][row], ends[owner[some]][row], item, near[row, item], found)
        return found

    def _check(self, columns, text, start, stop, low, high, item, cosine, found) -> None:
        """Candidates on words: enough words of the item in the stretch first, then their order."""
        order = np.argsort(item, kind="stable")
        text, start, stop, low, high, item, cosine = (values[order] for values in (text, start, stop, low, high, item, cosine))
        width = (stop - start).max(initial=0) + 2 * self.half[item].max(initial=0)
        rows = max(1, CHECKED // max(1, int(width)))
        for at in range(0, len(item), rows):
            some = slice(at, at + rows)
            left, right = np.maximum(start[some] - self.half[item[some]], low[some]), np.minimum(stop[some] + self.half[item[some]], high[some])
            words = left[:, None] + np.arange(int((right - left).max()))
            places = columns[np.minimum(words, len(columns) - 1)] + (item[some] * FEATURES)[:, None]
            held = self.member.reshape(-1)[places] & (words < right[:, None])
            enough = np.flatnonzero(held.sum(1) >= self.needed[item[some]])
            for t, a, b, i, c in zip(text[some][enough].tolist(), left[enough].tolist(), right[enough].tolist(), item[some][enough].tolist(), cosine[some][enough].tolist()):
                self._compare(columns[a:b].tolist(), self.items[i], c, found[t])

    def _compare(self, segment: list[int], item: Item, cosine: float, found: dict[int, dict]) -> None:
        lcs, present = common_subsequence(segment, item), set(segment)
        share, answer = lcs / len(item.columns), len(present & item.answers) / len(item.answers)
        best = found.get(item.item_id)
        if (share >= self.copy_share or share >= self.lcs_share and answer >= 0.5) and (best is None or (share, cosine) > (best["lcs_share"], best["cosine"])):
            found[item.item_id] = {"item_id": item.item_id, "cosine": cosine, "lcs": lcs, "lcs_share": share, "answer_share": answer, "verbatim": False}


class Verbatim:
    """Look-up of whole word sequences."""

    def __init__(self, items: list[Item], weights: np.ndarray):
        self.single, self.paired = np.zeros(FEATURES, bool), np.zeros(PAIRS, bool)
        self.of_single: dict[int, list] = {}
        self.of_pair: dict[int, list] = {}
        for item in items:
            if len(item.every) == 1:
                self.single[item.every] = True
                self.of_single.setdefault(int(item.every[0]), []).append((item, 0))
            else:
                weighing = weights[item.every]
                at = int(np.argmax(weighing[:-1] + weighing[1:]))
                key = int(pair_keys(item.every[at:at + 2])[0])
                self.paired[key] = True
                self.of_pair.setdefault(key, []).append((item, at))

    def of(self, every: np.ndarray, text: bytes) -> list[Item]:
        """Items whose whole word sequence stands in a text of these columns."""
        keys = pair_keys(every)
        hits = [(p, self.of_single[int(every[p])]) for p in np.flatnonzero(self.single[every])]
        hits += [(p, self.of_pair[int(keys[p])]) for p in np.flatnonzero(self.paired[keys])]
        words, found = None, {}
        for p, items in hits:
            for item, at in items:
                start, n = p - at, len(item.every)
                if item.item_id not in found and start >= 0 and np.array_equal(every[start:start + n], item.every):
                    words = words or words_of(text)
                    if words[start:start + n] == item.words:  # columns may collide
                        found[item.item_id] = item
        return list(found.values())


@dataclass
class Finder:
    """The search for both kinds of items, with the look-up beside it."""
    space: Space
    usual: list[Item]
    common: list[Item]
    lcs_share: float = 0.5
    copy_share: float = 0.75
    slack: float = SLACK

    def prepared(self) -> Finder:
        kinds = [(self.space, self.usual), (self.space.of_common_items(), self.common)]
        self.searches = [Search(space, items, self.lcs_share, self.copy_share, self.slack).prepared() for space, items in kinds if items]
        self.copies = Verbatim(self.usual + self.common, self.space.weights)
        return self

    def matches(self, texts: list[bytes], hashing: Hashing) -> list[list[dict]]:
        """Items that each text holds, the closest first."""
        columns = hashing.of_texts(texts)
        found: list[dict[int, dict]] = [{} for _ in texts]
        for search in self.searches:
            for into, more in zip(found, search.matches_of(columns)):
                into.update(more)
        for into, every, text in zip(found, columns, texts):
            for item in self.copies.of(every, text):
                cosine = into[item.item_id]["cosine"] if item.item_id in into else None
                into[item.item_id] = {"item_id": item.item_id, "cosine": cosine, "lcs": len(item.columns) or len(item.every), "lcs_share": 1.0,
                                      "answer_share": 1.0, "verbatim": True}
        return [sorted(f.values(), key=lambda m: (-m["lcs_share"], str(m["item_id"]))) for f in found]


def leaks(docs: DataFrame, benchmark: DataFrame, slack: float = SLACK, lcs_share: float = 0.5, copy_share: float = 0.75,
          answers: int = 4, common_share: float = 0.2, fit_documents: int | None = None, item_block: int = 1024,
          id_column: str = "doc_id", text_column: str = "text") -> Column:
    """A column of ``docs``: the items its text holds, as an array of MATCHES."""
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), F.coalesce(benchmark["text"], F.lit("")).alias("text"))
    space = fit_space(id_text(docs, id_column, text_column), items, common_share, fit_documents)
    blocks = -(-items.count() // item_block)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.int64()), ("lcs_share", pa.float64()), ("answer_share", pa.float64()), ("verbatim", pa.bool_())]))

    def column_of(finder: Finder) -> Column:
        def run(column: pa.Array) -> pa.Array:
            hashing, texts, out = Hashing(), as_bytes(column), []
            finder.prepared()
            for some in text_chunks(texts):
                out += finder.matches(texts[some], hashing)
            return pa.array(out, kind)
        return F.arrow_udf(by_value(run), MATCHES)(F.coalesce(docs[text_column], F.lit("")))

    found = F.array().cast(MATCHES)
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        found = F.concat(found, column_of(Finder(space, *make_items([tuple(r) for r in rows], space, answers), lcs_share, copy_share, slack)))
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no item."""
    return docs.where(F.size(leaks(docs, benchmark, **options)) == 0)
