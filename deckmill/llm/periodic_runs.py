"""Periodic runs of words: stretches that repeat with a smallest period at least three times.

A run is a stretch of consecutive words with smallest period q, of at least max(LEAST, 3 q) words, that no neighbouring
word extends keeping period q. Its search is exact:

* At every dyadic scale L = 8, 16, 32, ... the text is cut into blocks of L words. A run whose period lies in
  [L, 2 L) (below 16 for L = 8) holds a whole block together with that block's copy one period later, because a block
  starts in every L places. So a block is looked for in the window that follows, at all these distances at once.
* The search is a convolution: the sum of squared differences between block and window is
  ``sum a^2 + sum x^2 - 2 sum a x``, the last term by a number-theoretic transform of 2 L (L = 8: 32) exact integers modulo
  a prime, all blocks of a chunk together. Equal words give 0 in any case; what vanishes modulo the prime by chance is
  thrown out by comparing the words themselves.
* A block whose words do not all come again within 2 L places matches at no distance and is not transformed.
* A seed (block, distance) inside a known run of at most half a block's period has that run as its whole stretch. One
  between two known runs ends where the first of them ends or starts, too soon for a run, unless it lines up their starts or
  their ends. Both are dropped, which keeps texts of one repeated word from quadratic work.
* Seeds of neighbouring blocks join to chains, and a chain is extended by less than L words to each side, since the next
  block does not match. The stretch is a run if it is long enough for its distance and not found before with a
  smaller period, of which the distance is then a multiple (Fine and Wilf).

Work is n log^2 n integer operations for n words, memory a fixed chunk beside the text. Every text is a row of its own, so
rows are never shuffled and a lost executor repeats only its own splits.

Edge cases: null, empty and blank texts have no words, no run and an empty collapsed text; a null doc_id is kept; rows
that repeat an id are judged each on its own; texts below LEAST words have no run; an empty table gives no row; columns other than the two
named are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.llm.common import as_bytes, id_text, map_arrow, text_chunks

LEAST = 24
BASE = 8
PRIME = 998244353  # 119 * 2^23 + 1
ROOT = 3
CHUNK = 1 << 18

RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _powers(base: int, count: int) -> np.ndarray:
    """base^0, base^1, ... modulo the prime, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % np.uint64(PRIME)])
    return out[:count]


class Transform:
    """Number-theoretic transform of ``size`` points along the last axis, modulo the prime. The forward direction leaves its
    result in bit-reversed order and the inverse takes it so: products do not need the natural order."""

    made: dict[int, Transform] = {}

    def __init__(self, size: int):
        root = pow(ROOT, (PRIME - 1) // size, PRIME)
        self.size = size
        self.forward_roots, self.inverse_roots = _powers(root, size // 2), _powers(pow(root, PRIME - 2, PRIME), size // 2)
        self.scale = np.uint64(pow(size, PRIME - 2, PRIME))

    @classmethod
    def of(cls, size: int) -> Transform:
        if size not in cls.made:
            cls.made[size] = cls(size)
        return cls.made[size]

    def forward(self, rows: np.ndarray) -> np.ndarray:
        prime, half = np.uint64(PRIME), self.size // 2
        while half:
            parts = rows.reshape(len(rows), -1, 2, half)
            low, high = parts[:, :, 0], parts[:, :, 1]
            twist = self.forward_roots[::self.size // (2 * half)]
            rows = np.stack([(low + high) % prime, (low + prime - high) * twist % prime], 2).reshape(len(rows), -1)
            half //= 2
        return rows

    def inverse(self, rows: np.ndarray) -> np.ndarray:
        prime, half = np.uint64(PRIME), 1
        while half < self.size:
            parts = rows.reshape(len(rows), -1, 2, half)
            low, high = parts[:, :, 0], parts[:, :, 1] * self.inverse_roots[::self.size // (2 * half)] % prime
            rows = np.stack([(low + high) % prime, (low + prime - high) % prime], 2).reshape(len(rows), -1)
            half *= 2
        return rows * self.scale % prime


def _unknown(n: int, block: int, runs: dict[tuple[int, int], int]):
    """A test of seeds (start, distance) for whether they can belong to a run that is not among ``runs`` yet."""
    known = [(s, e) for (s, e), q in runs.items() if 2 * q <= block]
    if not known:
        return lambda start, distance: np.ones(len(start), bool)
    # the known run that holds the block from each place: at most one where twice its period fits the block
    owner = np.full(n, -1, np.int64)
    for i, (s, e) in enumerate(known):
        owner[s:max(s, e - block + 1)] = i
    starts, ends = np.array(known).T

    def test(start: np.ndarray, distance: np.ndarray) -> np.ndarray:
        here, there = owner[start], owner[start + distance]
        lined_up = (ends[there] - ends[here] == distance) | (starts[there] - starts[here] == distance)
        return (here < 0) | (there < 0) | ((here != there) & lined_up)

    return test


def _seeds(x: np.ndarray, starts: np.ndarray, block: int, nearest: int, runs: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of all copies at distances ``nearest`` to 2 * block - 1, by block convolution, but for
    those that can give no new run."""
    unknown = _unknown(len(x), block, runs)
    n, distances = len(x), 2 * block - nearest
    window = distances + block - 1
    size = 1 << (window - 1).bit_length()
    transform, prime = Transform.of(size), np.uint64(PRIME)
    padded = np.concatenate([x, np.zeros(3 * block, np.int64)]).astype(np.uint64) % prime
    squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(padded * padded % prime)])  # below 2^30 each: no overflow
    at, far = [], []
    for first in range(0, len(starts), max(1, CHUNK // size)):
        some = starts[first:first + max(1, CHUNK // size)]
        pattern = np.zeros((len(some), size), np.uint64)
        # the block backwards around place 0: the cyclic product is then its correlation with the window
        pattern[:, -np.arange(block) % size] = padded[some[:, None] + np.arange(block)]
        text = np.zeros((len(some), size), np.uint64)
        text[:, :window] = padded[some[:, None] + nearest + np.arange(window)]
        product = transform.inverse(transform.forward(pattern) * transform.forward(text) % prime)[:, :distances]
        there = some[:, None] + nearest + np.arange(distances)
        total = (squares[some + block] - squares[some])[:, None] + squares[there + block] - squares[there]
        row, place = np.nonzero((total % prime == product * np.uint64(2) % prime) & (there + block <= n))
        start, distance = some[row], nearest + place
        new = unknown(start, distance)
        start, distance = start[new], distance[new]
        for part in range(0, len(start), max(1, CHUNK // block)):
            s, d = start[part:part + max(1, CHUNK // block)], distance[part:part + max(1, CHUNK // block)]
            spots = s[:, None] + np.arange(block)
            same = (x[spots] == x[spots + d[:, None]]).all(1)
            at.append(s[same])
            far.append(d[same])
    return (np.concatenate(at), np.concatenate(far)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _matches(x: np.ndarray, at: np.ndarray, distance: np.ndarray, most: int, step: int) -> np.ndarray:
    """How many of the words at, at + step, ... (``most`` at the most) equal those ``distance`` later."""
    out = np.empty(len(at), np.int64)
    rows = max(1, CHUNK // most)
    for first in range(0, len(at), rows):
        spots = at[first:first + rows, None] + step * np.arange(most)
        later = spots + distance[first:first + rows, None]
        inside = (spots >= 0) & (later < len(x))
        same = inside & (x[np.where(inside, spots, 0)] == x[np.where(inside, later, 0)])
        out[first:first + rows] = np.where(same.all(1), most, same.argmin(1))
    return out


def find(x: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of integers, by start, then period. ``least`` is at least 24:
    shorter runs need not hold a whole block."""
    if least < LEAST:
        raise ValueError(f"runs below {LEAST} words need smaller blocks")
    n = len(x)
    if n < least:
        return []
    x = x.astype(np.int64)
    order = np.argsort(x, kind="stable")
    gaps = np.full(n, n, np.int64)
    again = x[order[1:]] == x[order[:-1]]
    gaps[order[:-1][again]] = np.diff(order)[again]
    runs: dict[tuple[int, int], int] = {}
    block, nearest = BASE, 1
    widest = gaps[:n // block * block].reshape(-1, block).max(1)
    while 3 * block <= n or block == BASE:
        starts = np.flatnonzero(widest < 2 * block) * block
        starts = starts[starts + block + nearest <= n]
        if len(starts):
            _add_runs(x, *_seeds(x, starts, block, nearest, runs), block, least, runs)
        pairs = len(widest) // 2
        widest = widest[:2 * pairs].reshape(-1, 2).max(1)
        block, nearest = 2 * block, 2 * block
    return sorted((start, end - start, period) for (start, end), period in runs.items())


def _add_runs(x: np.ndarray, at: np.ndarray, distance: np.ndarray, block: int, least: int, runs: dict[tuple[int, int], int]) -> None:
    """Chains of seeds, extended to whole stretches; new runs go into (start, end) -> period."""
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    joined = (distance[1:] == distance[:-1]) & (at[1:] == at[:-1] + block)
    heads = np.flatnonzero(np.concatenate([[True], ~joined])[:len(at)])
    tails = np.concatenate([heads[1:] - 1, [len(at) - 1]])[:len(heads)]
    first, end, distance = at[heads], at[tails] + block, distance[heads]
    if not len(first):
        return
    first = first - _matches(x, first - 1, distance, block, -1)
    end = end + _matches(x, end, distance, block, 1) + distance
    long_enough = end - first >= np.maximum(least, 3 * distance)
    for s, e, d in zip(first[long_enough].tolist(), end[long_enough].tolist(), distance[long_enough].tolist()):
        runs.setdefault((s, e), d)  # ascending distances: the smallest period of a stretch comes first


def numbers_of(words: Sequence) -> np.ndarray:
    """Equal words as equal integers."""
    seen: dict = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that are in no run after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [w for w, k in zip(words, keep.tolist()) if k]


def find_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) of every whole text: its runs as structs of start, length and period in words, by start and
    period, and the kept words joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for some in text_chunks(texts):
                found, collapsed = [], []
                for text in texts[some]:
                    words = text.split()
                    runs = find(numbers_of(words), least) if len(words) >= least else []
                    found.append([{"start": s, "length": m, "period": p} for s, m, p in runs])
                    collapsed.append(b" ".join(collapse(words, runs)).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[some.start:some.stop], pa.array(found, kind), pa.array(collapsed, pa.string())],
                    ["doc_id", "runs", "collapsed"])

    return map_arrow(id_text(docs, id_column, text_column), run, f"doc_id long, runs {RUN}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; ties: smallest start, then period. Null where there is none."""
    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (left > right) | ((left == right) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))))

    return F.reduce(runs, F.get(runs, 0), lambda best, r: F.when(better(r, best), r).otherwise(best))
