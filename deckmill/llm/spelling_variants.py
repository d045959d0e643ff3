"""Spelling variants: words one code point apart, each tied to a near word that is far more frequent.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. They are found by a bit-sliced
position index (``BitSlices``): for every (position, letter) the set of words with that letter there, as bits of one integer.
Going through a word letter by letter, five sets of the whole vocabulary are kept: all letters equal so far (zero
errors); one letter replaced; one letter more in the other word, positions shifted up by one; one letter less, shifted down by
one. Each letter costs one ``and`` per set, so 64 words are compared by one machine word.

On the cluster the vocabulary is indexed in blocks. Near words whose longer one has l letters share their first l // 2
letters or their last l - l // 2 ones, so every word goes to the groups of its first and of its last letters, for l its
length and its length plus one. A group by last letters leaves out words with equal first letters, so each pair comes once. A
group of more than BLOCK words is cut into blocks of about that size, and all its words are asked against every block: nothing
is capped, and no task holds more than one block. Words are listed by falling count, so the lowest bit is the word's form.

Counts are gathered per task before they are shuffled. What leaves a block is one row per word, never its pairs.

Edge cases: null, empty and wordless texts give no words; a null doc_id counts as an empty one; rows that repeat an id count
each; ties go to the smallest word in code-point order; an empty table gives no row; other columns are left out.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deckmill.llm.common import id_text, map_arrow, small_or_shuffled, stored

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST = 6
LEAST_COUNT = 5
RATIO = 5
BLOCK = 1 << 14
HELD_WORDS = 200_000


def count_words(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST_COUNT, misprint_every: int | None = None,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): the runs of letters of whole texts, A-Z in lower case, of at least ``shortest`` code points and ``least``
    occurrences. With ``misprint_every`` m, a run loses the code point at h % length where m divides h, the crc32 of
    ``<id>:<run>``: the same in every occurrence within one id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a maximal run below the length has no match, and a longer one matches as a whole
        pattern = re.compile(f"[{LETTERS}]{{{shortest},}}")
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(pattern.findall(text.as_py().encode().lower().decode()))
                if misprint_every:
                    before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word in [w for w in found if zlib.crc32(w.encode(), before) % misprint_every == 0]:
                        at = zlib.crc32(word.encode(), before) % len(word)
                        if len(word) > shortest:
                            total[word[:at] + word[at + 1:]] += found[word]
                        del found[word]
                total.update(found)
                if len(total) > HELD_WORDS:
                    yield out()
                    total.clear()
        if total:
            yield out()

    parts = map_arrow(id_text(docs, id_column, text_column), run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class BitSlices:
    """The words of one block, as one integer of bits per (position, letter) and per length."""

    def __init__(self, words: list[str]):
        self.every = (1 << len(words)) - 1
        places: dict[tuple[int, str], list[int]] = {}
        lengths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            lengths.setdefault(len(word), []).append(i)
            for place in enumerate(word):
                places.setdefault(place, []).append(i)
        self.at = {place: self._bits(rows, len(words)) for place, rows in places.items()}
        self.of_length = {length: self._bits(rows, len(words)) for length, rows in lengths.items()}

    @staticmethod
    def _bits(rows: list[int], size: int) -> int:
        bits = bytearray(size // 8 + 1)
        for i in rows:
            bits[i >> 3] |= 1 << (i & 7)
        return int.from_bytes(bits, "little")

    def near(self, word: str, lengths: tuple[int, ...] | None = None, unlike_first: int = 0) -> int:
        """The bits of the words one code point away; only those of ``lengths``, and with ``unlike_first`` k only those
        whose first k letters differ from the word's."""
        at, m, zero = self.at, len(word), self.every
        replaced, more, less, alike = 0, zero, 0, 0
        for i, letter in enumerate(word):
            here = at.get((i, letter), 0)
            replaced = replaced & here | zero
            less = less & at.get((i - 1, letter), 0) | zero
            zero &= here
            more = more & at.get((i + 1, letter), 0) | zero
            if i + 1 == unlike_first:
                alike = zero
        of = self.of_length if lengths is None else {k: self.of_length.get(k, 0) for k in lengths}
        equal = zero & self.of_length.get(m, 0)
        return (replaced & of.get(m, 0) | more & of.get(m + 1, 0) | less & of.get(m - 1, 0)) & ~equal & ~alike


def _groups(counts: DataFrame, block: int) -> DataFrame:
    """(longest, last, part, salt, listed, word, n): every word in its groups; large groups in blocks by salt, where a word is listed
    in one block and asked in all of them."""
    length = F.char_length("word")
    both = counts.select("word", "n", F.explode(F.array(length, length + 1)).alias("longest"))
    half = F.expr("longest div 2")
    keyed = both.select("word", "n", "longest", F.explode(F.array(F.lit(False), F.lit(True))).alias("last")).select(
        "word", "n", "longest", "last", F.when(F.col("last"), F.expr("right(word, longest - longest div 2)")).otherwise(F.substring("word", F.lit(1), half)).alias("part"))
    sizes = stored(keyed.groupBy("longest", "last", "part").count().where(F.col("count") > 1), "word-groups")
    large = sizes.where(F.col("count") > block).select("longest", "last", "part", F.ceil(F.col("count") / block).alias("blocks"))
    # words that are alone in a group have no near word there
    keyed = keyed.join(sizes.select("longest", "last", "part"), ["longest", "last", "part"], "left_semi")
    keyed = keyed.join(small_or_shuffled(stored(large, "large-word-groups")), ["longest", "last", "part"], "left")
    blocks = F.coalesce("blocks", F.lit(1))
    spread = keyed.withColumn("own", F.pmod(F.xxhash64("word"), blocks)).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return spread.select("longest", "last", "part", "salt", (F.col("salt") == F.col("own")).alias("listed"), "word", "n")


def near_words(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, form, form_n) of all words of (word, n) that have near words: how many, and the most frequent
    one with its count. ``counts`` should be a stored table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, listed, slices, out = None, [], None, []

        def ask(word: str, longest: int, last: bool) -> None:
            lengths = (longest, longest - 1) if len(word) == longest else (longest,)
            bits = slices.near(word, lengths, longest // 2 if last else 0)
            if bits:
                n, form = listed[(bits & -bits).bit_length() - 1]
                out.append((word, bits.bit_count(), form, -n))

        def index() -> None:
            nonlocal slices
            if slices is None:
                listed.sort()
                slices = BitSlices([w for _, w in listed])
                for _, word in listed:
                    ask(word, key[0], key[1])

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int64(), pa.string(), pa.int64()])],
                                              ["word", "n_near", "form", "form_n"])

        for batch in batches:
            for *group, is_listed, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if group != key:
                    if key is not None:
                        index()
                    key, listed, slices = group, [], None
                # the listed words of a group come first
                if is_listed:
                    listed.append((-n, word))
                else:
                    index()
                    ask(word, key[0], key[1])
            yield batch_of()
            out = []
        if key is not None:
            index()
            yield batch_of()

    columns = ["longest", "last", "part", "salt"]
    groups = _groups(counts, block).repartition(*columns).sortWithinPartitions(*columns, F.desc("listed"))
    found = map_arrow(groups, run, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def variants(counts: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of (word, n). A form has at least ``ratio`` (above 1) times the count of
    its word; the root is the last of the forms that follow on each other."""
    counts = stored(counts.select("word", "n"), "word-counts")
    near = near_words(counts, block)
    has = F.col("form_n") >= ratio * F.col("n")
    marked = stored(counts.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n")), "word-forms")
    most = marked.agg(F.max("n")).first()[0] or 1
    # counts grow by the ratio with each form, so chains are short, and every round doubles what is followed
    longest = max(1, math.ceil(math.log(most, ratio)) + 1)
    roots = marked.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest)) + 1):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "word-roots")
    return marked.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
