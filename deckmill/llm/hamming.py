"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures, confirmed on full shingle sets.

A signature has CHUNKS chunks of CHUNK symbols of SYMBOL_BITS bits. Two signatures that differ in at most
``CHUNKS * (ERRORS + 1) - 1`` symbols have a chunk with at most ERRORS errors (pigeonhole). Each chunk is therefore
indexed once for every set of ERRORS positions left out, and two chunks with at most ERRORS errors share one of these keys.
Every pair under that distance is a candidate; so is a pair beyond it that shares a key, up to VERIFY_SYMBOLS
differences. Candidates are compared on their whole sets.

With 72 symbols of 8 bits in 12 chunks and one error the guarantee holds up to 23 differences. A pair at similarity 0.75
differs in 18 symbols on average and shares no key with probability 0.0001; it differs in more than 40 with
probability below 1e-7.

No group becomes all its pairs:

1. Documents of one shingle set are one node.
2. Members of a key are tied to its least node where their signatures are near; the components are families. The hub of
   a family is the member nearest to its most frequent chunk values, which is the original of many copies. Every member is
   compared with the hub on full sets, and linked to it or left over.
3. A left-over member u can be linked with another one v of the family only if they share a shingle that the hub lacks,
   or if the part of the hub that both could share, min(|u & hub|, |v & hub|), reaches the overlap that the similarity
   asks for. Only such pairs are compared, and those that share a key across families.

Edge cases: null or blank texts have no shingle, link with nothing and are kept; a text of fewer than five words is one
shingle, its whole sequence; rows that repeat an id are linked with whatever any text of the id is linked with; rows
without an id never stand for others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.llm.common import as_bytes, id_text, map_arrow, small_or_shuffled, stored, text_chunks
from deckmill.llm.components import components
from deckmill.operators import scale

SHINGLE = 5
CHUNKS, CHUNK, ERRORS = 12, 6, 1
SYMBOLS = CHUNKS * CHUNK
VERIFY_SYMBOLS = 40
CACHED_WORDS = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[bytes], words: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): hashes of every shingle of every text, one text after the other, repeats included."""
    split = [t.lower().split() for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    hashes = np.fromiter((h for s in split for h in map(words.__getitem__, s)), np.uint64, int(sizes.sum()))
    run = np.zeros(max(0, len(hashes)), np.uint64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    length = len(hashes) - SHINGLE + 1
    if length > 0:
        run[:length] = hashes[:length]
        for k in range(1, SHINGLE):
            run[:length] = mix64(run[:length] * MIX + hashes[k:length + k])
    inside = np.ones(len(hashes), bool)
    last = np.minimum(sizes, SHINGLE - 1)
    tail = np.repeat(ends - last, last) + np.arange(int(last.sum())) - np.repeat(np.cumsum(last) - last, last)
    inside[tail] = False
    for i in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)):  # the whole sequence is one shingle
        value = np.uint64(sizes[i])
        with np.errstate(over="ignore"):
            for h in hashes[starts[i]:ends[i]]:
                value = mix64(np.array([value * MIX + h]))[0]
        run[starts[i]], inside[starts[i]] = value, True
    counts = np.where(sizes == 0, 0, np.maximum(sizes - SHINGLE + 1, 1))
    return run[inside], np.cumsum(counts)


def signatures(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows of SYMBOLS bytes for the non-empty ranges of ``hashes``; the rest are zero."""
    out = np.zeros((len(ends), SYMBOLS), np.uint8)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    full = np.flatnonzero(ends > starts)
    if len(full):
        low = (hashes >> np.uint64(16)).astype(np.uint32)
        rng = np.random.default_rng(20_221)
        work = np.empty_like(low)
        for k in range(SYMBOLS):
            flip, factor = (np.uint32(v) for v in rng.integers(0, 1 << 32, 2))
            np.bitwise_xor(low, flip, out=work)
            np.multiply(work, factor | np.uint32(1), out=work)
            np.bitwise_xor(work, work >> np.uint32(15), out=work)
            np.multiply(work, np.uint32(0x2C1B3C6D), out=work)
            least = np.minimum.reduceat(work, starts[full])
            out[full, k] = ((least * np.uint32(0x297A2D39)) >> np.uint32(24)).astype(np.uint8)
    return out


def sign(texts: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, chunks): size and digest of the set, and the signature, CHUNK bytes a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        for batch in batches:
            raw = as_bytes(batch.column(1))
            for some in text_chunks(raw, 1_000_000):
                hashes, ends = shingles(raw[some], words)
                marks = signatures(hashes, ends)
                wide = np.zeros((len(ends), CHUNKS, 8), np.uint8)
                wide[:, :, :CHUNK] = marks.reshape(len(ends), CHUNKS, CHUNK)
                chunks = wide.reshape(len(ends), -1).view("<i8")
                sizes, digests = np.zeros(len(ends), np.int64), np.zeros((len(ends), 2), np.uint64)
                start = 0
                for i, end in enumerate(ends):
                    own = np.unique(hashes[start:end])
                    sizes[i], start = len(own), end
                    digests[i] = own.sum(), mix64(own).sum()
                digests = digests.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[some.start:some.stop], pa.array(sizes), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                     pa.FixedSizeListArray.from_arrays(pa.array(chunks.reshape(-1)), CHUNKS).cast(pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_a", "set_b", "chunks"])

    return map_arrow(texts, run, "doc_id long, n_shingles long, set_a long, set_b long, chunks array<long>")


def full_sets(texts: DataFrame) -> DataFrame:
    """(node, shingles) with the distinct shingle hashes of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        for batch in batches:
            raw = as_bytes(batch.column(1))
            for some in text_chunks(raw):
                hashes, ends = shingles(raw[some], words)
                own = [np.unique(h).view(np.int64) for h in np.split(hashes, ends[:-1])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[some.start:some.stop], pa.array(own, pa.list_(pa.int64()))], ["node", "shingles"])

    return map_arrow(texts, run, "node long, shingles array<long>")


def _keys(chunks: Column) -> Column:
    """One key for each chunk and each position left out of it."""
    keep = [~(0xFF << 8 * p) & ((1 << 8 * CHUNK) - 1) for p in range(CHUNK)]
    return F.array(*[F.xxhash64(F.lit(c * CHUNK + p), F.element_at(chunks, c + 1).bitwiseAND(F.lit(keep[p]))) for c in range(CHUNKS) for p in range(CHUNK)])


def _differences(a: Column, b: Column) -> Column:
    """Number of symbols in which two signatures differ: non-zero bytes of their exclusive or. Adding 127 to the low seven bits
    of a byte carries into its highest bit unless they are zero; the exclusive or stands there twice, as plans that repeat it
    more often fill the driver."""
    low, high = (sum(bits << 8 * p for p in range(CHUNK)) for bits in (0x7F, 0x80))
    total = F.lit(0)
    for c in range(1, CHUNKS + 1):
        x = F.element_at(a, c).bitwiseXOR(F.element_at(b, c))
        total = total + F.bit_count((x.bitwiseAND(F.lit(low)) + F.lit(low)).bitwiseOR(x).bitwiseAND(F.lit(high)))
    return total


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) whose sets reach the similarity."""
    joined = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"))
    both = F.size(F.array_intersect("sa", "sb"))
    return joined.where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b").distinct()


def _hubs(placed: DataFrame) -> DataFrame:
    """(family, hub) of (node, family, chunks): the member nearest to the most frequent value of each chunk."""
    values = placed.select("family", F.posexplode("chunks").alias("at", "value")).groupBy("family", "at", "value").agg(F.count("*").alias("n"))
    usual = values.groupBy("family", "at").agg(F.max(F.struct("n", "value"))["value"].alias("value")) \
        .groupBy("family").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda c: c["value"]).alias("usual"))
    return placed.join(usual, "family").groupBy("family").agg(F.min(F.struct(_differences(F.col("chunks"), F.col("usual")).alias("d"), "node"))["node"].alias("hub"))


def _possible(members: DataFrame, keys: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different parts that may be linked: members are (node, family, part, hub, n, inside, own, chunks),
    keys (key, node, family)."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{c}_{name}") for c in df.columns])

    near = _differences(F.col("chunks_u"), F.col("chunks_v")) <= VERIFY_SYMBOLS
    apart = (F.col("part_u") != F.col("part_v")) & near
    facts = members.select("node", "family", "part", "n", "inside", "chunks")
    loose = members.where("part <> hub")
    left = side(loose.select(facts.columns), "u")
    # what they share of the hub may do
    enough = (100 + percent) * F.least("inside_u", "inside_v") >= percent * (F.col("n_u") + F.col("n_v"))
    of_hub = left.join(side(facts, "v"), (F.col("family_u") == F.col("family_v")) & enough & apart)
    # or they share something else
    others = side(loose.select(*facts.columns, F.explode("own").alias("shingle")), "u")
    own = side(members.select(*facts.columns, F.explode("own").alias("shingle")), "v")
    of_own = others.join(own, (F.col("family_u") == F.col("family_v")) & (F.col("shingle_u") == F.col("shingle_v")) & apart)
    # or only a key
    split = keys.groupBy("key").agg(F.min("family").alias("p"), F.max("family").alias("q")).where("p <> q").select("key")
    across = keys.join(split, "key").join(members.select("node", "chunks"), "node")
    of_key = side(across, "u").join(side(across, "v"), (F.col("key_u") == F.col("key_v")) & (F.col("family_u") < F.col("family_v")) & near)
    return scale.union_all([p.select(F.least("node_u", "node_v").alias("a"), F.greatest("node_u", "node_v").alias("b")) for p in (of_hub, of_own, of_key)]) \
        .where("a <> b").distinct()


def near_duplicates(docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    texts = id_text(docs, id_column, text_column)
    signed = stored(sign(texts), "signatures")
    # one node for each shingle set: its least id
    classes = signed.where("n_shingles > 0").groupBy("n_shingles", "set_a", "set_b").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("rows"), F.first("chunks").alias("chunks"))
    nodes = stored(classes.where("node IS NOT NULL"), "nodes")
    marks = nodes.select("node", "chunks")
    keyed = nodes.select("node", F.explode(_keys(F.col("chunks"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most")
    keys = stored(keyed.join(shared, "key").select("key", "node", "least"), "keys")
    stars = keys.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct() \
        .join(marks.select(F.col("node").alias("a"), F.col("chunks").alias("ca")), "a").join(marks.select(F.col("node").alias("b"), F.col("chunks").alias("cb")), "b") \
        .where(_differences(F.col("ca"), F.col("cb")) <= VERIFY_SYMBOLS).select("a", "b")
    families = stored(components(stars), "families")
    wanted = stored(keys.select("node").distinct(), "wanted")
    sets = stored(full_sets(texts.join(small_or_shuffled(wanted), texts["doc_id"] == wanted["node"], "left_semi")), "sets")
    placed = stored(wanted.join(families, "node", "left").join(marks, "node")
                    .select("node", F.coalesce("component", "node").alias("family"), "chunks"), "placed")
    hubs = placed.join(_hubs(placed), "family").select("node", "family", "hub", "chunks")
    joined = hubs.join(sets.select("node", F.col("shingles").alias("sn")), "node").join(sets.select(F.col("node").alias("hub"), F.col("shingles").alias("sh")), "hub")
    inside = F.size(F.array_intersect("sn", "sh"))
    linked = 100 * inside >= percent * (F.size("sn") + F.size("sh") - inside)
    members = stored(joined.select("node", "family", "hub", "chunks", F.size("sn").alias("n"), inside.alias("inside"),
                                   F.when(linked, F.col("hub")).otherwise(F.col("node")).alias("part"), F.array_except("sn", "sh").alias("own")), "family-members")
    pairs = stored(_possible(members, keys.join(placed.select("node", "family"), "node"), percent), "pairs")
    # parts joined by confirmed pairs, named by their least node
    part_of = members.select("node", "part")
    links = _confirmed(pairs, sets, percent).join(part_of.select(F.col("node").alias("a"), F.col("part").alias("pa")), "a") \
        .join(part_of.select(F.col("node").alias("b"), F.col("part").alias("pb")), "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
    wholes = part_of.join(components(links).withColumnRenamed("node", "part"), "part", "left").select("node", F.coalesce("component", "part").alias("whole"))
    least = wholes.groupBy("whole").agg(F.min("node").alias("component"))
    named = nodes.join(wholes.join(least, "whole").select("node", "component"), "node", "left").select(
        "n_shingles", "set_a", "set_b", "rows", F.coalesce("component", "node").alias("component_id"))
    class_of = ["n_shingles", "set_a", "set_b"]
    out = scale.attach(signed.select("doc_id", *class_of), named, class_of, "rows", ["doc_id"]) \
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: those of its least id, and once where rows repeat id and text.
    Rows without an id stay."""
    found = near_duplicates(docs, percent, id_column, text_column)
    gone = stored(found.where("NOT kept").select("doc_id").distinct(), "duplicates")
    left = docs.join(small_or_shuffled(gone), docs[id_column].cast("long") == gone["doc_id"], "left_anti")
    repeated = stored(found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not repeated.take(1):
        return left
    # only rows whose id repeats go through a shuffle
    again = left.join(small_or_shuffled(repeated), left[id_column].cast("long") == repeated["doc_id"], "left_semi")
    once = left.join(small_or_shuffled(repeated), left[id_column].cast("long") == repeated["doc_id"], "left_anti")
    return once.unionAll(again.dropDuplicates([id_column, text_column]))
