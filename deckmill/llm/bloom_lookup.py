"""Document fingerprints that subtract: invertible Bloom lookup sketches of paragraph digests, with DataFrame functions only.

A paragraph is a line, or a run of PIECE characters of a longer line from its start. A sketch holds TABLES tables of
cells; each distinct paragraph digest goes to one cell of each table, which keeps the sum of count and digests, packed
into one long (KEY_BITS of the digest with a check sum in them, COUNT_BITS of count). Two sketches of one size subtract
cell by cell: what both hold is gone. A cell with a count of one in size and a fitting check sum names a digest of one side; taking it out of its other cells frees further
ones (peeling). If cells are left over, or what was recovered does not account for the exclusive or of both sides, the sketch failed: it is made
again, twice the size and with other key bits. After ATTEMPTS failures the two sets of the part are compared as they are.

Long texts are compared in parts by digest (PART and BUCKET digests on average), one sketch each, so that the work
grows with the text and not with its square. All of it is expressions on one row; no digest leaves its row.

``fingerprint`` is the text form of a sketch of CELLS cells per table over the whole text: equal texts have equal ones.

Edge cases: null texts are empty; empty texts have an empty sketch, and two of them are alike (1.0); repeated
paragraphs count once; rows that repeat an id and a text are one document in the order, and each gets the same result;
a null id comes first; a single document is its own next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.llm.common import small_or_shuffled, stored
from deckmill.operators import scale

PIECE = 200
TABLES = 3
CELLS = 8
PART, BUCKET = 512, 6
FIRST_CELLS = 5
ATTEMPTS = 7
ROUNDS = 8
KEY_BITS, CHECK_BITS, COUNT_BITS = 49, 17, 8


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of a text."""
    pieces = F.regexp_extract_all(text, F.lit(f"[^\\n]{{1,{PIECE}}}"), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _key(d: Column) -> Column:
    """KEY_BITS of a digest, the last CHECK_BITS of them a check sum of the others."""
    high = F.shiftrightunsigned(d, 64 - KEY_BITS + CHECK_BITS)
    return F.shiftleft(high, CHECK_BITS) + F.xxhash64(high).bitwiseAND(F.lit((1 << CHECK_BITS) - 1))


def _place(key: Column, cells: Column) -> list[Column]:
    """The cell of a key in each table."""
    h = F.xxhash64(key, cells)
    return [(F.pmod(F.shiftrightunsigned(h, 21 * t).bitwiseAND(F.lit(0x1FFFFF)), cells) + t * cells).cast("int").alias(f"c{t}") for t in range(TABLES)]


def _in_cell(e: Column, at: Column) -> Column:
    hit = e["c0"] == at
    for t in range(1, TABLES):
        hit = hit | (e[f"c{t}"] == at)
    return hit


def _elements(keys: Column, cells: Column, sign: int) -> Column:
    """What keys add to their cells: one long of the key above and a count of one below, with their sign."""
    return F.transform(keys, lambda k: F.struct(((F.shiftleft(k, COUNT_BITS) + 1) * sign).alias("v"), *_place(k, cells)))


def _sketch(elements: Column, cells: Column) -> Column:
    return _let(elements, lambda own: F.transform(F.sequence(F.lit(0), (TABLES * cells - 1).cast("int")), lambda at: F.aggregate(
        own, F.lit(0).cast("long"), lambda cell, e: F.when(_in_cell(e, at), cell + e["v"]).otherwise(cell))))


def _peel(sketch: Column, cells: Column) -> Column:
    """Struct of the cells left and the signed keys recovered; one round takes out all that can be read at once."""
    def pure(cell: Column) -> Column:
        size = F.abs(cell)
        key = F.shiftrightunsigned(size, COUNT_BITS)
        check = F.xxhash64(F.shiftrightunsigned(key, CHECK_BITS)).bitwiseAND(F.lit((1 << CHECK_BITS) - 1))
        return (size.bitwiseAND(F.lit((1 << COUNT_BITS) - 1)) == 1) & (key.bitwiseAND(F.lit((1 << CHECK_BITS) - 1)) == check)

    def read(cell: Column) -> Column:
        return F.struct(cell.alias("v"), *_place(F.shiftrightunsigned(F.abs(cell), COUNT_BITS), cells))

    def taken_out(state: Column, found: Column) -> Column:
        left = F.transform(state["cells"], lambda c, at: F.aggregate(
            found, c, lambda cell, e: F.when(_in_cell(e, at), cell - e["v"]).otherwise(cell)))
        return F.struct(left.alias("cells"), F.concat(state["found"], F.transform(found, lambda e: e["v"])).alias("found"), F.lit(True).alias("on"))

    def round_(state: Column, _: Column) -> Column:
        ended = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("on"))
        readable = F.transform(F.array_distinct(F.filter(state["cells"], pure)), read)
        go_on = _let(readable, lambda found: F.when(F.size(found) > 0, taken_out(state, found)).otherwise(ended))
        return F.when(state["on"], go_on).otherwise(state)

    start = F.struct(sketch.alias("cells"), F.array().cast("array<bigint>").alias("found"), F.lit(True).alias("on"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_)


def _exclusive_or(keys: Column) -> Column:
    return F.aggregate(keys, F.lit(0).cast("long"), lambda total, d: total.bitwiseXOR(d))


def _recovered(x: Column, y: Column) -> Column:
    """How many digests one of two small sets holds and the other does not, from the difference of their sketches.

    Each attempt takes other key bits of the digests and twice the size of the one before. It counts if nothing is left over
    and the recovered digests account for the exclusive or of both sets, so that two digests with the same key bits, which
    never peel on one side and cancel on two, are told apart by the next attempt. Where all attempts fail, the sets are compared."""
    def tried(cells: Column, salt: Column) -> Column:
        def keyed(digests: Column) -> Column:
            return F.transform(digests, lambda d: F.struct(d.alias("d"), _key(F.xxhash64(d, salt)).alias("k")))

        def elements(own: Column, sign: int) -> Column:
            return _elements(F.transform(own, lambda e: e["k"]), cells, sign)

        def accounted(own: Column, found: Column, sign: int) -> Column:
            return _exclusive_or(F.transform(F.filter(own, lambda e: F.array_contains(found, (F.shiftleft(e["k"], COUNT_BITS) + 1) * sign)), lambda e: e["d"]))

        def result(p: Column, q: Column, left: Column) -> Column:
            # a key read in error comes back with the other sign
            found = F.array_except(left["found"], F.transform(left["found"], lambda v: -v))
            return _let(found, lambda f: F.when(
                ~F.exists(left["cells"], lambda c: c != 0)
                & (accounted(p, f, 1).bitwiseXOR(accounted(q, f, -1)) == _exclusive_or(x).bitwiseXOR(_exclusive_or(y))), F.size(f)))

        return _let(keyed(x), lambda p: _let(keyed(y), lambda q: _let(
            _peel(_sketch(F.concat(elements(p, 1), elements(q, -1)), cells), cells), lambda left: result(p, q, left))))

    def attempt(state: Column, i: Column) -> Column:
        return F.when(state.isNotNull(), state).otherwise(_let(F.pow(F.lit(2), i).cast("int") * FIRST_CELLS, lambda cells: tried(cells, i)))

    peeled = F.aggregate(F.sequence(F.lit(0), F.lit(ATTEMPTS - 1)), F.lit(None).cast("int"), attempt)
    return _let(peeled, lambda n: F.when(n.isNotNull(), n).otherwise(F.size(F.array_except(x, y)) + F.size(F.array_except(y, x))))


def _split(x: Column, y: Column, parts: Column, of_part: Callable[[Column, Column], Column]) -> Column:
    """Sum of ``of_part`` over the parts of both sets by digest."""
    def own(keys: Column, p: Column, n: Column) -> Column:
        return F.when(n == 1, keys).otherwise(F.filter(keys, lambda d: F.pmod(d, n) == p))

    def summed(n: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda total, p: total + _let(own(x, p, n), lambda a: _let(own(y, p, n), lambda b: of_part(a, b))))
    return _let(parts, summed)


def likeness(x: Column, y: Column) -> Column:
    """Shared part of the paragraphs of two texts, by their digests: (|x| + |y| - d) / (|x| + |y| + d) for d differing ones."""
    def buckets(a: Column, b: Column) -> Column:
        n = F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) / BUCKET)).cast("int")
        # other digests, as those of one part agree in their remainder
        again = [F.transform(keys, lambda d: F.xxhash64(d)) for keys in (a, b)]
        return _let(again[0], lambda p: _let(again[1], lambda q: _split(p, q, n, _recovered)))

    both = F.size(x) + F.size(y)
    parts = F.greatest(F.lit(1), F.ceil(both / PART)).cast("int")
    differing = _split(x, y, parts, buckets)
    return F.when(both == 0, F.lit(1.0)).otherwise(_let(differing, lambda d: (both - d) / (both + d))).cast("double")


def fingerprint(keys: Column) -> Column:
    """Text form of the sketch of CELLS cells a table over all digests: count and exclusive or of each cell, in hexadecimal."""
    cells = F.lit(CELLS)
    elements = F.transform(keys, lambda d: F.struct(d.alias("d"), *_place(d, cells)))

    def cell(own: Column, at: Column) -> Column:
        return _let(F.filter(own, lambda e: _in_cell(e, at)), lambda inside: F.concat(
            F.lpad(F.lower(F.hex(F.size(inside))), 4, "0"),
            F.lpad(F.lower(F.hex(F.aggregate(inside, F.lit(0).cast("long"), lambda total, e: total.bitwiseXOR(e["d"])))), 16, "0")))
    return F.array_join(_let(elements, lambda own: F.transform(F.sequence(F.lit(0), F.lit(TABLES * CELLS - 1)), lambda at: cell(own, at))), "")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document, the
    edited text being the first half and then as much of the next document's start, in order of doc_id."""
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[text_column], F.lit("")).alias("text")) \
        .withColumn("h", F.xxhash64("text"))
    rows = stored(texts.select("doc_id", "h", F.length("text").cast("long").alias("n_chars")), "order")
    numbered = stored(scale.number_rows(rows.distinct(), ["doc_id", "h"], "seq", 0), "order")
    total = numbered.count()
    if not total:
        total = 1
    # whose edited text a document's start goes to, and how much of it
    goes = numbered.select(((F.col("seq") + 1) % total).alias("seq"), F.struct("doc_id", "h").alias("to"), F.floor(F.col("n_chars") / 2).alias("need"))
    order = stored(numbered.join(goes, "seq").select("doc_id", "h", "to", "need"), "order")
    sent = texts.alias("t").join(small_or_shuffled(order).alias("o"), F.col("t.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("t.h") == F.col("o.h"))) \
        .select(F.col("o.to.doc_id").alias("to_id"), F.col("o.to.h").alias("to_h"), F.substring("t.text", F.lit(1), F.col("o.need").cast("int")).alias("start"),
                digests(F.col("t.text")).alias("next_keys"))
    if rows.count() > total:  # rows that repeat id and text send one start
        sent = sent.dropDuplicates(["to_id", "to_h"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = texts.join(sent, texts["doc_id"].eqNullSafe(sent["to_id"]) & (texts["h"] == sent["to_h"])) \
        .select("doc_id", F.length("text").cast("long").alias("n_chars"), "next_keys", digests(F.col("text")).alias("keys"),
                F.concat(F.substring("text", F.lit(1), F.length("text") - half), "start").alias("edited")) \
        .select("doc_id", "n_chars", "next_keys", "keys", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("edited")).alias("edited_keys"))
    return edited.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("keys")).alias("fingerprint"), fingerprint(F.col("edited_keys")).alias("edited_fingerprint"),
                         likeness(F.col("keys"), F.col("edited_keys")).alias("near_edited"), likeness(F.col("keys"), F.col("next_keys")).alias("near_next"))
