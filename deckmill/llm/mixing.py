"""Mixing sources to target weights by hash thresholds, with DataFrame functions only.

Every source has a target number of words. A document is taken whole, ``floor(target / source size)`` times, and once
more if its hash lies below a threshold of its source, so that the words of the extra round come near what is left of
the target. The threshold comes from nested histograms: sum words by source and the next DIGIT_BITS bits of the hash, find
the bucket in which the running sum passes what is left, and refine that bucket only. No level sorts documents, and the
last one filters by a comparison.

Edge cases: null texts have no words; the null source is a source of its own, last in order; a source without words has
target 0 and takes nothing; rows that repeat id and text have one hash and are taken alike; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deckmill.llm.common import BROADCAST_ROWS, WORD, stored
from deckmill.operators import scale

DIGIT_BITS = 15
LEVELS = 4  # 60 bits of hash


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of an MD5 digest of id and text, so that any engine can repeat the draw."""
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], most_copies: float) -> DataFrame:
    """The rows of ``sizes`` (source, source_size, ...) with ``target``: shares of the total by weight, at most ``most_copies`` times
    the size, with the excess shared again by weight.

    With caps c and weights w that is min(c, level * w) for one level. In order of c / w, the first sources are at their
    cap, so the level is the rest of the total over the rest of the weight at the first place where it is below c / w.
    One row per source passes these windows, not one per document.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int"))
    caps = sizes.withColumn("__w", cycle).withColumn("__c", F.col("source_size") * F.lit(float(most_copies)))
    order = [F.col("__c") / F.col("__w"), F.col("source").asc_nulls_last()]
    from_here = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("__c").over(earlier), F.lit(0.0))
    levels = caps.withColumn("__level", rest / F.sum("__w").over(from_here))
    level = F.min(F.when(F.col("__level") * F.col("__w") <= F.col("__c"), F.struct(order[0].alias("__r"), F.col("__level")))).over(everything)
    return levels.withColumn("__at", level["__level"]).select(
        *sizes.columns, F.coalesce(F.least("__c", F.col("__at") * F.col("__w")), F.lit(0.0)).alias("target"))


def _attach(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts per ``skey`` to the rows: by a broadcast of a counted table, else by a join that spreads hot sources."""
    if facts.count() <= BROADCAST_ROWS // 10:
        return rows.join(F.broadcast(facts), "skey", "left")
    return scale.attach(rows, facts, ["skey"], "rows", ["hash"])


def _refine(sized: DataFrame, plan: DataFrame, level: int) -> DataFrame:
    """The plan with the boundary bucket of each source cut down to one of 2 ** DIGIT_BITS smaller ones.

    Hashes below ``low`` are in, with ``within`` words; the boundary bucket starts at ``low``, with ``over`` words up to
    its end. Where all words of a source fit, ``low`` lies after every hash.
    """
    width = 60 - DIGIT_BITS * level
    step = width - DIGIT_BITS
    inside = _attach(sized, plan.select("skey", "rows", "low")).where(F.shiftright("hash", width) == F.shiftright("low", width))
    words = inside.groupBy("skey", F.shiftright("hash", step).alias("digit")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("skey").orderBy("digit")  # at most 2 ** DIGIT_BITS rows of a source
    summed = words.join(plan.select("skey", "left", F.col("within").alias("base")), "skey") \
        .withColumn("sum", F.col("base") + F.sum("words").over(running))
    bound = summed.where(F.col("sum") > F.col("left")).groupBy("skey").agg(
        F.min(F.struct("digit", (F.col("sum") - F.col("words")).alias("within"), "sum")).alias("b"))
    kept = [c for c in plan.columns if c not in ("low", "within", "over")]
    no_bound = F.lit(1 << 60) if level == 0 else F.col("low")
    return stored(plan.join(bound, "skey", "left").select(
        *kept, F.coalesce(F.shiftleft("b.digit", step), no_bound).alias("low"), F.coalesce("b.within", "within").alias("within"),
        F.coalesce("b.sum", "over").alias("over")), "mix-plan")


def _keyed(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """Every row as a struct beside the key of its source, its hash and its size."""
    source = docs[source_column].cast("string")
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), source.alias("source"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("skey"), docs[id_column].cast("long").alias("doc_id"),
        hash60(docs[id_column], docs[text_column]).alias("hash"), word_count(docs[text_column]).alias("size"))


def thresholds(sized: DataFrame, weights: Sequence[float], most_copies: float) -> DataFrame:
    """(skey, rows, source_size, target, whole, below) per source of a stored (skey, source, hash, size) table."""
    per_source = sized.groupBy("skey", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = source_targets(per_source, weights, most_copies)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = stored(targets.withColumn("whole", whole).withColumns({
        "left": F.col("target") - F.col("whole") * F.col("source_size"),
        "low": F.lit(0).cast("long"), "within": F.lit(0).cast("long"), "over": F.lit(None).cast("long")}), "mix-plan")
    for level in range(LEVELS):
        plan = _refine(sized, plan, level)
    # the last bucket holds rows of one hash; it goes in where that brings the source nearer to its target
    nearer = F.coalesce(F.col("over") - F.col("left") < F.col("left") - F.col("within"), F.lit(False))
    return stored(plan.select("skey", "rows", "source_size", "target", "whole", (F.col("low") + nearer.cast("long")).alias("below")), "mix-plan")


def _copies() -> Column:
    return F.expr("whole + CAST(hash < below AS BIGINT)")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most_copies: float = 3.0, id_column: str = "doc_id",
        text_column: str = "text", source_column: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every row; ``taken`` = ``copies`` * ``size``."""
    sized = stored(_keyed(docs, id_column, text_column, source_column).drop("row"), "mix-sizes")
    return _attach(sized, thresholds(sized, weights, most_copies)).withColumn("copies", _copies()).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most_copies: float = 3.0, id_column: str = "doc_id",
          text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it, with their columns. Texts are not
    shuffled: the thresholds go to them."""
    rows = _keyed(docs, id_column, text_column, source_column)
    sized = stored(rows.drop("row"), "mix-sizes")
    taken = _attach(rows.drop("size", "source"), thresholds(sized, weights, most_copies)).withColumn("copies", _copies()).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
