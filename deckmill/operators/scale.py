"""Building blocks that keep grouping, joining and numbering spread out.

One key may own a third of all rows, so no operator sorts or collects a whole
group in one task:

* per-key facts come from ``groupBy`` (combined before the shuffle) and return
  to the rows through :func:`attach`, which takes hot keys out of the shuffle;
* global positions come from :func:`number_rows`, a range-partitioned sort;
* positions inside a group are differences of global positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deckmill.session import cut_lineage

# Keys with more rows than this leave the shuffle join. At most
# rows / HOT_ROWS such keys exist, so their table is always broadcastable.
HOT_ROWS = 1_000_000
# Small-set limit: tables checked to be below it become literals or broadcasts.
SMALL_ROWS = 20_000
_SPREAD = 8192


def attach(df: DataFrame, facts: DataFrame, keys: Sequence[str], size: str,
           spread_on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left-join per-key ``facts`` (unique keys) to the rows of ``df``.

    ``size`` names the column of ``facts`` with the number of ``df`` rows per key;
    ``spread_on`` names columns of ``df`` that tell rows of one key apart.
    Rows of hot keys meet their facts in a broadcast of the hot keys only and
    are scattered by a salt in the following join, where they match nothing;
    rows with a null key are scattered likewise and get null facts.
    """
    keys = list(keys)
    values = [c for c in facts.columns if c not in keys]
    packed = facts.select(*keys, F.struct(*values).alias("__fact"), F.col(size).alias("__size"))
    hot = packed.where(F.col("__size") > hot_rows).select(*keys, F.col("__fact").alias("__hot"))
    cold = packed.where(F.col("__size") <= hot_rows).select(
        *keys, F.col("__fact").alias("__cold"),
        # zero for every cold key, computed so that it stays a join key
        F.least(F.col("__size"), F.lit(0)).cast("int").alias("__salt"))
    stays = F.col("__hot").isNull()
    for key in keys:
        stays = stays & F.col(key).isNotNull()
    salt = F.when(stays, F.lit(0)).otherwise(
        F.lit(1) + F.pmod(F.xxhash64(*spread_on), F.lit(_SPREAD)).cast("int"))
    joined = (df.join(F.broadcast(hot), keys, "left")
              .withColumn("__salt", salt)
              .join(cold, [*keys, "__salt"], "left")
              .withColumn("__fact", F.coalesce("__hot", "__cold")))
    return joined.select(*df.columns, *[F.col(f"__fact.{v}").alias(v) for v in values])


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "seq", start: int = 1) -> DataFrame:
    """Consecutive numbers over a total order, without a one-task window.

    Rows are range-partitioned and sorted, and stored by a reliable checkpoint;
    a row's number is its place inside its partition plus the rows before the
    partition. The offsets table has one row per shuffle partition.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id()))
    part = F.shiftright("__place", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    local = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("__part", part)
            .join(F.broadcast(offsets), "__part")
            .withColumn(name, local + F.col("__before") + F.lit(start))
            .select(*df.columns, name))


def number_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                    name: str = "seq", id_columns: Sequence[str] = (), start: int = 1) -> DataFrame:
    """Consecutive numbers inside each group, safe for one huge group."""
    placed = number_rows(df, [*keys, *order], "__global", 0)
    first = placed.groupBy(*keys).agg(F.min("__global").alias("__first"), F.count("*").alias("__size"))
    spread = list(id_columns) or ["__global"]
    return (attach(placed, first, keys, "__size", spread)
            .withColumn(name, F.col("__global") - F.col("__first") + F.lit(start))
            .drop("__global", "__first", "__size"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One whole row per key, the least by ``order``; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], cap: int,
                spread_on: Sequence[str], salts: int = 64) -> DataFrame:
    """At most ``cap`` rows per key by ``order``: first per salted slice, then over the rest.

    A key reaches the last step with at most ``cap * salts`` rows, however many it had.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*spread_on), F.lit(salts)).cast("int"))
    slice_rank = F.row_number().over(Window.partitionBy(*keys, "__salt").orderBy(*order))
    kept = salted.withColumn("__rank", slice_rank).where(F.col("__rank") <= cap)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (kept.withColumn("__rank", rank).where(F.col("__rank") <= cap)
            .drop("__salt", "__rank"))


def first_rows(df: DataFrame, order: Sequence[Column | str], limit: int) -> DataFrame:
    """The first ``limit`` rows by ``order``; large limits are cut by position."""
    if limit <= SMALL_ROWS:
        return df.orderBy(*order).limit(limit)
    return number_rows(df, order, "__seq").where(F.col("__seq") <= limit).drop("__seq")


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows over all cores when the scan gave fewer partitions than there are cores.

    For plain scans. One small file is one task, however costly its rows are. A large scan has
    partitions enough and is left as it is, so no shuffle is added there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def gathered(files: DataFrame) -> DataFrame:
    """A scan of files in at most some tasks per core: a file counts as megabytes, so that millions of small ones make as
    many tasks as there are some dozens of them."""
    return files.coalesce(max(256, 16 * files.sparkSession.sparkContext.defaultParallelism))


def small_table(df: DataFrame, limit: int = SMALL_ROWS) -> list | None:
    """Rows of ``df`` when there are at most ``limit``, else None."""
    rows = df.take(limit + 1)
    return rows if len(rows) <= limit else None


def is_small(df: DataFrame, limit: int = SMALL_ROWS) -> bool:
    """Size check that reads a large table no further than its first partitions."""
    return len(df.select(F.lit(1)).take(limit + 1)) <= limit


def broadcast_if_small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Broadcast hint only after the size was checked."""
    return F.broadcast(df) if is_small(df, limit) else df


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing on one side are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
