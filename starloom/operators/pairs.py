"""Counting items that occur together, without listing the pairs of huge baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import small_or_plain
from starloom.session import materialise

_MASK_BITS = 62
BLOCK = 256


def co_occurrence(baskets: DataFrame, basket: str, item: str, min_support: int) -> DataFrame:
    """Item pairs (``item_a`` < ``item_b``) sharing at least ``min_support`` baskets, with ``pairs``.

    ``baskets`` holds distinct (basket, item) rows. Exact, in four steps:

    * an item in fewer than ``min_support`` baskets can be in no result and is dropped;
    * the ``min_support - 1`` widest baskets (62 at most) are set aside. They alone cannot lift a pair to
      the threshold, so every result pair also shares a basket among the rest, and joining the
      rest with itself finds all of them;
    * the items of a basket are split into blocks of about ``BLOCK``, and a task joins one pair of
      blocks, never a whole basket; each pair of blocks meets once;
    * for the pairs found, the wide baskets are counted by giving each item a bit mask of the
      wide baskets it is in: the bits two masks share are the wide baskets the pair shares.

    A basket holding a large part of all rows thus costs one mask bit per item instead of a
    number of pairs that grows with its square.
    """
    written = materialise(baskets.select(basket, item), "baskets")
    frequent = written.groupBy(item).count().where(F.col("count") >= min_support).select(item)
    kept = written.join(small_or_plain(frequent), item, "left_semi")

    spare = min(min_support - 1, _MASK_BITS)
    wide = [
        row[0]
        for row in kept.groupBy(basket).count().orderBy(F.desc("count"), F.asc(basket)).limit(spare).collect()
    ] if spare > 0 else []
    is_wide = F.col(basket).isin(wide)

    rest = kept.where(~is_wide)
    widths = rest.groupBy(basket).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int")
    placed = rest.join(widths, basket).withColumn("_own", own)
    # Blocks i <= j only: a pair is listed once, and put in order afterwards.
    later, earlier = F.sequence(F.col("_own"), F.col("_blocks") - 1), F.sequence(F.lit(0), F.col("_own"))
    left = placed.select(basket, F.col("_own").alias("_i"), F.explode(later).alias("_j"), F.col(item).alias("_left"))
    right = placed.select(basket, F.explode(earlier).alias("_i"), F.col("_own").alias("_j"), F.col(item).alias("_right"))
    found = (
        left.join(right, [basket, "_i", "_j"])
        .where((F.col("_i") < F.col("_j")) | (F.col("_left") < F.col("_right")))
        .groupBy(F.least("_left", "_right").alias("item_a"), F.greatest("_left", "_right").alias("item_b"))
        .agg(F.count(F.lit(1)).alias("_rest"))
    )
    if not wide:
        return found.where(F.col("_rest") >= min_support).withColumnRenamed("_rest", "pairs")

    bit = F.lit(0).cast("bigint")
    for position, member in enumerate(wide):
        bit = F.when(F.col(basket) == F.lit(member), F.lit(1 << position).cast("bigint")).otherwise(bit)
    masks = kept.where(is_wide).groupBy(item).agg(F.bit_or(bit).alias("mask"))
    mask_a = masks.select(F.col(item).alias("item_a"), F.col("mask").alias("_mask_a"))
    mask_b = masks.select(F.col(item).alias("item_b"), F.col("mask").alias("_mask_b"))
    shared = F.bit_count(F.col("_mask_a").bitwiseAND(F.col("_mask_b")))
    total = F.col("_rest") + F.coalesce(shared, F.lit(0))
    return (
        found.join(mask_a, "item_a", "left")
        .join(mask_b, "item_b", "left")
        .select("item_a", "item_b", total.alias("pairs"))
        .where(F.col("pairs") >= min_support)
    )
