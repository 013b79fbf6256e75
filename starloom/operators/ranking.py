"""Global numbering and running totals without a single-task window.

A window without PARTITION BY moves every row to one task. Here rows are range-partitioned on
the ordering columns, written once with their position inside the range, and the few per-range
totals turn local positions into global ones. One hot value does not fill one range as long as
the ordering columns end in a tie-break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialise

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above 33 row bits


def in_ranges(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Sorted ranges with ``_range`` and ``_row`` (zero-based), fixed by writing them."""
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_at", _POSITION_BITS))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_at")
    )
    return materialise(placed, label)


def _offsets(ranges: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Per range: what precedes it (``_before_x``) and the whole (``_all_x``) of each measure.

    One row per range, so the window and the broadcast are bounded by the partition count.
    """
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_range = ranges.groupBy("_range").agg(*[total.alias(name) for name, total in sums.items()])
    return per_range.select(
        "_range",
        *[F.sum(name).over(before).alias(f"_before_{name}") for name in sums],
        *[F.sum(name).over(whole).alias(f"_all_{name}") for name in sums],
    )


def dense_index(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Number rows 1..n in the given total order."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    ranges = in_ranges(df, columns, "index")
    offsets = _offsets(ranges, {"rows": F.count(F.lit(1))})
    index = F.coalesce(F.col("_before_rows"), F.lit(0)) + F.col("_row") + 1
    return (
        ranges.join(F.broadcast(offsets), "_range")
        .withColumn(name, index)
        .select(*df.columns, name)
    )


def running_total(
    df: DataFrame, order: Sequence[Column], value: str, rank: str, running: str, total: str
) -> DataFrame:
    """Add the position, the running sum and the grand total of ``value`` in the given order."""
    ranges = in_ranges(df, order, "running")
    offsets = _offsets(ranges, {"rows": F.count(F.lit(1)), "sum": F.sum(value)})
    so_far = Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kind = ranges.agg(F.sum(value)).schema[0].dataType
    zero = F.lit(0).cast(kind)
    return (
        ranges.withColumn("_local", F.sum(value).over(so_far))
        .join(F.broadcast(offsets), "_range")
        .select(
            *df.columns,
            (F.coalesce(F.col("_before_rows"), F.lit(0)) + F.col("_row") + 1).alias(rank),
            (F.coalesce(F.col("_before_sum").cast(kind), zero) + F.coalesce(F.col("_local"), zero)).cast(kind).alias(running),
            F.col("_all_sum").cast(kind).alias(total),
        )
    )


def index_in_group(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows of each group 1..n in the given order, however much of the table one group holds.

    Groups are laid out one after the other in sorted ranges. A group that goes on in another range is the
    last one of the range it begins in, so the true starts of such groups are at most one row per range.
    ``order`` must be total within a group; rows with a NULL group form a group of their own.
    """
    ranges = in_ranges(df, [F.col(group), *order], "group-index")
    offsets = _offsets(ranges, {"rows": F.count(F.lit(1))})
    at = (F.coalesce(F.col("_before_rows"), F.lit(0)) + F.col("_row")).alias("_at")
    placed = ranges.join(F.broadcast(offsets.select("_range", "_before_rows")), "_range").select(*df.columns, "_range", at)
    here = Window.partitionBy("_range", group)
    local = placed.withColumn("_start", F.min("_at").over(here))
    ends = placed.groupBy("_range", group).agg(F.min("_at").alias("_start"), F.max("_at").alias("_end"))
    last = ends.groupBy("_range").agg(F.max_by(F.struct(F.col(group).alias("group"), "_start"), "_end").alias("_last"))
    begun = last.groupBy(F.col("_last.group").alias("_group")).agg(F.min("_last._start").alias("_begun"))
    first = F.least(F.coalesce("_begun", "_start"), F.col("_start"))
    return (
        local.join(F.broadcast(begun), F.col(group).eqNullSafe(F.col("_group")), "left")
        .select(*df.columns, (F.col("_at") - first + 1).alias(name))
    )
