"""Splitting whole amounts among parts so that the parts add up exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.joins import small_or_plain
from starloom.operators.ranking import index_in_group

#: Rows of a group that one task sorts at most; wider groups are numbered across ranges.
GROUP_ROWS = 50_000


def wide_groups(rows: DataFrame, group: str, most: int | None = None) -> DataFrame:
    """The values of ``group`` with more than ``most`` rows, written: few, whatever the table. This runs a job."""
    sizes = rows.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    return small_or_plain(sizes.where(F.col("_size") > (GROUP_ROWS if most is None else most)).select(group))


def allocate(
    parts: DataFrame, group: str, part: str, share: str, units: str, name: str, wide: DataFrame | None = None
) -> DataFrame:
    """Add ``name``: the whole units of its group that fall to each part, by largest remainder.

    ``share`` and ``units`` are 64-bit integers; ``units`` is the same in all rows of a group and ``part``
    is unique in it. Every part gets its proportional units rounded towards zero; the units left go one
    each to the largest remainders, ties to the higher part. All of it is integer arithmetic, so the
    parts of a group add up to its units. A missing or negative share counts as zero; where all shares
    of a group are zero it is split evenly. Negative units are split like positive ones; missing units
    give NULL. Rows without a group belong to no amount and are left out.

    Groups are dealt to tasks whole and split there, in one shuffle. Those of ``wide`` (:func:`wide_groups` of
    ``parts`` or of rows that are no fewer, sought here if not given) are summed before they are joined and
    numbered across ranges, so none has to fit a task.
    """
    kept = parts.where(F.col(group).isNotNull()).withColumn("_split_share", F.greatest(F.coalesce(share, F.lit(0)), F.lit(0)))
    wide = wide_groups(kept, group) if wide is None else wide
    if wide.isEmpty():
        return _in_tasks(kept, group, part, units).select(*parts.columns, _amount(units).alias(name))
    within = _in_tasks(kept.join(wide, group, "left_anti"), group, part, units)
    across = _across_ranges(kept.join(wide, group, "left_semi"), group, part, units)
    return within.unionByName(across).select(*parts.columns, _amount(units).alias(name))


def _floors(parts: DataFrame, units: str) -> DataFrame:
    """The proportional units and what rounding leaves, from the sums of the group."""
    even = F.col("_split_sum") == 0
    weight = F.when(even, F.lit(1)).otherwise(F.col("_split_share")).cast("decimal(19,0)")
    total = F.when(even, F.col("_split_parts").cast("decimal(29,0)")).otherwise(F.col("_split_sum"))
    wanted = F.abs(F.col(units).cast("decimal(19,0)")) * F.col("_split_weight")
    return (
        parts.withColumns({"_split_weight": weight, "_split_total": total})
        .withColumn("_split_wanted", wanted)
        .withColumn("_split_whole", F.call_function("div", "_split_wanted", "_split_total"))
        .withColumn("_split_rest", F.col("_split_wanted") - F.col("_split_whole").cast("decimal(19,0)") * F.col("_split_total"))
        .drop("_split_share", "_split_sum", "_split_parts", "_split_weight", "_split_total", "_split_wanted")
    )


def _amount(units: str) -> Column:
    more = F.when(F.col("_split_place") <= F.abs(F.col(units)) - F.col("_split_given"), F.lit(1)).otherwise(F.lit(0))
    return F.signum(units).cast("bigint") * (F.col("_split_whole") + more)


def _in_tasks(kept: DataFrame, group: str, part: str, units: str) -> DataFrame:
    """Proportional units, place and what the group has given away, each group in one task."""
    whole = Window.partitionBy(group)
    sums = {
        "_split_sum": F.sum(F.col("_split_share").cast("decimal(19,0)")).over(whole),
        "_split_parts": F.count(F.lit(1)).over(whole),
    }
    floors = _floors(kept.withColumns(sums), units)
    place = F.row_number().over(whole.orderBy(F.desc("_split_rest"), F.desc(part)))
    return floors.withColumns({"_split_given": F.sum("_split_whole").over(whole), "_split_place": place.cast("bigint")}).drop("_split_rest")


def _across_ranges(kept: DataFrame, group: str, part: str, units: str) -> DataFrame:
    """The same for groups of any size."""
    totals = kept.groupBy(group).agg(
        F.sum(F.col("_split_share").cast("decimal(19,0)")).alias("_split_sum"), F.count(F.lit(1)).alias("_split_parts")
    )
    floors = _floors(kept.join(totals, group), units)
    placed = index_in_group(floors, group, [F.desc("_split_rest"), F.desc(part)], "_split_place").drop("_split_rest")
    return placed.join(placed.groupBy(group).agg(F.sum("_split_whole").alias("_split_given")), group)
