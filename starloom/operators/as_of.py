"""The value that was valid at the time of an event, without comparing events with all versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.ranking import in_ranges


def as_of(
    events: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str, values: Sequence[str]
) -> DataFrame:
    """``events`` with the ``values`` of the last version of their ``key`` that began at or before ``at``.

    Events and versions are sorted together by (key, time) into ranges, and the last version seen is
    carried down each range. A key that fills several ranges, such as a customer with a third of all
    orders, gets its state at a range's start from one row per earlier range: the last version in it.
    Events without a version, key or time have NULL values. Versions of a key that begin together
    count in the order of their values.
    """
    both = [
        F.lit(None).cast(T.StructType(list(events.schema))).alias("_event"),
        F.struct(*values).alias("_value"),
        F.xxhash64(*values).alias("_tie"),
    ]
    begun = versions.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_time"), F.lit(0).alias("_kind"), *both
    )
    kind = begun.schema["_value"].dataType
    happened = events.select(
        F.when(F.col(at).isNotNull(), F.col(key)).alias("_key"), F.col(at).alias("_time"), F.lit(1).alias("_kind"),
        F.struct(*[F.col(c) for c in events.columns]).alias("_event"),
        F.lit(None).cast(kind).alias("_value"),
        F.xxhash64(*events.columns).alias("_tie"),
    )
    # The hash only keeps equal times apart, so that a range may end among them.
    order = [F.col(c) for c in ("_key", "_time", "_kind", "_tie")]
    ranges = in_ranges(happened.unionByName(begun), order, "as-of")
    seen = F.col("_value").isNotNull()
    ends = ranges.groupBy("_range").agg(
        F.max_by(F.when(seen, F.struct("_key", "_value")), F.when(seen, F.col("_row"))).alias("_end")
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    carried = ends.select("_range", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    so_far = Window.partitionBy("_range", "_key").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranges.withColumn("_value", F.last("_value", ignorenulls=True).over(so_far)).where("_kind = 1")
    value = F.coalesce("_value", F.when(F.col("_carried._key") == F.col("_key"), F.col("_carried._value")))
    return (
        inside.join(F.broadcast(carried), "_range")
        .withColumn("_value", value)
        .select("_event.*", *[F.col(f"_value.{v}").alias(v) for v in values])
    )
