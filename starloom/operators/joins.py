"""Join helpers that keep size and skew in check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise

SMALL_ROWS = 10_000


def small_or_plain(dimension: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Write a dimension once and mark it for broadcast if it has at most ``max_rows`` rows.

    Used for vocabularies (statuses, categories) whose size estimate is that of the big table
    they were distilled from. This runs a job when the plan is made. Either way the plan goes on
    from the written rows; above the bound the optimizer chooses the join from their true size.
    """
    written = materialise(dimension, "vocabulary")
    return F.broadcast(written) if written.count() <= max_rows else written


def absent(facts: DataFrame, dimension: DataFrame, column: str) -> tuple[DataFrame, bool]:
    """The values of ``column`` that the dimension lacks, written, and whether they are few, as in sound data.

    Runs a job when the plan is made.
    """
    values = facts.select(column).where(F.col(column).isNotNull()).distinct()
    written = materialise(values.join(dimension.select(column).hint("merge"), column, "left_anti"), "absent")
    return written, written.count() <= SMALL_ROWS


def members(facts: DataFrame, dimension: DataFrame, column: str, used: DataFrame | None = None) -> DataFrame:
    """The facts whose ``column`` the dimension has, as a left semi join gives them, without moving wide facts.

    The values the dimension lacks are found among the distinct ones and written; they are few in sound data,
    and an anti join with a broadcast of them leaves every fact where it is. Above :data:`SMALL_ROWS` the
    optimizer chooses that join. ``used``: a narrower table with all values of the column.
    """
    missing, few = absent(facts if used is None else used, dimension, column)
    return facts.where(F.col(column).isNotNull()).join(F.broadcast(missing) if few else missing, column, "left_anti")


def left_key_lookup(facts: DataFrame, dimension: DataFrame, column: str, key: str, spread: str) -> DataFrame:
    """Add ``key``: the fact's ``column`` where the dimension knows it, else NULL.

    Rows without a value never match, but a plain left join would hash all of them to one
    task. They get the hash of the unique column ``spread`` as a salt, which keeps them apart;
    known values have salt 0, the only salt of the dimension. That zero is computed from the
    key: as a literal the optimizer would move it out of the join keys, and out of the hash.
    """
    salt = F.when(F.col(column).isNull(), F.xxhash64(spread)).otherwise(F.lit(0))
    known = dimension.select(
        F.col(key).alias("_value"), F.col(key).alias("_key"), F.pmod(F.col(key), F.lit(1)).cast("bigint").alias("_s")
    )
    salted = facts.withColumn("_salt", salt.cast("bigint"))
    return (
        salted.join(known, (salted[column] == known["_value"]) & (salted["_salt"] == known["_s"]), "left")
        .withColumn(key, F.col("_key"))
        .drop("_value", "_key", "_s", "_salt")
    )


def known_or_null(
    facts: DataFrame, dimension: DataFrame, column: str, key: str, spread: str, used: DataFrame | None = None
) -> DataFrame:
    """As :func:`left_key_lookup`, without moving the facts if the dimension lacks few of their values.

    ``used``: a narrower table with all values of the column.
    """
    values = dimension.select(F.col(key).alias(column))
    missing, few = absent(facts if used is None else used, values, column)
    if not few:
        return left_key_lookup(facts, dimension, column, key, spread)
    lacking = F.broadcast(missing.select(F.col(column).alias("_absent")))
    known = F.when(F.col("_absent").isNull(), F.col(column)).cast(dimension.schema[key].dataType)
    return facts.join(lacking, F.col(column) == F.col("_absent"), "left").withColumn(key, known).drop("_absent")
