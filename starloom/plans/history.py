"""Type 2 history of a dimension: every version of a member with the days it was valid.

Versions are only ever added. A load is compared with the latest version of each member by a hash of the
tracked columns, in one full outer join; what is new, changed or gone becomes a version of the load's own
folder, and unchanged members are written nowhere. Validity is closed when the history is read, by the
next version of the member. A pointer file names the loads that count, so readers never see half of one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.operators.ranking import dense_index
from starloom.sources import pointer

#: The last day of versions that have no successor.
FOREVER = date(9999, 12, 31)


def row_hash(columns: Sequence[str]):
    """A hash of the columns that tells NULL from any value; 128 bits, so that no change goes unseen."""
    return F.unhex(F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))


class History:
    """The versions of one dimension under one folder."""

    def __init__(self, spark: SparkSession, path: str, key: str, tracked: Sequence[str]):
        """``key`` is the member's id, ``tracked`` the columns whose change makes a version."""
        self.spark, self.path, self.key, self.tracked = spark, path.rstrip("/"), key, list(tracked)

    def loads(self) -> list[dict]:
        return (pointer.read(self.spark, self.path) or {"loads": []})["loads"]

    def versions(self) -> DataFrame | None:
        """All versions as written, among them the mark of each member that went; None before the first load."""
        folders = [f"{self.path}/{load['folder']}" for load in self.loads()]
        return self.spark.read.parquet(*folders) if folders else None

    def apply(self, load: DataFrame, loaded_on: date, first_day: date | None = None) -> int:
        """Take in the whole dimension as it is on ``loaded_on``; returns the versions added.

        Ids must be unique and not null. ``first_day`` backdates the versions of this load, for a first one
        that describes the past as well. A load must be later than the one before.
        """
        done = self.loads()
        if done and str(loaded_on) <= done[-1]["loaded_on"]:
            raise ValueError(f"{loaded_on} is not after the load of {done[-1]['loaded_on']}")
        key, number = self.key, len(done)
        arrived = load.select(key, *self.tracked, row_hash(self.tracked).alias("row_hash"))
        before = self.versions()
        if before is None:
            fresh = arrived.withColumn("is_deleted", F.lit(False))
        else:
            latest = before.groupBy(F.col(key).alias("_key")).agg(
                F.max_by(F.struct("row_hash", "is_deleted"), "load_number").alias("_latest")
            )
            both = arrived.join(latest, F.col(key) == F.col("_key"), "full_outer")
            gone = F.col(key).isNull()
            known = F.coalesce(~F.col("_latest.is_deleted"), F.lit(False))
            changed = ~known | (F.col("row_hash") != F.col("_latest.row_hash"))
            fresh = both.where(F.when(gone, known).otherwise(changed)).select(
                F.coalesce(key, "_key").alias(key), *self.tracked, "row_hash", gone.alias("is_deleted")
            )
        used = done[-1]["last_key"] if done else 0
        valid_from = F.lit(first_day or loaded_on)
        numbered = dense_index(fresh, [key], "version_key").select(
            (F.col("version_key") + used).alias("version_key"), key, *self.tracked, "row_hash", "is_deleted",
            valid_from.alias("valid_from"), F.lit(number).alias("load_number"),
        )
        folder = f"load-{number:06d}"
        numbered.write.mode("overwrite").parquet(f"{self.path}/{folder}")  # what a failed try left is replaced
        added = self.spark.read.parquet(f"{self.path}/{folder}").count()
        entry = {"folder": folder, "loaded_on": str(loaded_on), "last_key": used + added}
        pointer.swap(self.spark, self.path, {"loads": [*done, entry]})
        return added

    def dimension(self) -> DataFrame:
        """One row per version: its surrogate key, the member, and the days from and to (excluded) which it was valid."""
        later = Window.partitionBy(self.key).orderBy("valid_from", "load_number")
        closed = self.versions().withColumn("valid_to", F.coalesce(F.lead("valid_from").over(later), F.lit(FOREVER)))
        return closed.where("NOT is_deleted").select(
            "version_key", self.key, *self.tracked, "valid_from", "valid_to",
            (F.col("valid_to") == F.lit(FOREVER)).alias("is_current"),
        )

    def starts(self) -> DataFrame:
        """(id, valid_from, version_key) of all versions; the key is NULL from the day a member went."""
        live = F.when(~F.col("is_deleted"), F.col("version_key"))
        return self.versions().select(self.key, "valid_from", live.alias("version_key"))


def previous_value(history: History, column: str) -> DataFrame:
    """Type 3: each current member with the last value of ``column`` that differs from its present one.

    A value that came back counts by what stood between: A, B, A gives B. NULL is a value like others,
    so ``has_previous`` tells an earlier NULL from none.
    """
    key, tracked = history.key, F.col(column)
    runs = Window.partitionBy(key).orderBy("valid_from")
    versions = history.dimension()
    before = F.lag(F.struct(column)).over(runs)
    changes = versions.withColumn("_before", before).where(
        F.col("_before").isNull() | ~F.col(f"_before.{column}").eqNullSafe(tracked)
    )
    last = changes.groupBy(key).agg(F.max_by("_before", "valid_from").alias("_before"))
    present = versions.where("is_current").select(key, F.col(column).alias(f"current_{column}"))
    return present.join(last, key).select(
        key, f"current_{column}", F.col(f"_before.{column}").alias(f"previous_{column}"),
        F.col("_before").isNotNull().alias("has_previous"),
    )
