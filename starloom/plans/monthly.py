"""Sales by product and month, kept up by deltas.

All measures are additive, so late lines are added and a corrected line is its old form subtracted and
its new one added. A batch writes what it changes, a folder for each month it touches, and one pointer file
names the folders of every month together with the batches that are in: a batch counts once, however often
it is tried. The folders of a month are summed when it is read; a month that has ``LAYERS`` of them is
written anew with the next batch that touches it, so neither the cost of a small batch nor that of a read
follows the number of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources import pointer

KEYS = ("month", "product_id")
MEASURES = ("line_count", "quantity", "net_amount", "discount_rates", "discounted_lines")
#: Folders of a month before it is written anew.
LAYERS = 8


def by_month(lines: DataFrame) -> DataFrame:
    """Sums of ``lines`` (product_id, order_date, quantity, net_amount, discount_rate) by month (YYYYMM) and product."""
    return _signed(lines.withColumn("_sign", F.lit(1).cast("bigint")))


def delta(added: DataFrame, withdrawn: DataFrame | None = None) -> DataFrame:
    """What lines that came, and lines that no longer hold, change."""
    if withdrawn is None:
        return by_month(added)
    read = ("product_id", "order_date")
    amounts = ("quantity", "net_amount", "discount_rate")
    plus = added.select(*read, *amounts, F.lit(1).cast("bigint").alias("_sign"))
    minus = withdrawn.select(*read, *[(-F.col(a)).alias(a) for a in amounts], F.lit(-1).cast("bigint").alias("_sign"))
    return _signed(plus.unionByName(minus))


def _signed(lines: DataFrame) -> DataFrame:
    """Sums of lines that count ``_sign`` times, with amounts that carry the sign already."""
    month = (F.year("order_date") * 100 + F.month("order_date")).cast("bigint")
    rated = F.when(F.col("discount_rate").isNotNull(), F.col("_sign")).otherwise(F.lit(0))
    return lines.groupBy(month.alias("month"), "product_id").agg(
        F.sum("_sign").alias("line_count"),
        F.sum("quantity").alias("quantity"),
        F.sum("net_amount").alias("net_amount"),
        F.sum("discount_rate").alias("discount_rates"),
        F.sum(rated).alias("discounted_lines"),
    )


def _summed(parts: DataFrame, like: DataFrame) -> DataFrame:
    return parts.groupBy(*KEYS).agg(*[F.sum(m).cast(like.schema[m].dataType).alias(m) for m in MEASURES])


def _write(change: DataFrame, path: str) -> None:
    # The month stands in the folder's name and in the rows: files are read one by one, without discovery.
    placed = change.withColumn("_folder", F.col("month")).hint("rebalance", "_folder")
    placed.write.mode("overwrite").partitionBy("_folder").parquet(path)


class MonthlySales:
    """The aggregate under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _state(self) -> dict:
        return pointer.read(self.spark, self.path) or {"batches": [], "months": {}, "schema": None}

    def _read(self, state: dict, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{folder}" for folder in folders])

    def apply(self, batch: str, change: DataFrame) -> list[int]:
        """Add the sums of ``change``; returns the months it touches, none if the batch is in already."""
        state = self._state()
        if batch in state["batches"]:
            return []
        state["schema"] = state["schema"] or change.schema.jsonValue()
        change = change.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromJson(state["schema"])])
        work = f"batch-{len(state['batches']):06d}"
        _write(change, f"{self.path}/{work}/months")
        arrived = self._read(state, [f"{work}/months"])
        months = sorted((r[0] for r in arrived.select("month").distinct().collect()), key=lambda m: (m is not None, m))
        if None in months:
            raise ValueError("lines without a date belong to no month")
        named = state["months"] | {
            str(m): [*state["months"].get(str(m), []), f"{work}/months/_folder={m}"] for m in months  # as many as the calendar has
        }
        deep = [str(m) for m in months if len(named[str(m)]) > LAYERS]
        if deep:
            _write(_summed(self._read(state, [f for m in deep for f in named[m]]), change), f"{self.path}/{work}/merged")
            named |= {m: [f"{work}/merged/_folder={m}"] for m in deep}
        pointer.swap(self.spark, self.path, state | {"batches": [*state["batches"], batch], "months": named})
        return months

    def table(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """Months from ``first`` to ``last`` (YYYYMM), all by default; others are not even opened."""
        state = self._state()
        wanted = [
            folders for month, folders in sorted(state["months"].items())
            if (first is None or int(month) >= first) and (last is None or int(month) <= last)
        ]
        several = [folder for folders in wanted if len(folders) > 1 for folder in folders]
        whole = self._read(state, [folders[0] for folders in wanted if len(folders) == 1])
        if several:
            layers = self._read(state, several)
            whole = whole.unionByName(_summed(layers, layers))
        return whole.where("line_count <> 0")

    def product_totals(self) -> DataFrame:
        """Totals by product, the coarsest question the months answer.

        The folders are dealt by product, of which each has at most a row a month, and summed in place.
        """
        state = self._state()
        layers = self._read(state, [f for folders in state["months"].values() for f in folders]).repartition("product_id")
        months = _summed(layers, layers).where("line_count <> 0")
        return months.groupBy("product_id").agg(*[F.sum(m).alias(m) for m in MEASURES])
