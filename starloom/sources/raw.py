"""Where the eight operational tables come from.

A source answers ``table(name, columns)``; ``columns`` lists what the caller reads, so that a
source can skip the work behind the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from starloom.schemas import TABLES, reading_schema


class RawTables(Protocol):
    spark: SparkSession

    def table(self, name: str, columns: Sequence[str] | None = None) -> DataFrame: ...


def conform(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast to the declared column types; a value that does not fit raises."""
    wanted = [f for f in TABLES[table] if columns is None or f.name in columns]
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in wanted])


class FileTables:
    """One folder or file per table under ``root``: parquet, orc, json or csv."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", **options: str):
        self.spark, self.root, self.fmt, self.options = spark, root.rstrip("/"), fmt, options

    def table(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        reader = self.spark.read.format(self.fmt).schema(reading_schema(name)).options(**self.options)
        if self.fmt in ("json", "csv"):
            reader = reader.option("mode", "FAILFAST")
        df = reader.load(f"{self.root}/{name}")
        return df if columns is None else df.select(*columns)


class DatabaseTables:
    """Tables of the operational database over JDBC, read by parallel key ranges.

    ``ranges`` maps a table to (lowest key, highest key, partitions). The bounds only place the
    cuts; rows outside them are still read. For a table without an entry they are asked from the
    database first, with ``partitions`` ranges.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str],
        ranges: Mapping[str, tuple[int, int, int]] | None = None,
        partitions: int = 16,
    ):
        self.spark, self.url = spark, url
        self.properties, self.ranges, self.partitions = dict(properties), dict(ranges or {}), partitions

    def read_options(self, name: str) -> dict[str, str]:
        options = {"url": self.url, "dbtable": name, "fetchsize": "10000", **self.properties}
        if name in self.ranges:
            low, high, partitions = self.ranges[name]
            options |= {
                "partitionColumn": TABLES[name][0].name,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(partitions),
            }
        return options

    def bounds_options(self, name: str) -> dict[str, str]:
        key = TABLES[name][0].name
        query = f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {name}"
        return {"url": self.url, "query": query, **self.properties}

    def _ask_range(self, name: str) -> None:
        """Bounds of a table's key; an empty table keeps the plain read."""
        row = self.spark.read.format("jdbc").options(**self.bounds_options(name)).load().first()
        if row[0] is not None and row[1] > row[0]:
            self.ranges[name] = (int(row[0]), int(row[1]) + 1, self.partitions)

    def table(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        if name not in self.ranges:
            self._ask_range(name)
        df = self.spark.read.format("jdbc").options(**self.read_options(name)).load()
        return conform(df, name, columns)


class FrameTables:
    """Tables handed over as DataFrames, e.g. small literals in tests."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame]):
        self.spark, self.frames = spark, dict(frames)

    def table(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        return conform(self.frames[name], name, columns)
