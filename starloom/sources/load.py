"""Full-refresh load of operational tables into the raw layer."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import TABLES, reading_schema
from starloom.sources.raw import RawTables, conform

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadResult:
    table_name: str
    extracted: int | None
    loaded: int | None
    succeeded: bool


def load_table(raw: RawTables, table: str, target: str, chunk_rows: int | None = None) -> LoadResult:
    """Replace ``target/table`` with the source's rows, typed as declared.

    An empty source empties the table. ``chunk_rows`` caps the rows per written file.
    """
    seen = Observation()
    rows = conform(raw.table(table), table).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("overwrite")
    if chunk_rows:
        writer = writer.option("maxRecordsPerFile", chunk_rows)
    writer.parquet(f"{target}/{table}")
    loaded = raw.spark.read.schema(reading_schema(table)).parquet(f"{target}/{table}").count()
    return LoadResult(table, seen.get["rows"], loaded, True)


class LoadError(RuntimeError):
    """Some tables failed; ``results`` tells of all."""

    def __init__(self, results: list[LoadResult]):
        super().__init__("failed to load " + ", ".join(r.table_name for r in results if not r.succeeded))
        self.results = results


def load_all(
    raw: RawTables, target: str, tables: Iterable[str] = tuple(TABLES), parallel: int = 4
) -> list[LoadResult]:
    """Load the tables, ``parallel`` at a time; a failing one does not stop the rest.

    Raises :class:`LoadError` after the last one if any failed, so that nothing is built on them.
    """

    def attempt(table: str) -> LoadResult:
        try:
            return load_table(raw, table, target)
        except Exception:
            log.exception("load of %s failed", table)
            return LoadResult(table, None, None, False)

    with ThreadPoolExecutor(parallel) as pool:
        results = list(pool.map(attempt, tables))
    if not all(result.succeeded for result in results):
        raise LoadError(results)
    return results


def audit(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    return spark.createDataFrame(
        [astuple(result) for result in results],
        "table_name string, extracted bigint, loaded bigint, succeeded boolean",
    )


def load_json_lines(spark: SparkSession, source: str, table: str, target: str) -> DataFrame:
    """Replace ``target`` with a table delivered as newline-delimited JSON, and return it.

    The declared schema is applied while parsing; a value that does not fit fails the load.
    """
    rows = spark.read.schema(reading_schema(table)).option("mode", "FAILFAST").json(source)
    rows.write.mode("overwrite").parquet(target)
    return spark.read.schema(reading_schema(table)).parquet(target)
