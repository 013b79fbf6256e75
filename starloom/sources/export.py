"""Results as files other programs read."""

from __future__ import annotations

from pyspark.sql import DataFrame

FORMATS = ("csv", "json", "parquet")


def export(df: DataFrame, path: str, fmt: str = "csv", compression: str | None = None) -> None:
    """Write a result in parallel part files; CSV carries a header. Readers tell ``compression`` by the file's name."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {FORMATS}")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    if compression:
        writer = writer.option("compression", compression)
    writer.format(fmt).save(path)


def read_export(template: DataFrame, path: str, fmt: str) -> DataFrame:
    """Read an export back with the exported result's own types."""
    reader = template.sparkSession.read.format(fmt).schema(template.schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)
