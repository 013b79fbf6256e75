"""Tiny operational tables for tests: give the columns that matter, the rest gets a filler."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import types as T

from starloom.schemas import TABLES, reading_schema
from starloom.sources.raw import FrameTables

SMALL = "/root/testdata/sf0.001"
AS_OF = date(2025, 6, 30)


def _filler(field: T.StructField):
    if field.nullable:
        return None
    kinds = {
        T.LongType: 0, T.StringType: "x", T.DateType: date(2025, 1, 1),
        T.TimestampType: datetime(2025, 1, 1), T.DecimalType: Decimal("0.00"), T.BooleanType: True,
    }
    return kinds[type(field.dataType)]


def _value(field: T.StructField, value):
    if isinstance(field.dataType, T.DecimalType) and value is not None:
        return Decimal(str(value))
    return value


def frame(spark, table: str, rows: list[dict]):
    schema = TABLES[table]
    unknown = {name for row in rows for name in row} - set(schema.names)
    assert not unknown, unknown
    data = [
        tuple(_value(f, row[f.name]) if f.name in row else _filler(f) for f in schema) for row in rows
    ]
    return spark.createDataFrame(data, reading_schema(table))


def raw_tables(spark, **tables: list[dict]) -> FrameTables:
    return FrameTables(spark, {name: frame(spark, name, tables.get(name, [])) for name in TABLES})


def dicts(df) -> list[dict]:
    return [row.asDict() for row in df.collect()]
