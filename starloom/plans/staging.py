"""Typed, cleaned copies of the operational tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starloom.schemas import TABLES
from starloom.sources.raw import RawTables

RENAMED = {("categories", "name"): "category_name", ("order_items", "discount"): "discount_rate"}
# Blanks around an order status are noise, and so is its case.
CLEANED = {("orders", "status"): r"lower(btrim({value}, ' \t\r\n\f'))"}


def _staged_name(table: str, column: str) -> str:
    return RENAMED.get((table, column), column)


def stage(raw: RawTables, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast every column to its declared type, clean order status, rename ambiguous names.

    ``columns`` are staged names; the source only delivers what is behind them.
    """
    fields = [f for f in TABLES[table] if columns is None or _staged_name(table, f.name) in columns]
    rules = []
    for f in fields:
        value = f"CAST({f.name} AS {f.dataType.simpleString()})"
        rule = CLEANED.get((table, f.name), "{value}").format(value=value)
        rules.append(f"{rule} AS {_staged_name(table, f.name)}")
    return raw.table(table, [f.name for f in fields]).selectExpr(*rules)
