"""One page of a result."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Page:
    rows: DataFrame
    number: int
    size: int
    total_rows: int

    @property
    def total_pages(self) -> int:
        return max(1, -(-self.total_rows // self.size))


def page(
    df: DataFrame, order: Sequence[str | Column], number: int, size: int, known_total: int | None = None
) -> Page:
    """Page ``number`` (from 1) in the given order, which should end in a unique column.

    ``known_total`` spares the count when the caller keeps it from an earlier page. Spark plans
    the page as a top-k of ``number * size`` rows; for deep pages use :func:`page_after`.
    """
    if number < 1 or size < 1:
        raise ValueError("page number and size start at 1")
    total = df.count() if known_total is None else known_total
    rows = df.orderBy(*order).offset((number - 1) * size).limit(size)
    return Page(rows, number, size, total)


def page_after(df: DataFrame, order: Sequence[str], last: Sequence | None, size: int) -> DataFrame:
    """The ``size`` rows behind the row with the values ``last`` of the ascending columns ``order``.

    However deep the page, it is a top-k of ``size`` rows behind a filter that reaches the scan.
    ``last`` is None for the first page; no column may hold NULL, and together they are unique.
    """
    if last is not None:
        behind = F.lit(False)
        for column, value in reversed(list(zip(order, last, strict=True))):
            behind = (F.col(column) > F.lit(value)) | ((F.col(column) == F.lit(value)) & behind)
        df = df.where((F.col(order[0]) >= F.lit(last[0])) & behind)
    return df.orderBy(*order).limit(size)
