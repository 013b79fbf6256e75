"""Shares of a total."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from starloom.functions.amounts import percentage


def share_of_total(part: str, digits: int = 1) -> Column:
    """Each row's percentage of the column's sum.

    For use on grouped results only: the window has no partitioning, so its input must be as
    small as the vocabulary it was grouped by. It replaces a second scan for the total.
    """
    everything = Window.partitionBy(F.lit(True))
    return percentage(F.col(part), F.sum(part).over(everything), digits)
