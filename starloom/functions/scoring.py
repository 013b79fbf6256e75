"""Customer scores and lifetime value as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions import labels
from starloom.functions.amounts import ratio


@dataclass(frozen=True)
class RfmBands:
    """Cut points for scores 5, 4, 3 and 2; anything beyond the last one scores 1."""

    recency_days: tuple[int, ...] = (30, 90, 180, 365)
    frequency: tuple[int, ...] = (20, 10, 5, 2)
    monetary: tuple[int, ...] = (500_000, 200_000, 100_000, 30_000)


HORIZON_YEARS = 3


def _score(passes: list[Column]) -> Column:
    scores = [(condition, F.lit(5 - step).cast("bigint")) for step, condition in enumerate(passes)]
    return labels.first_match(scores, F.lit(1).cast("bigint"))


def rfm_scores(recency: Column, frequency: Column, monetary: Column, bands: RfmBands) -> dict[str, Column]:
    return {
        "rfm_recency_score": _score([recency <= cut for cut in bands.recency_days]),
        "rfm_frequency_score": _score([frequency >= cut for cut in bands.frequency]),
        "rfm_monetary_score": _score([monetary >= cut for cut in bands.monetary]),
    }


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Rules are tried top to bottom; the order is part of the definition."""
    rules = [  # fixed values
        ((r >= 4) & (f >= 4) & (m >= 4), labels.CHAMPION),
        ((r >= 3) & (f >= 3) & (m >= 3), labels.LOYAL),
        ((r >= 4) & (f <= 2), labels.PROMISING),
        ((r <= 2) & (f >= 3) & (m >= 3), labels.AT_RISK),
        ((r <= 2) & (f <= 2), labels.DORMANT),
    ]
    return labels.first_match([(rule, F.lit(name)) for rule, name in rules], F.lit(labels.OTHER))


def annual_frequency(orders: Column, first_day: Column, last_day: Column) -> Column:
    """Orders per year between first and last order; one order counts as once a year.

    Several orders on a single day span no time, so their frequency is NULL.
    """
    years = F.datediff(last_day, first_day) / F.lit(365.0)
    return F.when(orders == 1, F.lit(1.0)).otherwise(ratio(orders, years))


def lifetime_value(average_order: Column, yearly: Column) -> Column:
    return average_order * yearly * F.lit(float(HORIZON_YEARS))
