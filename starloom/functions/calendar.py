"""Calendar attributes as column expressions.

Every attribute is a function of the date, so a fact that carries its date needs no join with
the calendar table to be grouped by month, weekday or fiscal year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public holidays 2024-2026.
HOLIDAYS = [
    "2024-01-01", "2024-01-08", "2024-02-11", "2024-02-12", "2024-02-23", "2024-03-20", "2024-04-29", "2024-05-03",
    "2024-05-04", "2024-05-05", "2024-05-06", "2024-07-15", "2024-08-11", "2024-08-12", "2024-09-16", "2024-09-22",
    "2024-09-23", "2024-10-14", "2024-11-03", "2024-11-04", "2024-11-23",
    "2025-01-01", "2025-01-13", "2025-02-11", "2025-02-23", "2025-02-24", "2025-03-20", "2025-04-29", "2025-05-03",
    "2025-05-04", "2025-05-05", "2025-05-06", "2025-07-21", "2025-08-11", "2025-09-15", "2025-09-23", "2025-10-13",
    "2025-11-03", "2025-11-23", "2025-11-24",
    "2026-01-01", "2026-01-12", "2026-02-11", "2026-02-23", "2026-03-20", "2026-04-29", "2026-05-03", "2026-05-04",
    "2026-05-05", "2026-05-06", "2026-07-20", "2026-08-11", "2026-09-21", "2026-09-22", "2026-09-23", "2026-10-12",
    "2026-11-03", "2026-11-23",
]

FISCAL_START_MONTH = 4

_HOLIDAY_LIST = ", ".join(f"DATE'{day}'" for day in HOLIDAYS)
_TO_FISCAL = 1 - FISCAL_START_MONTH

# Calendar column -> expression over {d}, in table order.
ATTRIBUTES: dict[str, str] = {
    "date_key": "CAST(date_format({d}, 'yyyyMMdd') AS BIGINT)",
    "full_date": "{d}",
    "year": "CAST(year({d}) AS BIGINT)",
    "quarter": "CAST(quarter({d}) AS BIGINT)",
    "month": "CAST(month({d}) AS BIGINT)",
    "month_name": "date_format({d}, 'MMMM')",
    "day_of_week": "CAST(weekday({d}) AS BIGINT)",
    "day_name": "date_format({d}, 'EEEE')",
    "is_weekend": "weekday({d}) >= 5",
    "week_of_year": "CAST(weekofyear({d}) AS BIGINT)",
    "year_month": "date_format({d}, 'yyyy-MM')",
    "year_quarter": "concat(year({d}), '-Q', quarter({d}))",
    "is_holiday": f"{{d}} IN ({_HOLIDAY_LIST})",
    "fiscal_year": f"CAST(year(add_months({{d}}, {_TO_FISCAL})) AS BIGINT)",
    "fiscal_quarter": f"CAST(quarter(add_months({{d}}, {_TO_FISCAL})) AS BIGINT)",
}


def attribute(name: str, day: str) -> Column:
    """One calendar attribute of the date column ``day``."""
    return F.expr(ATTRIBUTES[name].format(d=day)).alias(name)


def date_key(day: str) -> Column:
    """YYYYMMDD as a number, by arithmetic: facts compute it once per row."""
    return F.expr(f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS BIGINT)")


def day_of(key: str) -> Column:
    """The date behind a date key."""
    return F.expr(f"make_date(CAST({key} div 10000 AS INT), CAST({key} div 100 % 100 AS INT), CAST({key} % 100 AS INT))")


def with_calendar(df: DataFrame, day: str, *names: str) -> DataFrame:
    """Add the named calendar columns derived from the date column ``day``."""
    return df.select("*", *[attribute(name, day) for name in names])
