from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import labels, scoring
from starloom.functions.calendar import ATTRIBUTES, HOLIDAYS, attribute, date_key
from starloom.plans.dimensions import dim_time


def evaluate(spark, column, **values):
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in values.items())
    row = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "prefecture, region",
    [("北海道", "北海道"), ("青森県", "東北"), ("東京都", "関東"), ("静岡県", "中部"), ("大阪府", "関西"),
     ("山口県", "中国"), ("高知県", "四国"), ("沖縄県", "九州・沖縄"), ("Paris", "不明"), (None, "不明")],
)
def test_region(spark, prefecture, region):
    assert evaluate(spark, labels.region_of(F.col("p")), p=("string", prefecture)) == region


def test_every_prefecture_has_one_region():
    names = [name for group in labels.REGIONS.values() for name in group]
    assert len(names) == len(set(names)) == 47


@pytest.mark.parametrize(
    "born, band",
    [(None, "不明"), (date(2010, 1, 1), "20代"), (date(1996, 1, 1), "20代"), (date(1995, 12, 31), "30代"),
     (date(1986, 1, 1), "30代"), (date(1985, 1, 1), "40代"), (date(1975, 6, 1), "50代"), (date(1966, 1, 1), "50代"),
     (date(1965, 12, 31), "60代以上")],
)
def test_age_band_counts_calendar_years(spark, born, band):
    got = evaluate(spark, labels.age_band(F.col("b"), F.lit(date(2025, 6, 30))), b=("date", born))
    assert got == band


def test_day_parts(spark):
    rows = spark.range(24).select(labels.day_part(F.col("id")).alias("part")).collect()
    expected = ["深夜"] * 5 + ["早朝"] * 2 + ["朝"] * 3 + ["昼前"] * 2 + ["昼"] * 3 + ["午後"] * 3 + ["夕方"] * 3 + ["夜"] * 3
    assert [row["part"] for row in rows] == expected


def test_business_hours(spark):
    rows = dim_time(spark).collect()
    assert [r["time_key"] for r in rows if r["is_business_hours"]] == list(range(9, 18))
    assert len(rows) == 24 and all(r["time_key"] == r["hour_of_day"] for r in rows)


@pytest.mark.parametrize("code, label", [("pending", "保留中"), ("cancelled", "キャンセル"), ("lost", "不明"), (None, "不明")])
def test_status_label(spark, code, label):
    assert evaluate(spark, labels.status_label(F.col("s")), s=("string", code)) == label


@pytest.mark.parametrize(
    "day, expected",
    [
        (date(2025, 3, 31), {"date_key": 20250331, "fiscal_year": 2024, "fiscal_quarter": 4, "day_of_week": 0,
                             "month_name": "March", "day_name": "Monday", "year_month": "2025-03"}),
        (date(2025, 4, 1), {"fiscal_year": 2025, "fiscal_quarter": 1, "quarter": 2, "year_quarter": "2025-Q2"}),
        (date(2024, 12, 30), {"week_of_year": 1, "year": 2024, "fiscal_quarter": 3}),
        (date(2025, 1, 5), {"day_of_week": 6, "is_weekend": True, "is_holiday": False, "fiscal_year": 2024}),
        (date(2025, 1, 4), {"day_of_week": 5, "is_weekend": True}),
        (date(2026, 9, 22), {"is_holiday": True, "is_weekend": False, "fiscal_quarter": 2}),
        (date(2024, 2, 29), {"date_key": 20240229, "fiscal_year": 2023, "fiscal_quarter": 4}),
        (date(2025, 5, 31), {"fiscal_year": 2025, "fiscal_quarter": 1}),
    ],
)
def test_calendar_attributes(spark, day, expected):
    frame = spark.createDataFrame([(day,)], "d date")
    row = frame.select(*[attribute(name, "d") for name in ATTRIBUTES]).first().asDict()
    assert {name: row[name] for name in expected} == expected
    assert frame.select(date_key("d").alias("k")).first()["k"] == row["date_key"]


def test_holidays_are_58_distinct_days():
    assert len(set(HOLIDAYS)) == len(HOLIDAYS) == 58


def scores(spark, recency=1, frequency=1, monetary=1):
    columns = scoring.rfm_scores(F.col("r"), F.col("f"), F.col("m"), scoring.RfmBands())
    row = spark.createDataFrame([(recency, frequency, monetary)], "r bigint, f bigint, m bigint")
    return tuple(row.select(*[c.alias(n) for n, c in columns.items()]).first())


@pytest.mark.parametrize("days, score", [(0, 5), (30, 5), (31, 4), (90, 4), (91, 3), (180, 3), (181, 2), (365, 2), (366, 1)])
def test_recency_bands(spark, days, score):
    assert scores(spark, recency=days)[0] == score


@pytest.mark.parametrize("orders, score", [(1, 1), (2, 2), (4, 2), (5, 3), (9, 3), (10, 4), (19, 4), (20, 5)])
def test_frequency_bands(spark, orders, score):
    assert scores(spark, frequency=orders)[1] == score


@pytest.mark.parametrize(
    "spent, score", [(29_999, 1), (30_000, 2), (99_999, 2), (100_000, 3), (199_999, 3), (200_000, 4), (499_999, 4), (500_000, 5)]
)
def test_monetary_bands(spark, spent, score):
    assert scores(spark, monetary=spent)[2] == score


def test_segment_of_every_score_combination(spark):
    """Against the rules written as plain conditions."""

    def expected(r, f, m):
        if r >= 4 and f >= 4 and m >= 4:
            return "チャンピオン"
        if r >= 3 and f >= 3 and m >= 3:
            return "ロイヤル"
        if r >= 4 and f <= 2:
            return "有望"
        if r <= 2 and f >= 3 and m >= 3:
            return "リスクあり"
        return "休眠" if r <= 2 and f <= 2 else "その他"

    grid = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    frame = spark.createDataFrame(grid, "r int, f int, m int")
    for row in frame.withColumn("s", scoring.rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect():
        assert row["s"] == expected(row["r"], row["f"], row["m"]), row


@pytest.mark.parametrize(
    "orders, first, last, yearly",
    [(1, date(2025, 1, 1), date(2025, 1, 1), 1.0), (2, date(2025, 1, 1), date(2025, 1, 1), None),
     (2, date(2024, 1, 1), date(2024, 12, 31), 2.0)],
)
def test_annual_frequency(spark, orders, first, last, yearly):
    got = evaluate(
        spark, scoring.annual_frequency(F.col("n"), F.col("a"), F.col("b")),
        n=("bigint", orders), a=("date", first), b=("date", last),
    )
    assert got == yearly


@pytest.mark.parametrize("share, rank", [(0.6, "A"), (0.6000001, "B"), (0.85, "B"), (0.8500001, "C"), (1.0, "C")])
def test_abc_cuts(spark, share, rank):
    assert evaluate(spark, labels.abc_rank(F.col("s"), F.lit(1).cast("decimal(12,2)")), s=("decimal(12,8)", Decimal(str(share)))) == rank
