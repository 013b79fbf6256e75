"""Allocation, combinations, the weighted bridge, profiles and calendar roles."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tables import AS_OF, SMALL, raw_tables

import __spark_entry__ as entry
from starloom.operators import allocation
from starloom.operators.allocation import allocate, wide_groups
from starloom.operators.combinations import Combinations, vocabulary
from starloom.operators.ranking import index_in_group
from starloom.plans import bridge, profiles, roles
from starloom.plans.star import Star

PARTS = "g long, part long, share long, units long"


def by_largest_remainder(rows):
    """{(group, part): units} by the rule as it is written."""
    out = {}
    groups = defaultdict(list)
    for group, part, share, units in rows:
        groups[group].append((part, max(share or 0, 0), units))
    for group, parts in groups.items():
        total = sum(share for _, share, _ in parts)
        if total == 0:
            parts, total = [(part, 1, units) for part, _, units in parts], len(parts)
        units = parts[0][2]
        whole = {part: abs(units) * share // total for part, share, _ in parts}
        rest = sorted(((abs(units) * share % total, part) for part, share, _ in parts), reverse=True)
        for _, part in rest[: abs(units) - sum(whole.values())]:
            whole[part] += 1
        out |= {(group, part): n if units >= 0 else -n for part, n in whole.items()}
    return out


@pytest.mark.parametrize("seed", range(3))
def test_allocation_equals_the_rule(spark, seed):
    rng, rows = random.Random(seed), []
    for group in range(60):
        units = rng.choice([0, 1, 7, 100, 10**6, -100, 9 * 10**18])
        size = 400 if group == 7 else rng.randint(1, 6)
        top = rng.choice([1, 3, 9 * 10**15])
        rows += [(group, part, rng.choice([None, -1, 0, rng.randint(0, top)]), units) for part in range(size)]
    split = allocate(spark.createDataFrame(rows, PARTS), "g", "part", "share", "units", "n").collect()
    assert {(r.g, r.part): r.n for r in split} == by_largest_remainder(rows) and len(split) == len(rows)


def test_narrow_groups_are_split_without_ranges_and_wide_ones_alike(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(g, part, rng.randint(0, 50), 1000 + g) for g in range(40) for part in range(300 if g in (3, 8) else 4)]
    want, parts = by_largest_remainder(rows), spark.createDataFrame(rows, PARTS)
    ranges = []
    monkeypatch.setattr(allocation, "index_in_group", lambda df, *a: ranges.append(df.count()) or index_in_group(df, *a))
    for most, rows_in_ranges in ((50_000, []), (100, [600])):
        monkeypatch.setattr(allocation, "GROUP_ROWS", most)
        split = allocate(parts, "g", "part", "share", "units", "n")
        assert {(r.g, r.part): r.n for r in split.collect()} == want and split.count() == len(rows)
        assert ranges == rows_in_ranges
    given = allocate(parts, "g", "part", "share", "units", "n", wide_groups(parts, "g", 100))
    assert {(r.g, r.part): r.n for r in given.collect()} == want


def test_three_equal_promotions(spark):
    rows = spark.createDataFrame([(1001, 10, 5), (1001, 20, 5), (1001, 30, 5)], "order_id long, promotion_key long, basis long")
    known = spark.createDataFrame([(10,), (20,), (30,)], "promotion_key long")
    found = {r.promotion_key: r.weight_factor for r in bridge.order_promotions(rows, known, 2).collect()}
    assert found == {10: Decimal("0.33"), 20: Decimal("0.33"), 30: Decimal("0.34")}


def test_unknown_promotions_and_missing_amounts(spark):
    rows = spark.createDataFrame(
        [(1, 10, 1), (1, 99, 9), (2, 99, 1), (3, 10, 1), (None, 10, 1)], "order_id long, promotion_key long, basis long"
    )
    weights = bridge.order_promotions(rows, spark.createDataFrame([(10,)], "promotion_key long"))
    assert sorted((r.order_id, r.weight_factor) for r in weights.collect()) == [(1, Decimal(1)), (3, Decimal(1))]
    amounts = spark.createDataFrame([(1, None), (3, Decimal("-0.07"))], "order_id long, net decimal(12,2)")
    assert {r.order_id: r.net for r in bridge.allocated(weights, amounts, "net").collect()} == {1: None, 3: Decimal("-0.07")}


def test_allocation_of_no_rows(spark):
    assert allocate(spark.createDataFrame([], PARTS), "g", "part", "share", "units", "n").collect() == []


def test_weights_add_up_to_one_and_money_to_the_order(spark):
    star = entry.star_of(spark, SMALL)
    weights = entry._bridge(star)
    assert weights.groupBy("order_id").agg(F.sum("weight_factor").alias("w")).where("w <> 1").count() == 0
    parts = bridge.allocated(weights, star.order_totals, "net_amount").groupBy("order_id").agg(F.sum("net_amount").alias("parts"))
    both = star.order_totals.join(parts, "order_id")
    assert both.count() == star.order_totals.count() and both.where("parts <> net_amount").count() == 0


@pytest.mark.parametrize("group", [None, 1])
def test_one_group_fills_several_ranges(spark, group):
    rows = [(group, n) for n in range(3000)] + [(g, n) for g in range(2, 300) for n in range(3)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "g long, n long").repartition(4)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = index_in_group(df, "g", [F.col("n").desc()], "place").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = defaultdict(int)
    for g, _ in rows:
        sizes[g] += 1
    assert len(numbered) == len(rows) and all(r.place == sizes[r.g] - r.n for r in numbered)


def test_combinations_go_both_ways(spark):
    both = Combinations({"a": [False, True], "b": ["x", "y", "z"]})
    table = both.dimension(spark, "k").collect()
    assert [r.k for r in table] == list(range(12)) and len({(r.a, r.b) for r in table}) == 12
    again = spark.createDataFrame(table).select("k", both.key(a=F.col("a"), b=F.col("b")).alias("again"))
    assert again.where("k <> again").count() == 0


def test_a_value_outside_its_vocabulary_has_no_key(spark):
    only = Combinations({"a": ["x"]})
    with pytest.raises(Exception, match="no a in the vocabulary: q"):
        spark.createDataFrame([("q",)], "a string").select(only.key(a=F.col("a"))).collect()
    with pytest.raises(ValueError):
        only.key(b=F.col("a"))
    with pytest.raises(ValueError):
        Combinations({str(n): range(9) for n in range(6)})


def test_vocabularies_are_bounded(spark):
    df = spark.createDataFrame([(n % 5 or None,) for n in range(20)], "v long")
    assert vocabulary(df, "v") == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        vocabulary(df, "v", 3)


def test_flags_give_the_reports_of_the_columns(spark):
    star = entry.star_of(spark, SMALL)
    flags = profiles.order_flags(star)
    sales = profiles.flagged_sales(star, flags)
    assert not set(sales.columns) & set(flags.vocabularies)
    found = profiles.flag_sales(sales, flags, "device_type", "has_coupon").collect()
    want = star.order_totals.groupBy("device_type", F.col("coupon_code").isNotNull().alias("has_coupon")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("net_amount").alias("sales")
    ).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, want))


def test_profile_of_the_time_of_the_order(spark):
    customer = {"customer_id": 1, "birth_date": date(1990, 5, 1), "prefecture": "東京都"}
    other = {"customer_id": 2, "birth_date": None, "prefecture": "?", "email": "y"}
    days = [date(2019, 1, 1), date(2019, 1, 1), date(2025, 1, 1), date(2025, 2, 1)]
    orders = [{"order_id": n, "customer_id": 1, "order_date": d, "order_timestamp": datetime(d.year, 1, 1)} for n, d in enumerate(days)]
    orders.append({"order_id": 9, "customer_id": 2, "order_date": days[0], "order_timestamp": datetime(2019, 1, 1)})
    star = Star(raw_tables(
        spark, customers=[customer, other], orders=orders,
        products=[{"product_id": 1}], order_items=[
            {"order_id": o["order_id"], "product_id": 1, "quantity": 1, "unit_price": 5, "order_item_id": n} for n, o in enumerate(orders)
        ],
    ), AS_OF)
    bands = profiles.profiles(star)
    found = {r.order_id: (r.age_band, r.activity_level, r.region)
             for r in bands.with_values(profiles.profiled_orders(star, bands), "profile_key").collect()}
    assert found == {
        0: ("20代", "new", "関東"), 1: ("20代", "low", "関東"), 2: ("30代", "low", "関東"), 3: ("30代", "medium", "関東"),
        9: ("不明", "new", "不明"),
    }


def test_profiles_stay_within_their_combinations(spark):
    star = entry.star_of(spark, SMALL)
    bands = profiles.profiles(star)
    table = profiles.usage(profiles.profiled_orders(star, bands), bands, "profile_key")
    assert table.count() == bands.size == 7 * 5 * 10
    assert table.agg(F.sum("order_count")).first()[0] == star.order_totals.count()


def test_roles_share_one_calendar(spark):
    star = entry.star_of(spark, SMALL)
    view = roles.role_view(star.dim_date, "ship")
    assert all(name.startswith("ship_") for name in view.columns) and len(view.columns) == len(star.dim_date.columns)
    days = spark.createDataFrame([(date(2024, 1, 1), None)], "a date, b date")
    row = roles.with_roles(days, {"order": "a", "ship": "b"}, ["year_month", "is_holiday"]).first()
    assert (row.order_year_month, row.order_is_holiday, row.ship_year_month, row.ship_is_holiday) == ("2024-01", True, None, None)
    first = view.join(days.select("a"), F.col("ship_full_date") == F.col("a"), "left_semi")
    assert first.columns[0] == "ship_date_key"
