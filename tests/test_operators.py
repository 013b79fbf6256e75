from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal
from itertools import accumulate, combinations

import pytest
from pyspark.sql import functions as F

from starloom.operators import joins, pairs
from starloom.operators.checks import dangling, duplicates, null_counts, outside
from starloom.operators.paging import page, page_after
from starloom.operators.ranking import dense_index, running_total
from starloom.operators.shares import share_of_total


def test_dense_index_numbers_the_total_order(spark):
    rng = random.Random(1)
    values = [(rng.randint(0, 5), i) for i in range(2000)]
    rng.shuffle(values)
    frame = spark.createDataFrame(values, "a int, b int").repartition(7)
    got = {(r["a"], r["b"]): r["n"] for r in dense_index(frame, ["a", F.desc("b")], "n").collect()}
    want = {v: i for i, v in enumerate(sorted(values, key=lambda v: (v[0], -v[1])), 1)}
    assert got == want


def test_dense_index_of_nothing(spark):
    assert dense_index(spark.createDataFrame([], "a int"), ["a"], "n").collect() == []


def test_running_total_matches_a_sequential_sum(spark):
    rng = random.Random(2)
    # half of the rows share one value: the tie-break has to spread and order them
    values = [(i, Decimal(7) if i % 2 else Decimal(rng.randint(1, 99))) for i in range(1500)]
    frame = spark.createDataFrame(values, "id int, v decimal(12,2)").repartition(5)
    rows = running_total(frame, [F.desc("v"), F.asc("id")], "v", "place", "so_far", "whole").collect()
    ordered = sorted(values, key=lambda x: (-x[1], x[0]))
    sums = list(accumulate(v for _, v in ordered))
    got = {r["id"]: (r["place"], r["so_far"], r["whole"]) for r in rows}
    want = {i: (place, total, sums[-1]) for place, ((i, _), total) in enumerate(zip(ordered, sums), 1)}
    assert got == want


def brute_pairs(baskets, support):
    counts = Counter()
    for items in baskets.values():
        counts.update(combinations(sorted(items), 2))
    return {pair: n for pair, n in counts.items() if n >= support}


@pytest.mark.parametrize("support", [1, 2, 5, 10])
def test_co_occurrence_matches_all_pairs(spark, support):
    rng = random.Random(support)
    items = [f"i{n:02}" for n in range(40)]
    baskets = {b: set(rng.sample(items, rng.randint(1, 6))) for b in range(150)}
    # a few baskets with nearly everything: more of them than are set aside at low support
    baskets |= {1000 + b: set(rng.sample(items, 38)) for b in range(6)}
    rows = [(b, i) for b, group in baskets.items() for i in group]
    frame = spark.createDataFrame(rows, "basket bigint, item string")
    got = pairs.co_occurrence(frame, "basket", "item", support).collect()
    assert {(r["item_a"], r["item_b"]): r["pairs"] for r in got} == brute_pairs(baskets, support)


def test_co_occurrence_when_every_shared_basket_is_wide(spark):
    """Items together only in the widest baskets stay below the threshold by one."""
    rows = [(b, i) for b in range(3) for i in ("x", "y", "z")] + [(9, "x"), (10, "y"), (11, "x")]
    frame = spark.createDataFrame(rows, "basket int, item string")
    assert pairs.co_occurrence(frame, "basket", "item", 4).collect() == []
    assert len(pairs.co_occurrence(frame, "basket", "item", 3).collect()) == 3


@pytest.mark.parametrize("support", [1, 3])
def test_wide_baskets_are_joined_in_blocks(spark, monkeypatch, support):
    monkeypatch.setattr(pairs, "BLOCK", 8)
    baskets = {b: {f"i{(b * 7 + k * k) % 60}" for k in range(40)} for b in range(12)}
    frame = spark.createDataFrame([(b, i) for b, items in baskets.items() for i in items], "basket bigint, item string")
    got = pairs.co_occurrence(frame, "basket", "item", support).collect()
    assert {(r["item_a"], r["item_b"]): r["pairs"] for r in got} == brute_pairs(baskets, support)


def test_page_after_goes_on_behind_the_last_row(spark):
    frame = spark.range(23).withColumn("k", F.col("id") % 3)
    seen, last = [], None
    while rows := page_after(frame, ["k", "id"], last, 7).collect():
        seen += [(r["k"], r["id"]) for r in rows]
        last = (rows[-1]["k"], rows[-1]["id"])
    assert seen == sorted((i % 3, i) for i in range(23))


def test_left_key_lookup_keeps_unknown_and_empty_rows(spark):
    facts = spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, None), (5, 10)], "id bigint, ref bigint")
    known = spark.createDataFrame([(10,), (11,)], "ref_key bigint")
    rows = joins.left_key_lookup(facts, known, "ref", "ref_key", "id").collect()
    assert {r["id"]: r["ref_key"] for r in rows} == {1: 10, 2: None, 3: None, 4: None, 5: 10}


def test_left_key_lookup_hashes_the_salt(spark):
    """The salt must be part of the join keys, or all empty keys meet in one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(100).selectExpr("id", "IF(id % 2 = 0, id, NULL) AS ref")
        known = spark.range(10).select(F.col("id").alias("ref_key"))
        plan = joins.left_key_lookup(facts, known, "ref", "ref_key", "id")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert len(exchanges) >= 2 and all("_salt" in line or "_s#" in line for line in exchanges)


def test_small_or_plain_checks_the_size(spark):
    small = joins.small_or_plain(spark.range(5), max_rows=5)
    large = joins.small_or_plain(spark.range(6), max_rows=5)
    hint = "ResolvedHint"
    assert hint in small._jdf.queryExecution().analyzed().toString()
    assert hint not in large._jdf.queryExecution().analyzed().toString()
    assert small.count() == 5 and large.count() == 6


def test_pages_cover_the_result_once(spark):
    frame = spark.range(23).withColumn("k", F.col("id") % 3)
    seen = []
    total = None
    for number in (1, 2, 3, 4):
        result = page(frame, ["k", "id"], number, 7, total)
        total = result.total_rows
        seen += [(r["k"], r["id"]) for r in result.rows.collect()]
    assert seen == sorted((i % 3, i) for i in range(23))
    assert (result.total_pages, total) == (4, 23)
    assert page(frame.limit(0), ["id"], 1, 7).total_pages == 1
    with pytest.raises(ValueError):
        page(frame, ["id"], 0, 7)


def test_share_of_total(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2), ("c", 0)], "k string, n bigint")
    rows = frame.withColumn("pct", share_of_total("n")).collect()
    assert {r["k"]: r["pct"] for r in rows} == {"a": 33.3, "b": 66.7, "c": 0.0}
    nothing = frame.where("n = 0").withColumn("pct", share_of_total("n")).first()
    assert nothing["pct"] is None


def test_generic_checks(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "d")], "id bigint, v string")
    assert [tuple(r) for r in duplicates(frame, ["id"]).collect()] == [(1, 2)]
    assert {r["column_name"]: r["null_rows"] for r in null_counts(frame, ["id", "v"]).collect()} == {"id": 2, "v": 1}
    parent = spark.createDataFrame([(1,)], "k bigint")
    assert [tuple(r) for r in dangling(frame, "id", parent, "k").collect()] == [(2, 1)]
    assert {r["v"] for r in outside(frame, "v", ["a", "b"]).collect()} == {"c", "d"}


def test_partitions_of_a_shuffle_are_bounded_by_size(spark):
    """Not by the number of shuffle partitions of the session, which does not grow with the input."""
    keys = spark.range(10_000_000).select(F.xxhash64("id").alias("key")).groupBy("key").count()
    assert keys.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_members_are_those_of_a_semi_join_and_facts_stay_where_they_are(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e")], "id long, note string")
    dimension = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    for used in (None, facts.select("id")):
        found = joins.members(facts, dimension, "id", used)
        assert sorted(r.note for r in found.collect()) == ["a", "b", "c"]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("few", [True, False])
def test_lookup_by_the_absent_values(spark, monkeypatch, few):
    """The rows of a salted lookup, whether few values are absent or many."""
    if not few:
        monkeypatch.setattr(joins, "SMALL_ROWS", 0)
    facts = spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, None), (5, 10)], "id bigint, ref bigint")
    known = spark.createDataFrame([(10,), (11,)], "ref_key bigint")
    found = joins.known_or_null(facts, known, "ref", "ref_key", "id", facts.select("ref"))
    assert {r["id"]: (r["ref"], r["ref_key"]) for r in found.collect()} == {
        1: (10, 10), 2: (None, None), 3: (99, None), 4: (None, None), 5: (10, 10)
    }
    assert found.columns == joins.left_key_lookup(facts, known, "ref", "ref_key", "id").columns


def test_missing_keys_are_found_without_a_broadcast_of_the_parent(spark):
    child, parent = spark.range(100).withColumnRenamed("id", "k"), spark.range(50)
    found = dangling(child, "k", parent, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and found.count() == 50
