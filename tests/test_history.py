from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tables import SMALL

import __spark_entry__ as entry
from starloom.functions.amounts import rounded_ratio
from starloom.operators.as_of import as_of
from starloom.plans import intermediate as logic
from starloom.plans import monthly as months
from starloom.plans.history import FOREVER, History, previous_value
from starloom.plans.monthly import KEYS, MEASURES, MonthlySales, by_month, delta
from starloom.sources import pointer

DAYS = [date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1), date(2024, 4, 1)]


def loads(seed):
    """Four states of up to 30 members: (city, rank) or absent, often unchanged."""
    rng = random.Random(seed)
    state: dict = {}
    for _ in DAYS:
        for member in range(30):
            if rng.random() < 0.4:
                state[member] = None if rng.random() < 0.3 else (rng.choice(["a", "b", None]), rng.choice([1, None]))
        yield {m: s for m, s in state.items() if s}


def expected(states):
    """(member, city, rank, from, to) of all versions by walking through the loads."""
    out = []
    for member in range(30):
        was = None
        for day, state in zip(DAYS, states):
            now = state.get(member)
            if now != was:
                if was is not None:
                    out[-1] = (*out[-1][:4], day)
                if now is not None:
                    out.append((member, *now, day, FOREVER))
            was = now
    return out


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    history, states = History(spark, str(tmp_path_factory.mktemp("history")), "id", ["city", "rank"]), list(loads(1))
    added = []
    for day, state in zip(DAYS, states):
        frame = spark.createDataFrame([(m, *s) for m, s in state.items()], "id long, city string, rank int")
        added.append(history.apply(frame, day))
    return history, states, added


def test_versions_equal_a_walk_through_the_loads(filled):
    history, states, added = filled
    rows = history.dimension().collect()
    found = [(r.id, r.city, r.rank, r.valid_from, r.valid_to) for r in rows]
    assert sorted(found, key=str) == sorted(expected(states), key=str)
    assert {r.id for r in rows if r.is_current} == set(states[-1])
    keys = [r.version_key for r in history.versions().collect()]
    assert sorted(keys) == list(range(1, sum(added) + 1))


def test_no_overlap_no_gap_but_where_a_member_was_gone(filled):
    history, states, _ = filled
    spans: dict = {}
    for r in sorted(history.dimension().collect(), key=lambda r: (r.id, r.valid_from)):
        assert r.valid_from < r.valid_to
        spans.setdefault(r.id, []).append((r.valid_from, r.valid_to))
    for member, own in spans.items():
        for (_, end), (begin, _) in zip(own, own[1:]):
            assert begin >= end
            absent = [d for d, state in zip(DAYS, states) if end <= d < begin]
            assert all(member not in states[DAYS.index(d)] for d in absent)


def test_unchanged_members_are_written_nowhere(spark, filled):
    history, states, added = filled
    again = spark.createDataFrame([(m, *s) for m, s in states[-1].items()], "id long, city string, rank int")
    before = [load["folder"] for load in history.loads()]
    assert history.apply(again, date(2024, 5, 1)) == 0
    assert [load["folder"] for load in history.loads()][:-1] == before
    with pytest.raises(ValueError):
        history.apply(again, date(2024, 5, 1))


def test_a_failed_load_leaves_the_history_as_it_was(spark, filled):
    history, _, _ = filled
    before = sorted(map(tuple, history.dimension().collect()), key=str)
    broken = spark.range(5).select(F.col("id"), F.raise_error(F.lit("no")).cast("string").alias("city"), F.lit(1).alias("rank"))
    with pytest.raises(Exception, match="no"):
        history.apply(broken, date(2024, 6, 1))
    assert sorted(map(tuple, history.dimension().collect()), key=str) == before


def test_previous_value_is_the_last_different_one(spark, tmp_path):
    history = History(spark, str(tmp_path), "id", ["city", "rank"])
    states = [
        {1: ("a", 1), 2: ("a", 1), 3: (None, 1), 4: ("a", 1)},
        {1: ("b", 1), 2: ("a", 2), 3: ("c", 1), 4: ("a", 1)},
        {1: ("a", 1), 2: ("a", 3), 3: ("c", 2)},
    ]
    for day, state in zip(DAYS, states):
        history.apply(spark.createDataFrame([(m, *s) for m, s in state.items()], "id long, city string, rank int"), day)
    rows = {r.id: (r.current_city, r.previous_city, r.has_previous) for r in previous_value(history, "city").collect()}
    assert rows == {1: ("a", "b", True), 2: ("a", None, False), 3: ("c", None, True)}


def test_as_of_equals_between(spark):
    """A third of all events on one key, ties in time, events before any version, keys without versions, nulls."""
    rng = random.Random(2)
    day = lambda n: date(2024, 1, 1) + timedelta(n)
    versions = [(k, day(n), k * 1000 + n) for k in range(20) for n in sorted(rng.sample(range(5, 100), 4))]
    versions += [(99, day(n), 99_000 + n) for n in range(0, 100, 3)]
    events = [(i, 99 if i % 3 == 0 else rng.choice([*range(25), None]), rng.choice([None, *map(day, range(110))])) for i in range(3000)]
    e = spark.createDataFrame(events, "event long, k long, day date")
    v = spark.createDataFrame(versions, "k long, since date, version long")
    found = as_of(e, v, "k", "day", "since", ["version"])
    want = {}
    for i, k, at in events:
        own = [(s, x) for key, s, x in versions if key == k and at is not None and s <= at]
        want[i] = max(own)[1] if own else None
    rows = found.collect()
    assert {r.event: r.version for r in rows} == want and len(rows) == len(events)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_hot_key_fills_several_ranges(spark, monkeypatch):
    from starloom.operators import as_of as module

    seen = {}
    original = module.in_ranges
    monkeypatch.setattr(module, "in_ranges", lambda *a: seen.setdefault("ranges", original(*a)))
    events = spark.range(20_000).select(F.col("id").alias("event"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                        F.lit(date(2024, 1, 2)).alias("day"))
    versions = spark.createDataFrame([(7, date(2024, 1, 1), 1)], "k long, since date, version long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data would be put together
    try:
        found = as_of(events, versions, "k", "day", "since", ["version"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found.where("k = 7 AND version = 1").count() == found.where("k = 7").count()
    assert seen["ranges"].where("_key = 7").select("_range").distinct().count() > 1


LINES = "order_id long, product_id long, order_date date, quantity long, net_amount decimal(33,6), discount_rate decimal(5,2)"


def lines(spark, rng, n, months=(1, 2, 3, 4)):
    rows = [(i, rng.randint(1, 5), date(2024, rng.choice(months), rng.randint(1, 28)), rng.randint(1, 9), Decimal(rng.randint(1, 9999)) / 100,
             rng.choice([None, Decimal("5.00")])) for i in range(n)]
    return spark.createDataFrame(rows, LINES)


def table(df):
    return sorted(tuple(r) for r in df.select(*KEYS, *MEASURES).collect())


def test_deltas_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(5)
    first, late = lines(spark, rng, 200), lines(spark, rng, 20, (3, 6))
    monthly = MonthlySales(spark, str(tmp_path))
    assert monthly.apply("first", by_month(first)) == [202401, 202402, 202403, 202404]
    quiet = monthly.table(202401, 202401).inputFiles()
    assert monthly.apply("late", delta(late)) == [202403, 202406]
    assert monthly.apply("late", delta(late)) == []  # a batch counts once
    assert monthly.table(202401, 202401).inputFiles() == quiet  # other months are not rewritten
    wrong = first.where("product_id = 2")
    right = wrong.withColumn("quantity", F.col("quantity") + 1).withColumn("order_date", F.date_add("order_date", 31))
    monthly.apply("moved", delta(right, wrong))
    whole = first.where("product_id <> 2").unionByName(right).unionByName(late)
    assert table(monthly.table()) == table(by_month(whole))
    monthly.apply("none left", delta(whole.limit(0), whole))
    assert monthly.table().count() == 0 and MonthlySales(spark, str(tmp_path)).table(209901, 209912).count() == 0


def test_a_batch_writes_only_what_it_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(months, "LAYERS", 3)
    rng, monthly, whole = random.Random(8), MonthlySales(spark, str(tmp_path)), None
    for number in range(6):
        some = lines(spark, rng, 30 if number else 200, (1, 2))
        whole = some if whole is None else whole.unionByName(some)
        before = set(monthly.table().inputFiles()) if number else set()
        monthly.apply(f"batch {number}", delta(some))
        folders = monthly._state()["months"]
        assert {len(f) for f in folders.values()} == {number % 3 + 1}  # written anew instead of a fourth folder
        assert number % 3 == 0 or before < set(monthly.table().inputFiles())
        assert table(monthly.table()) == table(by_month(whole))
    totals = monthly.product_totals().select("product_id", *MEASURES)
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, logic.product_totals(whole).select(*totals.columns).collect()))


def test_no_lines_give_an_empty_aggregate(spark, tmp_path):
    monthly, none = MonthlySales(spark, str(tmp_path)), lines(spark, random.Random(1), 0)
    assert monthly.apply("first", by_month(none)) == []
    assert monthly.table().count() == monthly.product_totals().count() == 0


def test_only_ranked_reports_rank_the_products(spark):
    star = entry.star_of(spark, SMALL)
    star.rebind_product_totals(star.product_totals)
    assert "product_ranking" not in star.__dict__
    want = {r.product_id: r.abc_rank for r in entry.star_of(spark, SMALL).ranked_totals.collect()}
    assert {r.product_id: r.abc_rank for r in star.ranked_totals.collect()} == want


def test_a_failed_batch_changes_nothing(spark, tmp_path):
    monthly = MonthlySales(spark, str(tmp_path))
    first = lines(spark, random.Random(6), 50)
    monthly.apply("first", by_month(first))
    before = table(monthly.table())
    broken = by_month(first.withColumn("quantity", F.raise_error(F.lit("no")).cast("long")))
    with pytest.raises(Exception, match="no"):
        monthly.apply("broken", broken)
    assert table(monthly.table()) == before
    monthly.apply("second", by_month(first))
    assert monthly.table().agg(F.sum("line_count")).first()[0] == 100


def test_pointer_is_replaced_as_a_whole(spark, tmp_path):
    assert pointer.read(spark, str(tmp_path)) is None
    for state in ({"a": 1}, {"b": ["é", 2]}):
        pointer.swap(spark, str(tmp_path), state)
        assert pointer.read(spark, str(tmp_path)) == state
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["_current"]


@pytest.mark.parametrize(
    ("top", "bottom", "digits", "times", "want"),
    [("1934", "2", 2, 1, 967.0), ("193365", "200", 2, 1, 966.83), ("-1", "8", 2, 1, -0.13), ("1", "0", 1, 1, None), (None, "1", 1, 1, None),
     ("0.005", "1", 2, 1, 0.01), ("0.0049999", "1.0000001", 2, 1, 0.01), ("1", "3", 1, 100, 33.3), ("966824999999", "1000000000", 2, 1, 966.82)],
)
def test_ratios_round_once(spark, top, bottom, digits, times, want):
    frame = spark.createDataFrame([(top, bottom)], "a string, b string")
    parts = [F.col(c).cast("decimal(30,6)") for c in ("a", "b")]
    assert frame.select(rounded_ratio(*parts, digits, times)).first()[0] == want


def test_line_ids_stay_apart_from_line_number_ten_on(spark, tmp_path):
    from starloom.sources.retail import RetailTables

    columns = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(1)
    planted = columns.drop("l_orderkey", "l_linenumber").crossJoin(
        spark.createDataFrame([(o, n) for o in (1, 2) for n in range(1, 13)] + [(1, 11)], "l_orderkey long, l_linenumber long")
    ).select(*columns.columns)
    planted.write.parquet(f"{tmp_path}/lineitem.parquet")
    ids = [r[0] for r in RetailTables(spark, str(tmp_path)).table("order_items", ["order_item_id"]).collect()]
    assert len(set(ids)) == len(ids) == 25
