from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from tables import frame, raw_tables

from starloom.schemas import TABLES
from starloom.session import materialise, scratch_path, shared_dir
from starloom.sources.export import export, read_export
from starloom.sources.load import LoadError, audit, load_all, load_json_lines, load_table
from starloom.sources.raw import DatabaseTables, FileTables

PRODUCT = {"product_id": 1, "product_name": "käse", "category_id": 2, "unit_price": "12.34",
           "created_at": datetime(2025, 1, 2, 3, 4, 5), "is_active": True}


def test_load_replaces_and_counts(spark, tmp_path):
    first = raw_tables(spark, products=[PRODUCT, {**PRODUCT, "product_id": 2}])
    assert load_table(first, "products", str(tmp_path)).loaded == 2
    result = load_table(raw_tables(spark, products=[PRODUCT]), "products", str(tmp_path), chunk_rows=1)
    assert (result.extracted, result.loaded) == (1, 1)
    assert FileTables(spark, str(tmp_path)).table("products").first()["unit_price"] == Decimal("12.34")


def test_empty_source_empties_the_table(spark, tmp_path):
    load_table(raw_tables(spark, products=[PRODUCT]), "products", str(tmp_path))
    result = load_table(raw_tables(spark), "products", str(tmp_path))
    assert (result.extracted, result.loaded) == (0, 0)
    assert FileTables(spark, str(tmp_path)).table("products").count() == 0


def test_failing_table_does_not_stop_the_others(spark, tmp_path):
    raw = raw_tables(spark, products=[PRODUCT])
    raw.frames["orders"] = spark.range(3)  # lacks every declared column
    raw.frames["coupons"] = frame(spark, "coupons", []).selectExpr("* EXCEPT (coupon_id)", "'no number' AS coupon_id").union(
        spark.sql("SELECT 'c', 't', 1.00, 1.00, current_date(), current_date(), 'n', 'no number'")
    )
    with pytest.raises(LoadError, match="orders, coupons") as failed:
        load_all(raw, str(tmp_path))
    rows = {r["table_name"]: r for r in audit(spark, failed.value.results).collect()}
    assert list(rows) == list(TABLES)
    assert {name for name, r in rows.items() if not r["succeeded"]} == {"orders", "coupons"}
    assert rows["products"]["loaded"] == 1 and rows["orders"]["loaded"] is None


def test_json_lines_round_trip_keeps_types(spark, tmp_path):
    source = frame(spark, "products", [PRODUCT])
    source.write.json(str(tmp_path / "in"))
    loaded = load_json_lines(spark, str(tmp_path / "in"), "products", str(tmp_path / "out"))
    assert loaded.collect() == source.collect()


def test_bad_json_value_fails_the_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"product_id": "seven"}\n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        load_json_lines(spark, str(tmp_path / "in"), "products", str(tmp_path / "out"))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_file_formats(spark, tmp_path, fmt):
    source = frame(spark, "products", [PRODUCT, {**PRODUCT, "product_id": 2, "cost_price": "1.50"}])
    source.write.format(fmt).save(str(tmp_path / "products"))
    tables = FileTables(spark, str(tmp_path), fmt)
    assert sorted(tables.table("products").collect()) == sorted(source.collect())
    narrow = tables.table("products", ["product_id", "unit_price"])
    assert narrow.columns == ["product_id", "unit_price"]


def test_database_reads_by_key_range():
    tables = DatabaseTables(None, "jdbc:x", {"user": "u"}, {"orders": (1, 1000, 8)})
    options = tables.read_options("orders")
    assert options["partitionColumn"] == "order_id" and options["numPartitions"] == "8"
    assert "partitionColumn" not in tables.read_options("coupons")


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_export(spark, tmp_path, fmt):
    result = spark.createDataFrame([(1, "a,\"b\"", date(2025, 1, 1), None)], "n bigint, t string, d date, x double")
    export(result, str(tmp_path / fmt), fmt)
    export(result, str(tmp_path / fmt), fmt)  # replaces
    assert read_export(result, str(tmp_path / fmt), fmt).collect() == result.collect()
    with pytest.raises(ValueError):
        export(result, str(tmp_path / "x"), "xml")


def test_scratch_lives_in_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert scratch_path(spark, "a").startswith(configured) and scratch_path(spark, "a") != scratch_path(spark, "a")
    kept = materialise(spark.range(3), "t")
    assert configured in kept.inputFiles()[0] and kept.count() == 3


def test_compressed_export_reads_back(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string").coalesce(1)
    export(rows, str(tmp_path / "out"), "json", "gzip")
    assert [p.name.endswith(".json.gz") for p in (tmp_path / "out").glob("part-*")] == [True]
    assert sorted(map(tuple, read_export(rows, str(tmp_path / "out"), "json").collect())) == [(1, "a"), (2, None)]
