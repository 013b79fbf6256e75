from __future__ import annotations

import pytest
from tables import SMALL

import __spark_entry__ as entry
from starloom.plans import quality, warehouse
from starloom.plans.reports import customers, inventory, products, sales, traffic


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    star = entry.star_of(spark, SMALL)
    return star, *warehouse.build(star, str(tmp_path_factory.mktemp("warehouse")))


def test_all_25_tables_are_written_with_their_counts(built):
    _, tables, counts = built
    assert len(counts) == 25
    for name in ("fact_sales", "dim_customer", "stg_orders", "int_product_abc"):
        assert tables.model(name).count() == counts[name] > 0


def test_reports_continue_from_the_files(spark, built):
    star, _, _ = built
    fresh = entry.star_of(spark, SMALL)
    for report in (sales.monthly_sales_profit, products.abc_analysis):
        assert report(star).collect() == report(fresh).collect()
    assert "warehouse" in star.dim_product.inputFiles()[0]


def test_later_sessions_report_from_the_files(spark, built):
    star, tables, _ = built
    reopened = tables.star(entry.AS_OF, entry.BANDS)
    for report in (sales.order_line_rollup, products.top_products, customers.top_ltv_customers, traffic.session_conversion,
                   inventory.sales_vs_stock):
        result = report(reopened)
        assert result.collect() == report(star).collect()
        assert all("/warehouse" in name for name in result.inputFiles() if "shared" not in name)
    for report in (sales.monthly_sales, sales.weekday_pattern, products.category_sales, customers.region_sales,
                   products.abc_analysis, products.cross_sell):
        read = report(reopened).inputFiles()
        assert not any("stg_order" in name or "int_orders" in name for name in read)


def test_sql_users_find_tables_and_views(spark, built):
    _, tables, counts = built
    assert "dwh.fact_sales" in tables.register("dwh")
    tables.register("dwh")  # again: replaces the entries, keeps the data
    rows = spark.sql(
        "SELECT d.year, sum(f.net_amount) AS net FROM dwh.fact_sales f JOIN dwh.dim_date d USING (date_key) GROUP BY d.year"
    ).collect()
    assert len(rows) == 7
    tables.create_views("v_")
    assert spark.sql("SELECT count(*) AS n FROM v_dim_product").first()["n"] == counts["dim_product"]
    spark.sql("DROP DATABASE dwh CASCADE")


def test_summary_on_written_tables_finds_only_the_funnel(built):
    _, tables, _ = built
    failing = {r["check_name"] for r in quality.summary(tables).where("failing_rows > 0").collect()}
    assert failing == {"funnel_consistency"}


def test_a_failed_build_leaves_the_old_one(spark, tmp_path):
    from pyspark.sql import functions as F
    from tables import AS_OF, raw_tables

    from starloom.plans.star import Star

    def star(status):
        orders = [{"order_id": 1, "customer_id": 1, "status": status}]
        return Star(raw_tables(spark, customers=[{"customer_id": 1}], orders=orders), AS_OF)

    def statuses():
        return [r.status_code for r in warehouse.Warehouse(spark, str(tmp_path)).model("dim_order_status").collect()]

    folders = lambda: {p.name for p in tmp_path.iterdir() if p.is_dir()}
    with pytest.raises(FileNotFoundError):
        warehouse.Warehouse(spark, str(tmp_path))
    warehouse.build(star("old"), str(tmp_path))
    reader = warehouse.Warehouse(spark, str(tmp_path))
    broken = star("new")
    broken.rebind(fact_inventory_daily=broken.fact_inventory_daily.withColumn("days_of_supply", F.raise_error(F.lit("no")).cast("double"))
                  .unionByName(spark.range(1).select(*[F.raise_error(F.lit("no")).cast(f.dataType).alias(f.name) for f in broken.fact_inventory_daily.schema])))
    with pytest.raises(Exception, match="no"):
        warehouse.build(broken, str(tmp_path))
    assert statuses() == ["old"] and folders() == {reader.build_name}
    warehouse.build(star("new"), str(tmp_path))
    assert statuses() == ["new"]
    assert [r.status_code for r in reader.model("dim_order_status").collect()] == ["old"]
    warehouse.build(star("third"), str(tmp_path))
    assert statuses() == ["third"] and reader.build_name not in folders()


def test_joins_of_a_build_are_not_chosen_by_the_size_of_files(spark, tmp_path, monkeypatch):
    """Packed ids would make tables of millions of rows look small enough for the driver."""
    bound = "spark.sql.autoBroadcastJoinThreshold"
    before, seen, write = spark.conf.get(bound), {}, warehouse._write

    def watched(df, path, *rest):
        name = path.rsplit("/", 1)[-1]
        seen[name] = (spark.conf.get(bound), df._jdf.queryExecution().executedPlan().toString())
        return write(df, path, *rest)

    monkeypatch.setattr(warehouse, "_write", watched)
    warehouse.build(entry.star_of(spark, SMALL), str(tmp_path))
    assert {b for b, _ in seen.values()} == {"-1"} and spark.conf.get(bound) == before
    for name in ("int_orders_with_items", "dim_customer", "int_inventory_with_sales"):
        assert "Broadcast" not in seen[name][1]
    for name, moved in (("fact_sales", 2), ("fact_inventory_daily", 0)):  # both sides of the join with products
        assert seen[name][1].count("hashpartitioning(product_id") == moved


def test_amounts_are_not_moved_into_the_layout(spark):
    star = entry.star_of(spark, SMALL)
    for name in ("int_orders_with_items", "fact_sales"):
        rows, add = star.narrow(name)
        assert not {"net_amount", "gross_profit"} & set(rows.columns)
        table = entry.star_of(spark, SMALL).model(name)
        assert add(rows).schema == table.schema
        assert add(rows).exceptAll(table).isEmpty() and rows.count() == table.count() > 0


def test_metrics_from_written_lines_are_those_from_the_sources(spark, tmp_path):
    """Lines of unknown customers and products, orders without date, status or lines."""
    from tables import AS_OF, raw_tables

    from starloom.plans.star import Star

    day = AS_OF.replace(year=2024)
    heads = [(1, 1, day, "shipped"), (2, 1, day.replace(month=1), "cancelled"), (3, 2, None, "shipped"), (4, 2, day, None), (5, 9, day, "shipped"), (6, 1, day, "shipped")]
    orders = [{"order_id": o, "customer_id": c, "order_date": d, "status": s} for o, c, d, s in heads]
    lines = [(1, 1, 7), (2, 1, 8), (3, 2, 7), (4, 3, 7), (5, 4, 7), (6, 5, 7), (7, 5, 8)]
    items = [{"order_item_id": i, "order_id": o, "product_id": p, "quantity": i, "unit_price": "2.50", "discount": 10} for i, o, p in lines]

    def star():
        return Star(raw_tables(spark, customers=[{"customer_id": 1}, {"customer_id": 2}], products=[{"product_id": 7}], orders=orders, order_items=items), AS_OF)

    def rows(frame):
        return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=str)

    built = star()
    warehouse.build(built, str(tmp_path))
    assert rows(built.customer_metrics) == rows(star().customer_metrics)
