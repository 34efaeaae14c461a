"""What a load moves: plans and steps whose bytes a line must not grow."""

import re

import pytest
from pyspark.sql import functions as F

from starmart import adapters as A
from starmart.operators.extract import extract_orders, small_tables
from starmart.operators.facts import Balance, Lookup, _in_join_order, fact_rejects, same
from starmart.plans import pipelines as P
from starmart.session import scratch_path
from starmart.sources.store import Warehouse

from test_plans import exchanges, no_broadcast, plan

SF = "/root/testdata/sf0.001"


@pytest.fixture
def extract_plan(spark):
    """Without adaptive execution, so that the plan shows which exchanges are shared."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with no_broadcast(spark):
            yield plan(extract_orders(A.order_system(spark, SF)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_both_catalogs_share_the_pairs_of_the_order_lines(extract_plan):
    scans = re.findall(r"ReadSchema: struct<([^>]*l_partkey[^>]*)>", extract_plan)
    assert sorted(s.count(",") for s in scans) == [1, 3]
    assert "ReusedExchange" in extract_plan


def test_customers_and_companies_join_after_the_item(extract_plan):
    """Rows go by item without names, and a customer's rows leave the extract together."""
    blocks = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hash\w+\((\w+)#", extract_plan)
    (by_item,) = [cols for cols, key in blocks if key == "suppliers_catalog_id"]
    assert "full_name" not in by_item and "company_name" not in by_item
    (by_customer,) = [cols for cols, key in blocks if key == "customer_id"]
    assert "product_name" in by_customer and "full_name" not in by_customer


def staged_rows(spark):
    rows = [(i, i % 10 if i % 7 else None, f"text {i}") for i in range(100)]
    return spark.createDataFrame(rows, "id int, k bigint, more string")


def versions(spark):
    ends = F.when(F.col("k") == 4, F.lit("2024-01-01")).cast("timestamp_ntz")
    known = spark.range(8).select(F.col("id").alias("k"), (F.col("id") + 50).alias("sk_d"))
    return known.withColumn("end_date", ends)


@pytest.mark.parametrize("few", [True, False])
def test_rejects_of_a_large_dimension_are_found_by_their_keys(spark, monkeypatch, few):
    """NULL keys, closed versions and unknown keys are rejected; the rows themselves stay put."""
    if not few:
        monkeypatch.setattr("starmart.operators.facts.BROADCAST_KEYS", 1)
    staged, lookup = staged_rows(spark), Lookup(versions(spark), "sk_d", same("k"))
    found = fact_rejects(staged, [lookup], Balance())
    want = [r["id"] for r in staged.collect() if r["k"] is None or r["k"] in (4, 8, 9)]
    assert sorted(r["id"] for r in found.collect()) == want
    assert found.columns == [*staged.columns, "missing"]
    with no_broadcast(spark):
        assert (exchanges(plan(fact_rejects(staged, [lookup], Balance()))) == 0) == few


def test_orders_of_a_bounded_load_are_read_once(spark):
    """The source's own joins run once, not again for the items ordered and the hot keys."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    src = A.order_system(spark, SF)
    read = spark.sparkContext.accumulator(0)

    def counted(rows):
        for batch in rows:
            read.add(batch.num_rows)
            yield batch

    early = src["orders"].filter("order_date < '1999-01-01'")
    P.run_orders(wh, src.replaced(orders=early), "2024-01-01 00:00:00")
    orders = src["orders"].mapInArrow(counted, src["orders"].schema)
    P.run_orders(wh, src.replaced(orders=orders), "2024-02-01 00:00:00", find_hot=True)
    assert read.value == src["orders"].count() == wh.table("fact_orders").count()


def test_months_apart_are_loaded_again_in_one_go(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    src = A.order_system(spark, SF)
    month = F.date_format("order_date", "yyyy-MM")
    gone = ["1999-02", "1999-03", "2000-05"]
    P.run_orders(wh, src.replaced(orders=src["orders"].filter(~month.isin(gone))), "2024-01-01 00:00:00")
    loads = wh.version("fact_orders")
    assert P.reconcile_orders(wh, src, "2024-02-01 00:00:00") == gone
    assert wh.version("fact_orders") == loads + 1
    assert wh.table("fact_orders").count() == src["orders"].count()
    assert P.months_to_reload(wh, src).count() == 0


def shuffled_by(text: str, key: str) -> list[str]:
    """The columns of each exchange by ``key``."""
    blocks = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hash\w+\((\w+)#", text)
    return [cols for cols, by in blocks if by == key]


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("bounds", [{}, {"high_water": "1999-01-01 00:00:00"}])
def test_no_shuffle_carries_the_names_of_small_tables(spark, bounds):
    src = A.order_system(spark, SF)
    small = small_tables(src)
    assert small == {"companies", "suppliers"}
    with no_broadcast(spark):
        text = plan(extract_orders(src, **bounds, small=small))
    blocks = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
    assert blocks and not [b for b in blocks if "supplier_name" in b or "company_name" in b]
    assert rows_of(extract_orders(src, **bounds, small=small)) == rows_of(extract_orders(src, **bounds))


def test_many_names_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("starmart.operators.extract.BROADCAST_ROWS", 24)
    assert "companies" not in small_tables(A.order_system(spark, SF))


def test_an_increment_moves_the_catalog_once_and_without_names(spark):
    src, mark = A.order_system(spark, SF), "1999-01-01 00:00:00"
    with no_broadcast(spark):
        text = plan(extract_orders(src, mark))
    assert "LeftSemi" not in text
    assert len(shuffled_by(text, "_item")) == 1 and "name" not in shuffled_by(text, "_item")[0]
    (by_product,) = [c for c in shuffled_by(text, "product_id")]
    assert "order_price" in by_product and "catalog_price" not in by_product
    whole = extract_orders(src).filter(F.col("order_date") > F.lit(mark).cast("timestamp_ntz"))
    assert rows_of(extract_orders(src, mark)) == rows_of(whole)


def test_customers_meet_orders_before_their_lines(spark):
    with no_broadcast(spark):
        text = plan(A.order_system(spark, SF, lines_last=True)["orders"])
    (by_customer,) = shuffled_by(text, "o_custkey")
    assert "l_" not in by_customer
    usual = A.order_system(spark, SF)["orders"]
    assert rows_of(A.order_system(spark, SF, lines_last=True)["orders"]) == rows_of(usual)


def test_customers_are_the_first_large_dimension_looked_up(spark):
    dims = {f"dim_{n}": spark.range(1) for n in ("company", "supplier", "product", "customer")}
    how = Balance(frozenset({"sk_company"}))
    found = [lk.label for _, lk in _in_join_order(P.order_lookups(dims), how)]
    assert found == ["company", "customer", "product", "supplier"]


def test_orders_are_stored_only_where_they_are_read_twice(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    src = A.order_system(spark, SF)
    early = src["orders"].filter("order_date < '1999-01-01'")
    P.run_orders(wh, src.replaced(orders=early), "2024-01-01 00:00:00")
    P.run_orders(wh, src, "2024-02-01 00:00:00")
    P.reprocess_orders(wh, src, "2000-01-01 00:00:00", "2000-01-31 00:00:00", "2024-03-01 00:00:00")
    assert wh.version("stg_source_orders") == 0
    assert wh.table("fact_orders").count() == src["orders"].count()
