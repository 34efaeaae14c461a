"""Sums by month, and the reload of months that differ."""

import pytest
from datetime import timedelta

from pyspark.sql import functions as F

from starmart import adapters as A
from starmart.operators.sums import added, differing, month_sums
from starmart.plans import pipelines as P
from starmart.schemas import STAGED_ORDERS
from starmart.session import scratch_path
from starmart.sources.store import Warehouse

SF = "/root/testdata/sf0.001"
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def staged(spark, *rows):
    """Rows of (order_id, order_date, CUIT, customer_id); other columns are null."""
    frame = spark.createDataFrame(list(rows), "order_id long, d string, c long, u long")
    given = {"order_id": "order_id", "order_date": "d", "CUIT": "c", "customer_id": "u"}
    return frame.select(
        *[
            F.col(given.get(f.name, "_none")).cast(f.dataType).alias(f.name)
            if f.name in given
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in STAGED_ORDERS.fields
        ]
    )


def months(one, other):
    return sorted(tuple(r) for r in differing(month_sums(one), month_sums(other)).collect())


def test_sums_tell_what_differs(spark):
    rows = [(1, "2020-01-05", 7, None), (2, "2020-01-06", 7, 8), (3, "2020-02-01", 7, 8)]
    one = staged(spark, *rows)
    assert months(one, staged(spark, *rows[::-1]).repartition(5)) == []
    assert months(one, staged(spark, *rows, (4, None, 7, 8))) == []
    # the same order twice, and three times
    assert months(one, staged(spark, *rows, rows[2])) == [("2020-02", 1, 2)]
    assert months(staged(spark, *rows, *[rows[2]] * 2), one) == [("2020-02", 3, 1)]
    # a null in another column
    moved = [(1, "2020-01-05", None, 7), *rows[1:]]
    assert months(one, staged(spark, *moved)) == [("2020-01", 2, 2)]
    assert months(one, staged(spark, *rows[:2])) == [("2020-02", 1, 0)]
    empty = one.limit(0)
    assert months(empty, empty) == []
    assert months(empty, one) == [("2020-01", 0, 2), ("2020-02", 0, 1)]
    parts = added(month_sums(staged(spark, rows[0])), month_sums(staged(spark, *rows[1:])))
    assert differing(month_sums(one), parts).count() == 0


@pytest.fixture(scope="module")
def src(spark):
    return A.order_system(spark, SF)


def found(wh, src):
    return sorted(r.month for r in P.months_to_reload(wh, src).collect())


def test_loads_in_turn_keep_the_sums(spark, src):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    early = src.replaced(orders=src["orders"].filter("order_date < '1999-03-11'"))
    P.run_orders(wh, early, T1)
    assert found(wh, early) == []
    P.run_orders(wh, src, T2)
    assert found(wh, src) == []
    P.reprocess_orders(wh, src, "1999-02-01", "1999-04-30 23:59:59.999999", T3)
    assert found(wh, src) == []
    # a part of a month was exchanged: what the month holds isn't known
    P.reprocess_orders(wh, src, "1999-02-10", "1999-03-31 23:59:59.999999", T3)
    assert found(wh, src) == ["1999-02"]
    before = set(wh.table("fact_orders", ["order_month=1999-04"]).inputFiles())
    assert P.reconcile_orders(wh, src, T3) == ["1999-02"]
    assert found(wh, src) == []
    assert set(wh.table("fact_orders", ["order_month=1999-04"]).inputFiles()) == before
    P.run_orders(wh, src, T3, lookback=timedelta(days=40))
    assert len(found(wh, src)) <= 1
    P.reconcile_orders(wh, src, T3)
    assert found(wh, src) == [] and P.reconcile_orders(wh, src, T3) == []
    assert wh.table("fact_orders").count() == src["orders"].count()


def test_a_changed_price_and_a_lost_month_are_found(spark, src):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    P.run_orders(wh, src, T1)
    item = src["orders"].filter("order_date >= '2000-01-01'").first()
    catalog = src["suppliers_catalog"]
    dearer = F.col("suppliers_catalog_id") == item.suppliers_catalog_id
    changed = src.replaced(
        suppliers_catalog=catalog.withColumn(
            "price", F.when(dearer, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)")
        )
    )
    touched = {
        str(r.order_date)[:7]
        for r in src["orders"].filter(F.col("suppliers_catalog_id") == item.suppliers_catalog_id).collect()
    }
    assert set(found(wh, changed)) == touched
    without = src.replaced(orders=src["orders"].filter("date_format(order_date, 'yyyy-MM') <> '2000-05'"))
    assert found(wh, without) == ["2000-05"]
    assert P.reconcile_orders(wh, without, T2) == ["2000-05"]
    assert "order_month=2000-05" not in wh.slices("fact_orders")
    assert found(wh, without) == []


def test_only_sums_are_read_of_what_is_loaded(spark, src):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    P.run_orders(wh, src.replaced(orders=src["orders"].limit(50)), T1)
    files = P.months_to_reload(wh, src).inputFiles()
    assert [f for f in files if "/sums_orders/" in f]
    assert not [f for f in files if "/fact_orders/" in f or "/stg_orders/" in f]
