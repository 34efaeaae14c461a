"""Report views that follow the warehouse."""

import warnings

import pytest
from pyspark.sql import functions as F

from starmart import adapters as A
from starmart.plans import pipelines as P
from starmart.plans import reports as R
from starmart.session import scratch_path
from starmart.sources.store import Warehouse

SF = "/root/testdata/sf0.001"
T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def test_a_view_shows_each_load_and_outlives_expire(spark):
    root = scratch_path(spark, "wh")
    wh = Warehouse(spark, root)
    R.register_reports(spark, wh, 2000)
    assert spark.table("all_sales_by_month_2000").count() == 0
    src = A.order_system(spark, SF)
    half = src.replaced(orders=src["orders"].filter(F.month("order_date") < 4))
    half = half.replaced(orders=half["orders"].filter("order_date < '2000-12-31'"))
    P.run_orders(wh, half, T1)
    assert [r.month for r in spark.table("all_sales_by_month_2000").collect()] == [1, 2, 3]
    # through another object of the same folder
    other = Warehouse(spark, root + "/")
    P.reprocess_orders(other, src, "2000-04-01 00:00:00", "2000-05-31 23:59:59", T2)
    other.expire("fact_orders")
    assert [r.month for r in spark.table("all_sales_by_month_2000").collect()] == [1, 2, 3, 4, 5]
    wh.unfollow("view all_sales_by_month_2000")


def test_followers_see_their_tables_only_and_never_fail_a_load(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    rows = spark.sql("select 'a' as company_name")
    rows = rows.selectExpr(
        "cast(null as timestamp_ntz) contact_date", "company_name", "company_name contact_name",
        "company_name lead_source", "company_name status",
    )
    seen = []
    wh.follow("x", ["stg_leads"], lambda now: seen.append(now.version("stg_leads")))
    wh.overwrite("stg_leads", rows)
    wh.clear("stg_orders")
    wh.append("stg_leads", rows)
    assert seen == [0, 1, 2]

    def fail(now):
        if now.version("stg_leads") > 2:
            raise OSError("gone")

    wh.follow("x", ["stg_leads"], fail)
    with pytest.warns(UserWarning, match="gone"):
        wh.append("stg_leads", rows)
    assert wh.table("stg_leads").count() == 3
    wh.unfollow("x")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        wh.append("stg_leads", rows)
