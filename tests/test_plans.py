"""Plans: what is pushed down, what is shuffled, what stays in the JVM."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from starmart import adapters as A
from starmart import schemas as S
from starmart.functions.useragent import classify_user_agent
from starmart.functions.weblog import LINE, parse_weblogs, readable
from starmart.operators.dimensions import fresh_rows
from starmart.operators.extract import extract_orders
from starmart.operators.facts import Balance, load_fact
from starmart.plans import pipelines as P
from starmart.plans import reports as R
from starmart.session import scratch_path
from starmart.sources.store import Warehouse

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def exchanges(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", text, re.M))


@contextlib.contextmanager
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def wh(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    P.run_orders(wh, A.order_system(spark, SF), "2024-01-01 00:00:00")
    P.run_logs(wh, A.weblog_lines(spark, SF), A.geo(spark, SF), "2024-01-01 00:00:00")
    return wh


def stored_source(spark):
    """The order tables as plain files, which the adapters' joins would hide."""
    src = A.order_system(spark, SF)
    folder = scratch_path(spark, "src")
    for name, frame in src.items():
        frame.write.parquet(f"{folder}/{name}")
    return type(src).from_parquet(spark, folder)


def test_log_lines_are_matched_once_and_in_the_jvm(spark):
    lines = spark.read.text("/root/testdata")
    df = classify_user_agent(readable(parse_weblogs(lines)))
    text = plan(df)
    assert "Python" not in text
    # All matching is in the one operator that cuts the line, and there only once.
    (generate,) = [block for block in text.split("\n\n") if re.match(r"\(\d+\) Generate", block)]
    assert text.count(LINE) == generate.count(LINE)
    assert generate.count("regexp_replace") == 1


def test_mark_and_date_reach_the_scan(spark):
    src = stored_source(spark)
    for df in (
        extract_orders(src, "2000-01-01 00:00:00"),
        extract_orders(src, start="2000-01-01 00:00:00", end="2000-02-01 00:00:00"),
    ):
        assert re.search(r"PushedFilters: .*\(order_date,2000-01-01", plan(df))


def test_the_extract_shuffles_orders_twice(spark):
    src = stored_source(spark)
    with no_broadcast(spark):
        joins = plan(extract_orders(src))
        whole = exchanges(joins)
    assert "Cartesian" not in joins and "NestedLoop" not in joins
    # Orders by company, customer and item, with the other side of each; the catalog and the
    # other side by supplier and product; the list prices, which share the order's shuffle.
    assert whole == 2 * 3 + 2 * 2 + 1


def test_one_exchange_finds_new_members(spark):
    staged = spark.range(10).select(F.col("id").cast("string").alias("m"))
    assert exchanges(plan(fresh_rows(staged, staged, ["m"], "except"))) == 1


def test_the_year_is_a_pushed_range(spark, wh):
    text = plan(R.sales_by_month(wh.table("fact_orders"), 2000))
    assert "GreaterThanOrEqual(order_date,2000-01-01" in text
    assert "LessThan(order_date,2001-01-01" in text
    assert "ReadSchema: struct<price:decimal(18,2),order_date:timestamp_ntz>" in text


def test_reports_rank_without_a_single_partition(spark, wh):
    frames = [
        R.top_devices(wh.table("fact_logs"), wh.table("dim_device")),
        R.sales_by_month_window(wh.table("fact_orders"), 2000),
        R.top_products_of_top_country(
            wh.table("fact_orders"),
            wh.table("fact_logs"),
            wh.table("dim_product"),
            wh.table("dim_country"),
        ),
    ]
    for df in frames:
        text = plan(df)
        assert "TakeOrderedAndProject" in text
        assert "SinglePartition" not in text


def test_log_rows_are_counted_before_the_dimension_is_joined(spark, wh):
    text = plan(R.top_devices(wh.table("fact_logs"), wh.table("dim_device")))
    assert "ReadSchema: struct<sk_device:bigint>" in text


def test_the_fact_load_reads_only_what_it_needs(spark, wh):
    dims = {d.name: wh.table(d.name) for d in S.ORDER_DIMENSIONS}
    staged = wh.table("stg_orders")
    how = Balance(frozenset({"sk_company"}), {("customer_id",): [1], ("product_id",): [2]})
    text = plan(load_fact(staged, P.order_lookups(dims), P.ORDER_FACT_COLUMNS, how))
    scan = re.findall(r"ReadSchema: (struct<.*order_price.*>)", text)
    assert scan and "full_name" not in scan[0] and "product_name" not in scan[0]


def test_skewed_joins_have_fresh_shuffles_on_both_sides(spark, wh):
    """The shape AQE can split: a sort over an exchange on either side of each join."""
    dims = {d.name: wh.table(d.name) for d in S.ORDER_DIMENSIONS}
    with no_broadcast(spark):
        df = load_fact(wh.table("stg_orders"), P.order_lookups(dims), P.ORDER_FACT_COLUMNS)
        text = plan(df)
    assert text.count("SortMergeJoin Inner (") == 4
    assert exchanges(text) == 8


def test_aqe_splits_a_hot_item_of_the_extract(spark):
    """Also below the join with the list prices, which reuses the shuffle by item."""
    src = stored_source(spark)
    item = src["orders"].first()["suppliers_catalog_id"]
    third = F.col("order_id") % 3 == 0
    hot = F.when(third, F.lit(item)).otherwise(F.col("suppliers_catalog_id"))
    folder = scratch_path(spark, "hot")
    orders = src["orders"].withColumn("suppliers_catalog_id", hot)
    for _ in range(3):
        orders = orders.unionAll(orders)
    orders.repartition(32).write.parquet(folder)
    df = extract_orders(src.replaced(orders=spark.read.parquet(folder)))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = df.collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(rows) == 8 * src["orders"].count()
    assert "SortMergeJoin(skew=true)" in final
    assert len(re.findall(r"SortMergeJoin\(skew=true\).*LeftOuter", final)) == 1


def test_monthly_writes_are_gathered_and_split_by_aqe(spark, wh):
    rows = wh.table("fact_orders").withColumn("m", F.date_format("order_date", "yyyy-MM"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(rows.hint("rebalance", F.col("m")))
