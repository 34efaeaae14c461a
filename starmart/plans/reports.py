"""Reports on the facts, and their registration as views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.functions.literals import wall_clock
from starmart.operators.dimensions import current
from starmart.schemas import MONEY
from starmart.sources.store import Warehouse

# Sums of MONEY values.
_TOTAL = "decimal(28,2)"
_PRODUCT_TABLES = ("fact_orders", "fact_logs", "dim_product", "dim_country")


def _sales_of_year(fact_orders: DataFrame, year: int) -> DataFrame:
    """The year as a date range, which reaches the scan; ``year(x) = y`` would not."""
    return fact_orders.filter(
        (F.col("order_date") >= wall_clock(f"{year}-01-01 00:00:00"))
        & (F.col("order_date") < wall_clock(f"{year + 1}-01-01 00:00:00"))
    ).select("order_date", F.col("price").cast(MONEY).alias("price"))


def sales_by_month(fact_orders: DataFrame, year: int = 2021, n: int = 12) -> DataFrame:
    """Sum of prices per month of a year: ``month, year, sum_of_sales``."""
    return (
        _sales_of_year(fact_orders, year)
        .groupBy(F.month("order_date").alias("month"), F.year("order_date").alias("year"))
        .agg(F.sum("price").cast(_TOTAL).alias("sum_of_sales"))
        .orderBy("month")
        .limit(n)
    )


def sales_by_month_window(fact_orders: DataFrame, year: int = 2021, n: int = 12) -> DataFrame:
    """The same report as a window sum.

    The window runs over one subtotal per day, so a month is at most 31 rows, not all its sales.
    """
    days = (
        _sales_of_year(fact_orders, year)
        .groupBy(F.to_date("order_date").alias("day"))
        .agg(F.sum("price").alias("day_sales"))
    )
    month, yr = F.month("day"), F.year("day")
    return (
        days.select(
            month.alias("month"),
            yr.alias("year"),
            F.sum("day_sales").over(Window.partitionBy(month, yr)).cast(_TOTAL).alias(
                "sum_of_sales"
            ),
        )
        .distinct()
        .orderBy("month")
        .limit(n)
    )


def top_devices(fact_logs: DataFrame, dim_device: DataFrame, n: int = 5) -> DataFrame:
    """Devices with most log rows. Rows are counted per key before the dimension is joined."""
    members = ["device", "is_mobile", "is_pc", "is_tablet"]
    per_key = fact_logs.groupBy("sk_device").agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_key.join(current(dim_device).select("sk_device", *members), "sk_device")
        .groupBy(*members)
        .agg(F.sum("_n").alias("log_count"))
        .orderBy(F.desc("log_count"), *members)
        .limit(n)
    )


def top_country(fact_logs: DataFrame) -> DataFrame:
    """One row: ``sk_country`` with most log rows; the lower key wins a tie."""
    return (
        fact_logs.groupBy("sk_country")
        .agg(F.count("sk_country").alias("_n"))
        .orderBy(F.desc("_n"), "sk_country")
        .limit(1)
        .select("sk_country")
    )


def top_products_of_top_country(
    fact_orders: DataFrame,
    fact_logs: DataFrame,
    dim_product: DataFrame,
    dim_country: DataFrame,
    n: int = 100,
    dim_customer: DataFrame | None = None,
) -> DataFrame:
    """Products most bought by the customers seen in the country with most log rows.

    Orders and logs meet on the customer key, that is on the same customer version. Given
    ``dim_customer``, they meet on the customer itself.
    """
    buyer = "sk_customer"
    logs, orders = fact_logs, fact_orders
    if dim_customer is not None:
        buyer = "customer_id"
        versions = dim_customer.select("sk_customer", "customer_id")
        logs, orders = logs.join(versions, "sk_customer"), orders.join(versions, "sk_customer")
    customers = (
        logs.join(top_country(fact_logs), "sk_country", "left_semi")
        .select(buyer, "sk_country")
        .distinct()
    )
    # counted per buyer and product first, so that what meets the customers is less than the fact
    bought = orders.groupBy(buyer, "sk_product").agg(F.count("sk_product").alias("_n"))
    return (
        bought.join(customers, buyer)
        .groupBy("sk_product", "sk_country")
        .agg(F.sum("_n").alias("amount_sold"))
        .join(current(dim_product).select("sk_product", "product_name"), "sk_product")
        .join(current(dim_country).select("sk_country", "country_name"), "sk_country")
        .orderBy(F.desc("amount_sold"), "product_name", "country_name", "sk_product")
        .limit(n)
        .select("product_name", "country_name", "amount_sold")
    )


def register_reports(spark: SparkSession, wh: Warehouse, year: int = 2021) -> None:
    """Create the three report views, which follow the warehouse.

    A view is bound again whenever this process publishes a table it reads, so that it shows each
    load and outlives ``expire``; that moves no rows. Loads of other processes show after
    ``wh.catch_up()``.
    """

    def sales(now: Warehouse) -> DataFrame:
        months = [s for s in now.slices("fact_orders") if s.startswith(f"order_month={year}-")]
        return sales_by_month(now.table("fact_orders", months), year)

    def devices(now: Warehouse) -> DataFrame:
        return top_devices(now.table("fact_logs"), now.table("dim_device"))

    def products(now: Warehouse) -> DataFrame:
        return top_products_of_top_country(*[now.table(t) for t in _PRODUCT_TABLES])

    views = {
        f"all_sales_by_month_{year}": (sales, ["fact_orders"]),
        "top_5_devices": (devices, ["fact_logs", "dim_device"]),
        "top_100_products_country_most_access": (products, _PRODUCT_TABLES),
    }
    for name, (report, tables) in views.items():
        wh.follow(
            f"view {name}",
            tables,
            lambda now, name=name, report=report: report(now).createOrReplaceTempView(name),
        )
