"""Sums by month that tell whether two sets of orders are the same, in any order of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What decides an order's row in the fact.
SUMMED = (
    "order_id",
    "order_date",
    "CUIT",
    "customer_id",
    "supplier_id",
    "product_id",
    "order_price",
)
_TOTAL = "decimal(38,0)"


def _row_hash() -> Column:
    """64 bits of a row; a NULL counts by its place, which the hash alone would pass over."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in SUMMED])
    return F.xxhash64(nulls, *SUMMED).cast("decimal(20,0)")


def month_sums(staged: DataFrame) -> DataFrame:
    """``month, orders, checksum`` of staged orders; those without a date are in no month.

    The checksum is an exact sum of row hashes, so that sums of parts add up, whatever the
    partitioning, and an order loaded twice isn't taken for one loaded once. Different months pass
    for equal with a chance of 2^-64. Rows are aggregated map-side: a month that holds a third of
    all orders is one row a task in the shuffle.
    """
    month = F.date_format("order_date", "yyyy-MM").alias("month")
    return (
        staged.filter(F.col("order_date").isNotNull())
        .groupBy(month)
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(_row_hash()).cast(_TOTAL).alias("checksum"),
        )
    )


def added(sums: DataFrame, more: DataFrame) -> DataFrame:
    """The sums of two disjoint sets of orders taken together."""
    return (
        sums.unionByName(more)
        .groupBy("month")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("checksum").cast(_TOTAL).alias("checksum"),
        )
    )


def differing(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """Months whose sums differ: ``month, n_source, n_loaded`` (0 where a side lacks the month)."""
    here = source.select("month", F.col("orders").alias("_n"), F.col("checksum").alias("_c"))
    both = here.join(loaded, "month", "full_outer")
    unlike = ~(
        F.col("_n").eqNullSafe(F.col("orders")) & F.col("_c").eqNullSafe(F.col("checksum"))
    )
    return both.filter(unlike).select(
        "month",
        F.coalesce("_n", F.lit(0)).alias("n_source"),
        F.coalesce("orders", F.lit(0)).alias("n_loaded"),
    )
