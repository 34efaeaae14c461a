"""Surrogate keys: consecutive numbers in a defined order, computed in parallel."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import shared_dir

# monotonically_increasing_id() = partition number << 33 | row number in the partition.
_ROW_BITS = 33


def next_key(dim: DataFrame, sk: str) -> int:
    """One more than the highest key in use; 1 for an empty dimension."""
    top = dim.agg(F.max(sk)).first()[0]
    return 1 if top is None else top + 1


def assign_keys(rows: DataFrame, sk: str, order_cols: list[str], start: int = 1) -> DataFrame:
    """Prepend ``sk`` = ``start``, ``start + 1``, ... in the order of ``order_cols``.

    Same numbers as a global ``row_number()``, which would sort everything in one task. The rows
    are range-partitioned, ranked within their partition and written to the checkpoint folder
    once, so the ranks stand even if an executor is lost later. Only the row count per partition
    comes to the driver. ``order_cols`` should tell all rows apart.
    """
    spark = rows.sparkSession
    shared_dir(spark)
    ranked = (
        rows.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_id", _ROW_BITS).cast("int")
    counts = {
        r["_part"]: r["count"] for r in ranked.groupBy(part.alias("_part")).count().collect()
    }
    rank = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    if len(counts) <= 1:
        return ranked.select((rank + F.lit(start)).alias(sk), *rows.columns)
    parts = sorted(counts)
    firsts = accumulate([start] + [counts[p] for p in parts[:-1]])
    offsets = spark.createDataFrame(list(zip(parts, firsts)), "_part int, _first bigint")
    # One row per partition: small whatever the number of rows.
    return (
        ranked.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_first") + rank).alias(sk), *rows.columns)
    )
