"""Lookups of the version valid at a time, as a merge by key and time.

An equi-join on the key pairs each fact with every version of its key before the time decides.
Here facts and versions are put in one order by key and time, and each fact takes over what the
last boundary before it left valid. Versions of one lookup key may overlap (two companies of one
name), so a boundary carries the list of all that are valid from it on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.joins import key_hash, partitions


def boundaries(versions: DataFrame, keys: Sequence[str], sk: str) -> DataFrame:
    """``keys, _at, _valid``: at each start and end of a key's versions, those valid from then on."""
    rows = versions.select(*keys, sk, "start_date", "end_date")
    rows = rows.filter("start_date is not null").dropna(subset=list(keys))
    starts = rows.select(*keys, F.col("start_date").alias("_at"))
    ends = rows.filter("end_date is not null").select(*keys, F.col("end_date").alias("_at"))
    times = starts.unionByName(ends).distinct()
    held = rows.select(*[F.col(c).alias(f"_{c}") for c in keys], sk, "start_date", "end_date")
    same = reduce(lambda a, b: a & b, [times[c] == held[f"_{c}"] for c in keys])
    at = F.col("_at")
    valid = (F.col("start_date") <= at) & (F.col("end_date").isNull() | (at < F.col("end_date")))
    return times.join(held, same & valid, "left").groupBy(*keys, "_at").agg(
        F.collect_list(sk).alias("_valid")
    )


def valid_at(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[tuple[str, str]],
    at: str,
    sk: str,
    hot: Sequence[int] = (),
) -> DataFrame:
    """``facts`` with ``_valid``, the surrogate keys of the versions valid at the time ``at``.

    ``on`` has pairs (fact column, version column). A fact whose key or time is NULL has none. The
    rows of the keys whose hashes are in ``hot`` are spread over as many slices as there are
    shuffle partitions, each with all boundaries of those keys.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    names = facts.columns
    left = facts.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
        F.col(at).alias("_at"),
        *[F.col(f).cast(versions.schema[v].dataType).alias(k) for k, (f, v) in zip(keys, on)],
    )
    right = versions.select(
        *[F.col(v).alias(k) for k, (_, v) in zip(keys, on)], F.col(sk).alias("_sk"),
        "start_date", "end_date",
    )
    right = boundaries(right, keys, "_sk")
    whole = [F.lit(0)]
    spread, slices = F.lit(0), F.array(*whole)
    if hot:
        width = partitions(facts)
        hashes = [F.lit(h) for h in hot]
        # equal facts of one task go on to one slice; the task's number sets others apart
        number = F.pmod(F.xxhash64("_row"), F.lit(width)) + F.spark_partition_id()
        spread = F.when(key_hash(left, keys).isin(hashes), F.pmod(number, F.lit(width)).cast("int"))
        spread = spread.otherwise(0)
        slices = F.when(key_hash(right, keys).isin(hashes), F.sequence(F.lit(0), F.lit(width - 1)))
        slices = slices.otherwise(F.array(*whole))
    # what can't match keeps out of the order: NULL keys would be one group
    unmatched = _any_null([*keys, "_at"])
    none = F.lit(None).cast(f"array<{versions.schema[sk].dataType.simpleString()}>")
    rows = left.filter(~unmatched).select(
        *keys, spread.alias("_slice"), "_at", F.lit(1).alias("_kind"), none.alias("_valid"), "_row"
    )
    marks = right.select(
        *keys, F.explode(slices).alias("_slice"), "_at", F.lit(0).alias("_kind"), "_valid",
        F.lit(None).cast(left.schema["_row"].dataType).alias("_row"),
    )
    # a version is valid from its first moment on, so boundaries go before facts
    order = Window.partitionBy(*keys, "_slice").orderBy("_at", "_kind")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last("_valid", ignorenulls=True).over(order)
    merged = rows.unionByName(marks).withColumn("_valid", last).filter("_kind = 1")
    merged = merged.select("_row", "_valid")
    merged = merged.unionByName(left.filter(unmatched).select("_row", none.alias("_valid")))
    return merged.select(*[F.col(f"_row.`{c}`").alias(c) for c in names], "_valid")


def _any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
