"""Fact-to-lookup joins that stay balanced when one key holds much of the fact."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limit of the sketch function.
_MOST_TRACKED = 1_000_000
# A lookup of at most this many rows is broadcast, if its values are measured to have no more than
# so many bytes.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20
# Keys alone are broadcast up to this many, by the same bytes.
BROADCAST_KEYS = 1_000_000
# Values that are counted and not measured are broadcast up to this many.
FEW_VALUES = 100_000


def partitions(frame: DataFrame) -> int:
    """How many partitions a shuffle of the session has."""
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def measured(frame: DataFrame) -> tuple[int, int]:
    """Rows of ``frame``, and the bytes of their values written as text, eight more for each."""
    each = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in frame.columns]
    total = F.sum(reduce(lambda a, b: a + b, each).cast("long"))
    rows, size = frame.agg(F.count(F.lit(1)), F.coalesce(total, F.lit(0))).first()
    return rows, size


def _family(kind: T.DataType) -> str:
    """Types of one family compare with each other as they are."""
    return "number" if isinstance(kind, T.NumericType) else kind.typeName().split("(")[0]


def key_hash(frame: DataFrame, columns: Sequence[str]) -> Column:
    """Hash of a key, the same for equal values of different numeric types.

    The fraction of a number isn't hashed, nor one beyond 64 bits: such keys share slices with
    others, which the join then tells apart by value.
    """
    parts = []
    for name in columns:
        number = _family(frame.schema[name].dataType) == "number"
        parts.append(F.col(name).try_cast("bigint") if number else F.col(name))
    return F.xxhash64(*parts)


def hot_keys(
    facts: DataFrame, key_sets: Sequence[Sequence[str]], share: float | None = None
) -> dict[tuple[str, ...], list[int]]:
    """For each set of key columns, the hashes of the keys that hold at least ``share`` of rows.

    By default that is a hundredth, or twice a shuffle partition's share if that is less. One
    column-pruned pass with a frequent-items sketch per key set, merged map-side. The answer has at
    most ``1/share`` entries per set. A key just below the share may be missed or included; that
    moves work between tasks and never changes a join result.
    """
    share = share or min(0.01, 2 / partitions(facts))
    top = math.ceil(1 / share)
    tracked = min(top * 100, _MOST_TRACKED)
    sketches = [
        F.expr(f"approx_top_k(_k{i}, {top}, {tracked})").alias(f"_s{i}")
        for i in range(len(key_sets))
    ]
    row = (
        facts.select(*[key_hash(facts, keys).alias(f"_k{i}") for i, keys in enumerate(key_sets)])
        .agg(F.count(F.lit(1)).alias("_n"), *sketches)
        .first()
    )
    return {
        tuple(keys): [e["item"] for e in row[f"_s{i}"] or [] if e["count"] >= share * row["_n"]]
        for i, keys in enumerate(key_sets)
    }


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    hot: Sequence[int] = (),
    also: Column | None = None,
) -> DataFrame:
    """Equi-join ``facts`` with ``lookup`` on pairs (fact column, lookup column).

    Column names of the two sides must differ; the result has all columns of both. Without
    ``hot`` this is a plain join, whose skew AQE handles where both sides are fresh shuffles.
    With the hashes found by ``hot_keys`` the rows of those keys are spread over as many slices
    as there are shuffle partitions, and only the lookup rows of those keys are repeated per
    slice, whatever the plan below looks like. Numeric keys may differ in type; keys of other
    types must have the same one, so that the result doesn't depend on how the join is done.
    """
    pairs = list(on)
    for f, k in pairs:
        left, right = facts.schema[f].dataType, lookup.schema[k].dataType
        if _family(left) != _family(right):
            raise TypeError(f"{f} is {left.simpleString()}, {k} is {right.simpleString()}")
    if hot:
        slices = partitions(facts)
        hashes = [F.lit(h) for h in hot]
        # The partition id separates identical rows; it is the same again when a task reruns.
        number = F.pmod(F.xxhash64(*facts.columns), F.lit(slices)) + F.spark_partition_id()
        spread = F.pmod(number, F.lit(slices)).cast("int")
        facts = facts.withColumn(
            "_slice", F.when(key_hash(facts, [f for f, _ in pairs]).isin(hashes), spread).otherwise(0)
        )
        copies = F.when(
            key_hash(lookup, [k for _, k in pairs]).isin(hashes), F.sequence(F.lit(0), F.lit(slices - 1))
        ).otherwise(F.array(F.lit(0)))
        lookup = lookup.withColumn("_lookup_slice", F.explode(copies))
        pairs.append(("_slice", "_lookup_slice"))
    condition = reduce(lambda a, b: a & b, [facts[f] == lookup[k] for f, k in pairs])
    if also is not None:
        condition = condition & also
    return facts.join(lookup, condition, how).drop("_slice", "_lookup_slice")
