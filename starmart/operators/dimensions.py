"""Dimension maintenance: versioned (type 2) and insert-only."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.literals import wall_clock
from starmart.operators.joins import FEW_VALUES
from starmart.operators.keys import assign_keys, next_key
from starmart.session import shared_dir

_CHUNK = 10_000


def current(dim: DataFrame) -> DataFrame:
    """The open versions."""
    return dim.filter(F.col("end_date").isNull())


def _any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def staged_values(staged: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The distinct ``cols`` of the staged rows, computed once."""
    shared_dir(staged.sparkSession)
    return staged.select(*cols).distinct().checkpoint()


def among(known: DataFrame, values: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """``known`` without rows whose ``cols`` are not in ``values`` (``n`` rows; NULL equals NULL).

    Few values are broadcast, so that what they leave out is not moved; many change nothing.
    """
    if n > FEW_VALUES:
        return known
    named = values.select(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)]).distinct()
    match = [known[c].eqNullSafe(named[f"_v{i}"]) for i, c in enumerate(cols)]
    return known.join(F.broadcast(named), reduce(lambda a, b: a & b, match), "left_semi")


def fresh_rows(
    staged: DataFrame,
    known: DataFrame,
    cols: Sequence[str],
    null_mode: str,
    holds: tuple[bool, bool] | None = None,
) -> DataFrame:
    """Distinct staged ``cols`` that ``known`` lacks, with ``_n`` = number of staged copies.

    ``null_mode`` is how NULL compares:
      ``except``    NULL equals NULL;
      ``antijoin``  NULL equals nothing, so a row with a NULL is always fresh;
      ``not_in``    one NULL in ``known`` leaves nothing fresh, and a staged NULL is fresh only
                    against an empty ``known``.

    ``holds`` says whether the whole dimension has rows, and one with a NULL, where ``known`` is
    but the part of it that can hold the staged values; ``not_in`` alone asks for it.

    Both sides are counted per value before the one exchange, so a value held by a third of the
    staged rows arrives as one row per map task.
    """
    cols = list(cols)
    if null_mode == "not_in":
        if len(cols) != 1:
            raise ValueError("not_in compares one column")
        rows, null = holds or known.agg(
            F.count(F.lit(1)) > 0, F.count_if(F.col(cols[0]).isNull()) > 0
        ).first()
        if null:
            staged = staged.filter(F.lit(False))
        keep = F.col("_known") == 0
        if rows:
            keep = keep & F.col(cols[0]).isNotNull()
    elif null_mode == "antijoin":
        keep = (F.col("_known") == 0) | _any_null(cols)
    elif null_mode == "except":
        keep = F.col("_known") == 0
    else:
        raise ValueError(f"unknown null_mode {null_mode!r}")
    one = F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return (
        staged.select(*cols, one.alias("_staged"), zero.alias("_in"))
        .union(known.select(*cols, zero, one))
        .groupBy(*cols)
        .agg(F.sum("_staged").alias("_n"), F.max("_in").alias("_known"))
        .filter((F.col("_n") > 0) & keep)
        .drop("_known")
    )


def _copies(fresh: DataFrame) -> DataFrame:
    """Repeat each row ``_n`` times, numbered by ``_copy``; large groups expand in many tasks."""
    width = int(fresh.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [c for c in fresh.columns if c != "_n"]
    last = F.floor((F.col("_n") - 1) / _CHUNK).cast("bigint")
    return (
        fresh.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .repartition(width, *cols, "_chunk")
        .withColumn("_from", F.col("_chunk") * _CHUNK)
        .select(
            *cols,
            F.explode(
                F.sequence("_from", F.least(F.col("_from") + _CHUNK, F.col("_n")) - 1)
            ).alias("_copy"),
        )
    )


def _open_version(keyed: DataFrame, sk: str, cols: Sequence[str], load_ts) -> DataFrame:
    return keyed.select(
        sk,
        *cols,
        wall_clock(load_ts).alias("start_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
    )


def new_members(
    dim: DataFrame,
    staged: DataFrame,
    cols: Sequence[str],
    sk: str,
    load_ts: datetime | str,
    null_mode: str,
    distinct: bool = True,
    start: int | None = None,
    holds: tuple[bool, bool] | None = None,
) -> DataFrame:
    """The rows to append to an insert-only dimension.

    ``distinct=False`` inserts one member per staged row that has no match, repeats included.
    Where ``dim`` is but a part of the dimension, ``start`` is the first free key and ``holds`` is
    as in ``fresh_rows``.
    """
    cols = list(cols)
    fresh = fresh_rows(staged, dim, cols, null_mode, holds)
    start = next_key(dim, sk) if start is None else start
    if distinct:
        keyed = assign_keys(fresh.select(*cols), sk, cols, start)
    else:
        keyed = assign_keys(_copies(fresh), sk, cols + ["_copy"], start)
    return _open_version(keyed, sk, cols, load_ts)


def add_members(dim: DataFrame, staged: DataFrame, cols, sk, load_ts, null_mode, distinct=True):
    """The whole insert-only dimension after the load."""
    return dim.unionByName(new_members(dim, staged, cols, sk, load_ts, null_mode, distinct))


def _latest_variant(
    staged: DataFrame, key: Sequence[str], attrs: Sequence[str], order_col: str
) -> DataFrame:
    """The newest variant of each key. Variants are brought down to one row each beforehand."""
    variants = staged.groupBy(*key, *attrs).agg(F.max(order_col).alias("_at"))
    newest = F.max(F.struct("_at", *attrs)).alias("_v")
    return variants.groupBy(*key).agg(newest).select(
        *key, *[F.col(f"_v.{a}").alias(a) for a in attrs]
    )


def new_versions(
    dim: DataFrame,
    staged: DataFrame,
    key: Sequence[str],
    attrs: Sequence[str],
    sk: str,
    load_ts: datetime | str,
    compare: str = "history",
    variants: str = "all",
    order_col: str = "order_date",
    start: int | None = None,
) -> DataFrame:
    """The versions that a load opens, keyed from ``start`` on (by default the first free key).

    ``dim`` may be the part of the dimension that can hold the staged keys, if ``start`` is given.
    """
    cols = [*key, *attrs]
    if variants == "latest":
        staged = _latest_variant(staged, key, attrs, order_col)
    known = current(dim) if compare == "current" else dim
    fresh = fresh_rows(staged, known, cols, "except").select(*cols)
    added = assign_keys(fresh, sk, cols, next_key(dim, sk) if start is None else start)
    return _open_version(added, sk, cols, load_ts)


def close_versions(
    dim: DataFrame,
    added: DataFrame,
    key: Sequence[str],
    sk: str,
    load_ts: datetime | str,
    few: bool = False,
) -> DataFrame:
    """The open versions of ``dim``, of which those with a key in ``added`` end, and ``added``.

    With ``few`` the new keys are broadcast and ``dim`` stays where it is. NULL keys match nothing.
    """
    key, columns = list(key), added.columns
    hit = added.select(*key).filter(~_any_null(key)).distinct().withColumn("_hit", F.lit(True))
    end_date = F.when(F.col("_hit"), wall_clock(load_ts)).alias("end_date")
    open_rows = current(dim).select(*columns)
    keep = [c for c in columns if c != "end_date"]
    if few:
        kept = open_rows.join(F.broadcast(hit), key, "left").select(*keep, end_date)
        return kept.unionByName(added)
    # NULL keys need not meet in one partition of the join.
    keyless = open_rows.filter(_any_null(key))
    kept = open_rows.filter(~_any_null(key)).join(hit, key, "left").select(*keep, end_date)
    return kept.unionByName(keyless).unionByName(added)


def scd2_changes(
    dim: DataFrame, staged: DataFrame, key, attrs, sk: str, load_ts, **options
) -> DataFrame:
    """The open versions after the load plus the versions it closes.

    Closed history is read (two column groups) but not part of the result, so a store that
    keeps it apart does not rewrite it. ``compare="history"`` ignores a staged row equal to any
    earlier version of its key, ``"current"`` only one equal to an open version. With
    ``variants="latest"`` the newest variant of a key in the batch wins; by default each one
    becomes an open version. A NULL key never equals another, so its versions stay open.
    """
    added = new_versions(dim, staged, key, attrs, sk, load_ts, **options)
    return close_versions(dim, added, key, sk, load_ts)


def scd2_merge(dim: DataFrame, staged: DataFrame, key, attrs, sk, load_ts, **options) -> DataFrame:
    """The whole versioned dimension after the load (see ``scd2_changes``)."""
    closed_before = dim.filter(F.col("end_date").isNotNull())
    changes = scd2_changes(dim, staged, key, attrs, sk, load_ts, **options)
    return closed_before.select(*changes.columns).unionByName(changes)
