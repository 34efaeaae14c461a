"""Fact loading by dimension lookup, rejects, and replacement of a period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.literals import wall_clock
from starmart.operators.asof import valid_at
from starmart.operators.dimensions import current, staged_values
from starmart.operators.joins import (
    BROADCAST_BYTES,
    BROADCAST_KEYS,
    BROADCAST_ROWS,
    hot_keys,
    lookup_join,
    measured,
)
from starmart.session import at_once


@dataclass(frozen=True)
class Lookup:
    """Find ``sk`` in ``dim`` where staged and dimension columns of ``on`` are equal.

    The open version is taken; with ``as_of`` the version valid at that staged time (if there are
    several, each). Text is compared byte by byte, or by a ``collation`` such as ``UTF8_LCASE``
    (ignores case); of open versions whose keys are then equal, the one with the smallest ``sk``
    is found.
    """

    dim: DataFrame
    sk: str
    on: tuple[tuple[str, str], ...]
    as_of: str | None = None
    collation: str | None = None

    @property
    def staged_cols(self) -> tuple[str, ...]:
        return tuple(s for s, _ in self.on)

    @property
    def label(self) -> str:
        return self.sk.removeprefix("sk_")


def same(*cols: str) -> tuple[tuple[str, str], ...]:
    """Pairs for columns named alike on both sides."""
    return tuple((c, c) for c in cols)


@dataclass(frozen=True)
class Balance:
    """How the lookups are joined: the small ones broadcast, hot keys of the others spread."""

    small: frozenset[str] = frozenset()
    hot: Mapping[tuple[str, ...], Sequence[int]] = field(default_factory=dict)


def balance(staged: DataFrame, lookups: Sequence[Lookup]) -> Balance:
    """Measure the dimensions and find the hot keys of those too large to broadcast.

    Takes a pass over the key columns of ``staged``, which should be a stored table.
    """
    sizes = at_once(
        lambda lk=lk: measured(_versions(lk).select(*[d for _, d in lk.on], lk.sk)) for lk in lookups
    )
    small = {
        lk.sk
        for lk, (n, size) in zip(lookups, sizes)
        if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES
    }
    # Hot keys are found byte by byte; lookups by collation rely on AQE.
    large = [lk.staged_cols for lk in lookups if lk.sk not in small and not lk.collation]
    return Balance(frozenset(small), hot_keys(staged, large) if large else {})


def _versions(lookup: Lookup) -> DataFrame:
    return current(lookup.dim) if lookup.as_of is None else lookup.dim


def _in_join_order(lookups: Sequence[Lookup], how: Balance) -> list[tuple[int, Lookup]]:
    """Small dimensions first: they narrow the rows before anything is shuffled.

    Of the others the last one given first: orders are stored by customer, and rows that are in
    the order of their key take fewer bytes in its shuffle.
    """
    return sorted(enumerate(lookups), key=lambda item: (item[1].sk not in how.small, -item[0]))


def _looked_up(
    rows: DataFrame, lookup: Lookup, n: int, kind: str, how: Balance, found_only: bool = False
) -> DataFrame:
    """``rows`` joined with lookup number ``n``; its columns get names that cannot clash.

    With ``found_only`` the dimension contributes one flag per key, ``_hit{n}``.
    """
    keys, pairs = [], []
    for i, (staged_col, dim_col) in enumerate(lookup.on):
        key = F.col(dim_col)
        left = staged_col
        if lookup.collation:
            left = f"_s{n}_{i}"
            rows = rows.withColumn(left, F.collate(staged_col, lookup.collation))
            key = F.collate(key, lookup.collation)
        keys.append(key.alias(f"_d{n}_{i}"))
        pairs.append((left, f"_d{n}_{i}"))
    side, valid = _versions(lookup).select(*keys, lookup.sk), None
    hot = () if lookup.collation else how.hot.get(lookup.staged_cols, ())
    if lookup.as_of and found_only and lookup.sk in how.small and not lookup.collation:
        # one row a key, so that overlapping versions find a row once
        span = F.struct("start_date", "end_date")
        spans = _versions(lookup).select(*keys, span.alias("_span")).groupBy(*[k for _, k in pairs])
        side = F.broadcast(spans.agg(F.collect_list("_span").alias(f"_spans{n}")))
        joined = lookup_join(rows, side, pairs, "left", hot)
        at = F.col(lookup.as_of)
        hit = F.exists(
            f"_spans{n}",
            lambda v: (v["start_date"] <= at) & (v["end_date"].isNull() | (at < v["end_date"])),
        )
        joined = joined.withColumn(f"_hit{n}", F.when(hit, F.lit(True)))
        return joined.drop(*[k for _, k in pairs], f"_spans{n}")
    if lookup.as_of and (found_only or lookup.sk not in how.small):
        side = _versions(lookup).select(*keys, lookup.sk, "start_date", "end_date")
        merged = valid_at(rows, side, pairs, lookup.as_of, lookup.sk, hot)
        kept = [c for c in rows.columns if not c.startswith(f"_s{n}_")]
        if found_only:
            hit = F.when(F.size("_valid") > 0, F.lit(True))
            return merged.select(*kept, hit.alias(f"_hit{n}"))
        return merged.select(*kept, F.explode("_valid").alias(lookup.sk))
    if lookup.collation and not lookup.as_of:
        side = side.groupBy(*[k for _, k in pairs]).agg(F.min(lookup.sk).alias(lookup.sk))
    if lookup.as_of:
        side = _versions(lookup).select(
            *keys,
            lookup.sk,
            F.col("start_date").alias(f"_from{n}"),
            F.col("end_date").alias(f"_to{n}"),
        )
        at, until = F.col(lookup.as_of), F.col(f"_to{n}")
        valid = (at >= F.col(f"_from{n}")) & (until.isNull() | (at < until))
    if found_only:
        side = side.select(*[k for _, k in pairs]).distinct().withColumn(f"_hit{n}", F.lit(True))
    if lookup.sk in how.small:
        side = F.broadcast(side)
    joined = lookup_join(rows, side, pairs, kind, hot, valid)
    helpers = {c for c in joined.columns if c.startswith(("_s", "_d", "_from", "_to"))}
    return joined.drop(*helpers)


def load_fact(
    staged: DataFrame,
    lookups: Sequence[Lookup],
    columns: Sequence[str],
    how: Balance | None = None,
) -> DataFrame:
    """Replace natural keys by surrogate keys and return ``columns`` (names or ``a as b``).

    A staged row that misses a dimension is left out (see ``fact_rejects``); one that matches
    several open versions appears once per match. Without ``how`` the join strategy is left to
    the optimizer.
    """
    how = how or Balance()
    # Only what the lookups and the result need travels through the joins.
    used = {c.split(" as ")[0] for c in columns}
    used |= {c for lk in lookups for c in (*lk.staged_cols, lk.as_of) if c}
    rows = staged.select(*[c for c in staged.columns if c in used])
    for n, lk in _in_join_order(lookups, how):
        rows = _looked_up(rows, lk, n, "inner", how)
    return rows.selectExpr(*columns)


def _by_key(lookup: Lookup) -> bool:
    """Whether the key alone, compared byte by byte, decides if a row is found."""
    return not lookup.as_of and not lookup.collation


def _absent(staged: DataFrame, lookup: Lookup) -> DataFrame | None:
    """The distinct staged keys that no open version has; None if they are too many to broadcast."""
    keys = staged.select(*lookup.staged_cols).dropna().distinct()
    known = _versions(lookup).select(*[F.col(d).alias(f"_d{i}") for i, (_, d) in enumerate(lookup.on)])
    pairs = [(s, f"_d{i}") for i, s in enumerate(lookup.staged_cols)]
    absent = staged_values(lookup_join(keys, known, pairs, "left_anti"), lookup.staged_cols)
    n, size = measured(absent)
    return absent if n <= BROADCAST_KEYS and size <= BROADCAST_BYTES else None


def _flagged(rows: DataFrame, lookup: Lookup, n: int, absent: DataFrame) -> DataFrame:
    """``rows`` with ``_hit{n}``, true where the key is neither NULL nor among the ``absent``."""
    names = [f"_d{n}_{i}" for i in range(len(lookup.on))]
    side = F.broadcast(absent.toDF(*names).withColumn(f"_absent{n}", F.lit(True)))
    joined = lookup_join(rows, side, list(zip(lookup.staged_cols, names)), "left")
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in lookup.staged_cols])
    hit = F.when(whole & F.col(f"_absent{n}").isNull(), F.lit(True))
    return joined.withColumn(f"_hit{n}", hit).drop(*names, f"_absent{n}")


def fact_rejects(
    staged: DataFrame, lookups: Sequence[Lookup], how: Balance | None = None
) -> DataFrame:
    """The staged rows ``load_fact`` leaves out, with ``missing`` = first dimension not found.

    With ``how`` the staged keys that a large dimension lacks are found first, on the key columns
    alone; where they are few enough to broadcast, the staged rows meet them and aren't shuffled.
    """
    rows = staged
    for n, lk in _in_join_order(lookups, how or Balance()):
        absent = _absent(staged, lk) if how and _by_key(lk) and lk.sk not in how.small else None
        if absent is None:
            rows = _looked_up(rows, lk, n, "left", how or Balance(), found_only=True)
        else:
            rows = _flagged(rows, lk, n, absent)
    missing = F.coalesce(
        *[F.when(F.col(f"_hit{n}").isNull(), lk.label) for n, lk in enumerate(lookups)]
    )
    return rows.select(*staged.columns, missing.alias("missing")).filter(
        F.col("missing").isNotNull()
    )


def outside_period(
    fact: DataFrame, date_col: str, start: datetime | str, end: datetime | str
) -> DataFrame:
    """Fact rows a closed-range delete would leave; rows without a date stay."""
    inside = F.col(date_col).between(wall_clock(start), wall_clock(end))
    return fact.filter(~F.coalesce(inside, F.lit(False)))


def replace_period(
    fact: DataFrame,
    reloaded: DataFrame,
    date_col: str,
    start: datetime | str,
    end: datetime | str,
) -> DataFrame:
    """The fact with the rows of a closed date range exchanged for ``reloaded``."""
    return outside_period(fact, date_col, start, end).unionByName(reloaded)
