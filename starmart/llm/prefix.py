"""Pairs of similar sets without a miss: prefixes in a global order of the elements.

Two sets at the Jaccard bound share one of the first ``n - ceil(bound * n) + 1`` elements of each,
in any order that is the same for all sets. Here rare elements come first, by counts in a table of
hashed slots, so what a family has in common is in few prefixes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import stored, tasks_for

SLOTS = 18
# Sets read, prefix elements joined, by one task.
TASK_SETS = 5_000
TASK_ELEMENTS = 200_000
_SHIFT = np.uint64(64 - SLOTS)

Reader = Callable[[pa.Array], Iterator[np.ndarray]]


def slot_counts(sets: DataFrame, reader: Reader) -> np.ndarray:
    """How many elements of all sets fall into each slot; ``sets`` has the set's column last."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOTS, np.int64)
        for batch in batches:
            for s in reader(batch.column(batch.num_columns - 1)):
                np.add.at(total, (s >> _SHIFT).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["slot", "n"]
        )

    counted = sets.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    out = np.zeros(1 << SLOTS, np.int64)
    out[found["slot"].to_numpy()] = found["n"].to_numpy()
    return np.minimum(out, (1 << 32) - 1).astype(np.uint32)


def prefixes(sets: DataFrame, reader: Reader, counts: np.ndarray, percent: int) -> DataFrame:
    """``node, component, n, rest, element``; ``rest`` counts the elements from this one on."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, takes, rests, found = [], [], [], [np.zeros(0, np.uint64)]
            for s in reader(batch.column(2)):
                n = len(s)
                take = n - -(-n * percent // 100) + 1 if n else 0
                order = np.lexsort((s, counts[(s >> _SHIFT).astype(np.int64)]))[:take]
                sizes.append(n)
                takes.append(take)
                rests.append(n - np.arange(take, dtype=np.int64))
                found.append(s[order])
            at = np.repeat(np.arange(len(takes)), takes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    batch.column(1).take(pa.array(at)),
                    pa.array(np.repeat(np.array(sizes, np.int64), takes)),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *rests])),
                    pa.array(np.concatenate(found).view(np.int64)),
                ],
                ["node", "component", "n", "rest", "element"],
            )

    schema = "node long, component long, n long, rest long, element long"
    return sets.select("node", "component", sets.columns[-1]).mapInArrow(cut, schema)


def pairs_apart(nodes: DataFrame, sets: DataFrame, reader: Reader, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different components, with all that reach ``percent`` among them.

    ``nodes`` has ``node, component``, ``sets`` has ``node`` and the set. An element's members are
    joined with the other components that have it, then with the members of those, so members of
    one component never meet. Both joins leave out what cannot reach the bound by size and by the
    element's place: the elements from the first common one on hold the whole intersection.
    """
    held = stored(nodes.join(sets, "node").select("node", "component", sets.columns[-1]), "open-sets")
    some = tasks_for(held.count(), TASK_SETS)
    counts = slot_counts(held, reader)
    found = stored(prefixes(held, reader, counts, percent), "prefixes", some)
    mixed = found.groupBy("element").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = stored(mixed.where("lo <> hi").select("element"), "mixed")
    found = stored(found.join(mixed, "element"), "mixed-prefixes", some)
    heads = found.groupBy("element", "component").agg(
        F.min("n").alias("least"), F.max("rest").alias("most")
    )
    tasks = tasks_for(found.count(), TASK_ELEMENTS)
    heads = stored(heads.withColumnRenamed("component", "other"), "heads", tasks)

    def reach(rest: str, n: str) -> str:
        return f"least(rest, {rest}) * {100 + percent} >= (n + {n}) * {percent}"

    towards = found.join(heads, "element").where(f"component < other and {reach('most', 'least')}")
    towards = stored(
        towards.select("element", "other", F.col("node").alias("x"), "n", "rest"), "towards"
    )
    members = found.select(
        "element", F.col("component").alias("other"), F.col("node").alias("y"), F.col("n").alias("m"),
        F.col("rest").alias("left"),
    )
    pairs = towards.join(members, ["element", "other"]).where(reach("left", "m"))
    pairs = pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    return stored(pairs, "pairs-apart")
