"""Length buckets with the least padding, and batches of a token budget within each.

The lengths of all sequences are counted in one histogram. Dynamic programming over it places the
bucket boundaries so that padding every sequence to its bucket's boundary costs the fewest tokens. Within a bucket, as many sequences form a batch as fit the token
budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import n_words, stored

MAX_TOKENS = 8192
BUCKETS = 16
BATCH_TOKENS = 1 << 16
# Rows numbered by one task. A bucket is dealt over as many shards as its rows need; each shard
# has at most one batch that isn't full.
SHARD_ROWS = 20_000


def _layer(prev: np.ndarray, lengths: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The costs with one bucket more than in ``prev``, and where the bucket before ends.

    The best place for that end never falls as the length rises, so halving the lengths halves the
    places left to try.
    """
    new, came = prev.copy(), [-2] * len(prev)  # -2: fewer buckets do as well
    came[0] = -1
    todo = [(1, len(prev) - 1, 0, len(prev) - 1)]
    while todo:
        low, high, first, last = todo.pop()
        if low > high:
            continue
        j = (low + high) // 2
        stop = min(last + 1, j)
        options = prev[first:stop] + lengths[j] * (below[j + 1] - below[first + 1 : stop + 1])
        i = first + int(options.argmin())
        if options[i - first] < new[j]:
            new[j], came[j] = options[i - first], i
        todo += [(low, j - 1, first, i), (j + 1, high, i, last)]
    return new, came


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[list[int], int]:
    """At most ``buckets`` of the lengths as boundaries, and the tokens they take when padded.

    ``cost[j]``: the fewest padded tokens for the lengths up to the j-th, the last boundary there.
    """
    n = len(lengths)
    if not n:
        return [], 0
    below = np.concatenate(([0], np.cumsum(counts)))
    # 64 bits: a 100 TB corpus has fewer than 2**63 padded tokens
    costs, back = [lengths * below[1:]], [[-1] * n]
    for _ in range(min(buckets, n) - 1):
        new, came = _layer(costs[-1], lengths, below)
        costs.append(new)
        back.append(came)
    out, j, level = [], n - 1, len(back) - 1
    while j >= 0 and level >= 0:
        came = back[level][j]
        if came == -2:
            level -= 1
            continue
        out.append(int(lengths[j]))
        j, level = came, level - 1
    return sorted(out), int(costs[-1][n - 1])


def _at_least(bounds: list[int], value: Column) -> Column:
    """The first of the bounds that isn't below the value."""
    out = F.lit(bounds[-1])
    for b in reversed(bounds[:-1]):
        out = F.when(value <= b, F.lit(b)).otherwise(out)
    return out.cast("long")


def sequences(docs: DataFrame, max_tokens: int) -> DataFrame:
    """``doc_id, row, piece, n_tokens``: documents cut into sequences of at most ``max_tokens`` words.

    A document without words is one sequence of length 0. ``row`` tells rows apart.
    """
    n = F.col("n")
    last = F.greatest(F.lit(1), F.ceil(n / max_tokens)).cast("long") - 1
    return (
        docs.select("doc_id", n_words(F.col("text")).alias("n"))
        .withColumn("row", F.monotonically_increasing_id())
        .select("doc_id", "row", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
        .select(
            "doc_id",
            "row",
            "piece",
            F.least(F.lit(max_tokens), n - F.col("piece") * max_tokens).cast("long").alias("n_tokens"),
        )
    )


def pack(
    docs: DataFrame,
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Every sequence of every document in a batch.

    Returns ``doc_id, piece, n_tokens, bucket`` (the boundary, its padded length), ``shard, batch,
    slot`` and ``padding``. ``(bucket, shard, batch)`` names a batch; its padded sequences take at
    most ``batch_tokens``, or it is one sequence longer than that. A null text or one without words
    is a sequence of length 0 in the smallest bucket; a null id is kept; repeated rows take a slot
    each; an empty table gives no rows. A sequence's shard follows from the place of its row in the
    files, so rows that share an id, or have none, are spread like others.
    """
    rows = stored(sequences(docs, max_tokens), "sequences")
    rows = rows.withColumn("length", F.greatest(F.lit(1).cast("long"), "n_tokens"))
    # at most max_tokens rows, whatever the corpus
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    lengths = np.array(sorted(counts), np.int64)
    per_length = np.array([counts[x] for x in lengths], np.int64)
    bounds, _ = boundaries(lengths, per_length, buckets)
    if not bounds:
        bounds = [1]
    each = np.bincount(np.searchsorted(bounds, lengths), per_length, len(bounds))
    shards, caps = F.lit(1), F.lit(1)
    for bound, count in zip(bounds, each, strict=True):
        here = F.col("bucket") == bound
        shards = F.when(here, F.lit(max(1, -(-int(count) // shard_rows)))).otherwise(shards)
        caps = F.when(here, F.lit(max(1, batch_tokens // bound))).otherwise(caps)
    rows = rows.withColumn("bucket", _at_least(bounds, F.col("length")))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), shards).cast("int"))
    order = Window.partitionBy("bucket", "shard").orderBy("doc_id", "row", "piece")
    at = F.row_number().over(order) - 1
    return (
        rows.withColumn("at", at)
        .withColumn("cap", caps)
        .select(
            "doc_id",
            "piece",
            "n_tokens",
            "bucket",
            "shard",
            F.floor(F.col("at") / F.col("cap")).alias("batch"),
            F.pmod("at", "cap").alias("slot"),
            (F.col("bucket") - F.col("n_tokens")).alias("padding"),
        )
    )
