"""Near-duplicate documents: one-permutation hashing, banding, star-shaped candidates.

One hash per shingle gives all bins of a document's signature: the hash's high bits choose the bin,
the smallest hash in a bin is its value. An empty bin takes the value of a bin drawn by a hash of
its number and the attempt, again until that one is full (optimal densification). Documents that
agree in a band share a bucket; each bucket first pairs its members with a few centres, so that
near copies become components at a cost that grows with the rows. Where a bucket holds several, the
pairs between them that a prefix filter on the full sets can't rule out are compared as well. Pairs
are confirmed on full shingle sets, and links become components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import runs, stored, tasks_for, text_bytes
from starmart.llm.components import cluster, crowded, with_ends
from starmart.llm.prefix import pairs_apart

SHINGLE = 5
PERCENT = 80
# A pair at 80 % agrees in one of 40 bands of 6 bins but for 5 in a million.
BANDS, ROWS = 40, 6
CHUNK = 1 << 20
# Documents read or named by one task.
TASK_DOCS = 5_000
# Nodes from here on stand for sets that no row with an id has.
_UNNAMED = 1 << 62
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
# Bytes as random 64-bit numbers, letters A-Z as their lower case.
_CODE = _mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_CODE[65:91] = _CODE[97:123]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of the first word of each document."""
    n = len(data)
    if len(powers[0]) < n:
        powers[:] = [_powers(_BASE, n), _powers(_INVERSE, n)]
    solid = np.concatenate(([False], ~_SPACE[data], [False]))
    first = solid[1:-1] & ~solid[:-2]
    last = solid[1:-1] & ~solid[2:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    first[edge] |= solid[1:-1][edge]
    last[edge - 1] |= solid[1:-1][edge - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * powers[0][:n], out=total[1:])
    words = (total[stop] - total[start]) * powers[1][start] if len(start) else np.zeros(0, np.uint64)
    words = _mix(words + (stop - start).astype(np.uint64))
    return words, np.searchsorted(start, offsets)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, width: int, powers: list
) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document.

    With fewer words than ``width`` the whole sequence is the one shingle; without words, none.
    """
    words, at = word_hashes(data, offsets, powers)
    n = len(words)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        rolled += words[k : n - width + 1 + k] * _U((_BASE * (2 * k + 3) ** 5 | 1) % (1 << 64))
    rolled = _mix(rolled)
    for i, j in zip(at[:-1], at[1:], strict=True):
        if j - i >= width:
            yield np.unique(rolled[i : j - width + 1])
        elif j > i:
            short = np.array([j - i], np.uint64)
            for k in range(i, j):
                short = _mix(short ^ words[k : k + 1]) * _U(_BASE)
            yield short
        else:
            yield np.zeros(0, np.uint64)


def _probes(bins: int, attempts: int = 4096) -> np.ndarray:
    """Bin that an empty bin looks at, by attempt."""
    seed = np.arange(attempts * bins, dtype=np.uint64).reshape(attempts, bins)
    return (_mix(_mix(seed + _U(1)) ^ _U(_BASE)) % _U(bins)).astype(np.int64)


def signature(hashes: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """The value of every bin; ``hashes`` are sorted and at least one."""
    bins = probes.shape[1]
    width = (1 << 64) // bins + 1
    edges = np.array([k * width for k in range(bins)], np.uint64)
    at = np.searchsorted(hashes, edges)
    after = np.append(at[1:], len(hashes))
    full = after > at
    source = np.where(full, np.arange(bins), -1)
    empty = np.flatnonzero(~full)
    for attempt in probes:
        if not len(empty):
            break
        look = attempt[empty]
        source[empty] = np.where(full[look], look, -1)
        empty = empty[~full[look]]
    source[empty] = np.flatnonzero(full)[0]  # after all attempts: the first full bin
    return hashes[at[source]]


def _band_hashes(values: np.ndarray, bands: int) -> np.ndarray:
    rows = values.reshape(bands, -1)
    out = np.arange(bands, dtype=np.uint64) + _U(1)
    for k in range(rows.shape[1]):
        out = _mix(out * _U(_BASE) ^ rows[:, k])
    return out


def signatures(
    docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, text_hash, n_shingles, f1, f2, bands``; ``f1, f2`` are a fingerprint of the set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = _probes(bands * rows)
        powers = [np.zeros(0, np.uint64)] * 2
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for i, j in runs(offsets, CHUNK):
                part = data[offsets[i] : offsets[j]]
                count, f1, f2, keys = [], [], [], []
                for s in shingle_sets(part, offsets[i : j + 1] - offsets[i], width, powers):
                    count.append(len(s))
                    f1.append(s.sum(dtype=np.uint64))
                    f2.append(_mix(s ^ _U(_BASE)).sum(dtype=np.uint64))
                    if len(s):
                        keys.append(_band_hashes(signature(s, probes), bands))
                ends = np.cumsum([0] + [bands * (c > 0) for c in count])
                flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(1).slice(i, j - i),
                        pa.array(count, pa.int64()),
                        pa.array(np.array(f1, np.uint64).view(np.int64)),
                        pa.array(np.array(f2, np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()), pa.array(flat.view(np.int64))
                        ),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "f1", "f2", "bands"],
                )

    schema = "doc_id long, text_hash long, n_shingles long, f1 long, f2 long, bands array<long>"
    text = F.coalesce("text", F.lit(""))
    hashed = F.xxhash64(text).alias("text_hash")
    return docs.select(F.col("doc_id").cast("long"), hashed, text).mapInArrow(sign, schema)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``node, hashes``: the shingle sets as bytes, by column ``text``."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = [np.zeros(0, np.uint64)] * 2
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in runs(offsets, CHUNK):
                part = data[offsets[i] : offsets[j]]
                sets = shingle_sets(part, offsets[i : j + 1] - offsets[i], width, powers)
                out = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), out], ["node", "hashes"]
                )

    return docs.select("node", "text").mapInArrow(gather, "node long, hashes binary")


def _stored_sets(column: pa.Array) -> Iterator[np.ndarray]:
    for x in column:
        yield np.frombuffer(x.as_buffer(), np.uint64)


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a = np.frombuffer(x.as_buffer(), np.uint64)
                b = np.frombuffer(y.as_buffer(), np.uint64)
                low, high = sorted((len(a), len(b)))
                same = 0
                if 100 * low >= percent * high:
                    at = np.searchsorted(a, b)
                    at[at == len(a)] = 0
                    same = int((a[at] == b).sum())
                good.append(100 * same >= percent * (low + high - same))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(good, pa.bool_())], ["a", "b", "linked"]
            )

    return confirm


def link_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``a, b`` those with 100 * intersection >= percent * union."""
    both = with_ends(pairs, sets.select("node", "hashes"))
    return both.mapInArrow(_confirm(percent), "a long, b long, linked boolean").where("linked")


def _unnamed_texts(docs: DataFrame, signed: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """``node, text`` of the sets that only rows without an id have, one text of each."""
    of_set = nodes.where("id is null").select(*keys, "node")
    hashes = signed.where("doc_id is null").join(of_set, keys).groupBy("node")
    hashes = hashes.agg(F.min("text_hash").alias("text_hash"))
    text = F.coalesce("text", F.lit(""))
    texts = docs.where("doc_id is null").select(F.xxhash64(text).alias("text_hash"), text.alias("text"))
    texts = texts.groupBy("text_hash").agg(F.min("text").alias("text"))
    return texts.join(hashes, "text_hash").select("node", "text")


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash``: one row per row of ``docs``.

    Words are runs of other than the six ASCII spaces, A-Z lower-cased; a document is its set of
    distinct shingles of ``width`` words. Documents with equal sets are one node of the graph, so
    copies cost no pairs.

    A null text or one without words has an empty set and is its own component. A row without an id
    is linked like any other and joins a component, but names none (``component_id`` is null where
    no row of it has an id) and isn't kept. Rows that share an id are one document, linked by any
    of their sets; an empty table gives no rows.
    """
    signed = stored(signatures(docs, width, bands, rows), "signatures")
    keys = ["f1", "f2", "n_shingles"]
    filled = signed.where("n_shingles > 0")
    unnamed = F.lit(_UNNAMED) + F.pmod(F.xxhash64("f1", "f2"), F.lit(_UNNAMED - 1))
    nodes = filled.groupBy(*keys).agg(
        F.min("doc_id").alias("id"), F.any_value("bands").alias("bands")
    )
    some = tasks_for(signed.count(), TASK_DOCS)
    nodes = stored(nodes.withColumn("node", F.coalesce("id", unnamed)), "nodes", some)
    shared = crowded(nodes.select("node", F.explode("bands").alias("bucket")), some)

    # shingle sets of all documents that share a bucket
    ends = shared.select("node").distinct()
    texts = docs.select(
        F.col("doc_id").cast("long").alias("node"), F.coalesce("text", F.lit("")).alias("text")
    )
    texts = texts.where("node is not null").unionByName(_unnamed_texts(docs, signed, nodes, keys))
    texts = texts.join(ends, "node", "left_semi")
    sets = stored(_sets(texts.coalesce(some), width).distinct(), "shingle-sets", some)

    found = cluster(
        shared,
        lambda pairs: link_pairs(pairs, sets, percent),
        lambda open_nodes: pairs_apart(open_nodes, sets, _stored_sets, percent),
    )
    named = nodes.select(*keys, "node").join(found, "node", "left")
    named = named.select(*keys, F.coalesce("component", "node").alias("component"))
    out = signed.drop("bands").join(named, keys, "left")
    component = F.coalesce(F.when(F.col("component") < _UNNAMED, F.col("component")), "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
        "text_hash",
    )
