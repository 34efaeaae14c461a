"""Fuzzy line deduplication with MinHash over character shingles.

A line's shingles are the twelve characters from each of its characters on. Each of 36 hashes of the
shingles has its minimum as a signature value; three values are a band. Lines that share a band are
clustered as near-duplicate documents are: compared on their whole shingle sets with a few centres,
then with all lines of a bucket in other components or, where it holds many lines, wherever a prefix
filter can't rule a pair out. One line of each component stays. Shingles of
every place are too many for rows or lambdas over arrays, so they are hashed in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import runs, shuffles_freed, stored, tasks_for, text_bytes
from starmart.llm.components import cluster, crowded, with_ends
from starmart.llm.minhash import _BASE, _CODE, _INVERSE, _mix, _powers
from starmart.llm.prefix import pairs_apart

PERCENT = 80
SALT = 40503
# Distinct lines whose bands or shingles are made by one task.
TASK_LINES = 20_000
WIDTH = 12
# A pair at 80 % shares one of twelve bands of three values in 99.98 % of all cases.
BANDS, ROWS = 12, 3
# Bytes of lines hashed at once; small enough for a core's cache.
CHUNK = 1 << 17
# Buckets of more lines than this are compared by a prefix filter.
CROWD = 32
_HAS_WORD = r"[^\x20\x09-\x0D]"
_U = np.uint64
# Every hash has its own constants, random 64-bit numbers; the factors are odd.
_ADDED = _mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _U(SALT))
_FACTORS = _mix(_ADDED) | _U(1)


def _whole_rows(docs: DataFrame) -> DataFrame:
    """``did, uid, doc_id, text``: rows with the same first two are copies of one row."""
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    did = F.coalesce(doc_id, F.lit(-1))
    uid = F.xxhash64(doc_id, text)
    return docs.select(did.alias("did"), uid.alias("uid"), doc_id.alias("doc_id"), text.alias("text"))


def _lines(docs: DataFrame) -> DataFrame:
    """``did, uid, at, line``: the lines with a word, trimmed and in lower case, and their numbers."""
    lines = _whole_rows(docs).select(
        "did", "uid", F.posexplode_outer(F.split("text", "\n")).alias("at", "raw")
    )
    lines = lines.where(F.regexp_like("raw", F.lit(_HAS_WORD)))
    return lines.select("did", "uid", "at", F.lower(F.trim("raw")).alias("line"))


def _with_keys(lines: DataFrame) -> DataFrame:
    """Add ``k1, k2``, a 128-bit hash of the line."""
    return lines.withColumns(
        {"k1": F.xxhash64("line"), "k2": F.xxhash64(F.lit(SALT), F.col("line"))}
    )


def shingles(data: np.ndarray, offsets: np.ndarray, powers: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, and the number of the first one of each line.

    A line of fewer than ``WIDTH`` characters is its one shingle; no line is empty.
    """
    n = len(data)
    if len(powers[0]) < n:
        powers[:] = [_powers(_BASE, n), _powers(_INVERSE, n)]
    start = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(start, offsets)
    many = np.maximum(np.diff(first) - WIDTH + 1, 1)
    at = np.concatenate(([0], np.cumsum(many)))
    here = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], many)
    stop = np.minimum(here + WIDTH, np.repeat(first[1:], many))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * powers[0][:n], out=total[1:])
    here, stop = start[here], np.append(start, n)[stop]
    out = (total[stop] - total[here]) * powers[1][here] + (stop - here).astype(np.uint64)
    return _mix(out), at


def line_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each line."""
    powers = [np.zeros(0, np.uint64)] * 2
    data, offsets = text_bytes(column)
    for i, j in runs(offsets, CHUNK):
        hashes, at = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], powers)
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield np.unique(hashes[a:b])


def bands(hashes: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The bands of each line, one array a band."""
    out = []
    for b in range(BANDS):
        key = np.full(len(at) - 1, b + 1, np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            least = np.minimum.reduceat((hashes ^ _ADDED[k]) * _FACTORS[k], at[:-1])
            key = _mix(key * _U(_BASE) ^ least)
        out.append(key)
    return out


def _signed(lines: DataFrame) -> DataFrame:
    """``lines``, whose column ``line`` comes last, and the bands of each line."""
    names = [f"band{b}" for b in range(BANDS)]
    width = len(lines.columns)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = [np.zeros(0, np.uint64)] * 2
        for batch in batches:
            data, offsets = text_bytes(batch.column(width - 1))
            for i, j in runs(offsets, CHUNK):
                part = data[offsets[i] : offsets[j]]
                found = bands(*shingles(part, offsets[i : j + 1] - offsets[i], powers))
                columns = [batch.column(c).slice(i, j - i) for c in range(width)]
                columns += [pa.array(x.view(np.int64)) for x in found]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    schema = T.StructType([*lines.schema, *[T.StructField(n, T.LongType()) for n in names]])
    return lines.mapInArrow(sign, schema)


def _sets_of(column: pa.Array) -> list[np.ndarray]:
    """The sets of a column of lines; those of a line that comes again are made once."""
    coded = column.dictionary_encode()
    sets = list(line_sets(coded.dictionary))
    return [sets[k] for k in coded.indices.to_numpy()]


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # rows whose lines are a megabyte together, as their sets are held at once
            ends = text_bytes(batch.column(2))[1] + text_bytes(batch.column(3))[1]
            for i, j in runs(ends, CHUNK * 8):
                part = batch.slice(i, j - i)
                good = []
                for x, y in zip(_sets_of(part.column(2)), _sets_of(part.column(3)), strict=True):
                    low, high = sorted((len(x), len(y)))
                    same = 0
                    if 100 * low >= percent * high:
                        at = np.searchsorted(x, y)
                        at[at == len(x)] = 0
                        same = int((x[at] == y).sum())
                    good.append(100 * same >= percent * (low + high - same))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(good, pa.bool_())], ["a", "b", "linked"]
                )

    return confirm


def _apart(nodes: DataFrame, shared: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of a bucket's nodes in different components; ``nodes`` has ``node, component``.

    Nodes of buckets of more than ``CROWD`` are left to a prefix filter, and only they are read for
    it; a smaller bucket makes fewer than ``CROWD`` pairs a row.
    """
    rows = shared.join(nodes, "node").select("bucket", "node", "component")
    size = F.count("*").alias("size")
    sizes = rows.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), size)
    sizes = stored(sizes.where("lo <> hi").select("bucket", "size"), "open-sizes")
    rows = stored(rows.join(sizes, "bucket"), "open-rows")
    few = rows.where(F.col("size") <= CROWD)
    left = few.select("bucket", F.col("node").alias("a"), F.col("component").alias("of_a"))
    right = few.select("bucket", F.col("node").alias("b"), F.col("component").alias("of_b"))
    pairs = left.join(right, "bucket").where("a > b and of_a <> of_b").select("a", "b").distinct()
    many = stored(rows.where(F.col("size") > CROWD).select("node", "component").distinct(), "many")
    if not many.head(1):
        return pairs
    return pairs.unionByName(pairs_apart(many, texts, line_sets, percent)).distinct()


def duplicate_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``did, uid, at``: the lines to remove; of each component the first stays, by id and number.

    A null id counts as -1. Rows are told apart by id and text, ``uid`` is the hash of both; copies
    of one row are one document.
    """
    with shuffles_freed(docs.sparkSession):
        stays = _staying(docs, percent)
    rows = _with_keys(_lines(docs)).select("did", "uid", "at", "k1", "k2").join(stays, ["k1", "k2"])
    rows = rows.where(F.struct("did", "at", "uid") != F.col("stays"))
    return rows.select("did", "uid", "at").distinct()


def _staying(docs: DataFrame, percent: int) -> DataFrame:
    """``k1, k2, stays``: the lines of components of several, and which line of it stays."""
    # the text of a line moves once: equal lines meet before they are signed
    distinct = _with_keys(_lines(docs)).groupBy("k1", "k2").agg(
        F.min(F.struct("did", "at", "uid")).alias("first"),
        F.count("*").alias("n"),
        F.min("line").alias("line"),
    )
    distinct = distinct.withColumn("node", F.monotonically_increasing_id())
    signed = _signed(distinct.select("node", "k1", "k2", "first", "n", "line"))
    # its text is on disk twice while it is written, in the shuffle too
    nodes = stored(signed, "lines", codec="zstd")
    names = [f"band{b}" for b in range(BANDS)]
    buckets = nodes.select("node", F.explode(F.array(*names)).alias("bucket"))
    some = tasks_for(nodes.count(), TASK_LINES)
    shared = crowded(buckets, some)

    texts = nodes.select("node", "line").join(shared.select("node").distinct(), "node", "left_semi")
    texts = stored(texts, "line-texts", some)

    def confirm(pairs: DataFrame) -> DataFrame:
        both = with_ends(pairs, texts.select("node", "line"))
        return both.mapInArrow(_confirm(percent), "a long, b long, linked boolean").where("linked")

    found = cluster(shared, confirm, lambda rest: _apart(rest, shared, texts, percent), CROWD)
    # a line that was found once and links to none is left out before it moves again
    grouped = nodes.join(found, "node", "left").where("component is not null or n > 1").select(
        "k1", "k2", "first", "n", F.coalesce("component", "node").alias("component")
    )
    grouped = stored(grouped, "linked-lines")
    stays = grouped.groupBy("component").agg(F.min("first").alias("stays"), F.sum("n").alias("all"))
    return grouped.join(stays.where(F.col("all") > 1), "component").select("k1", "k2", "stays")


def deduplicate_lines(docs: DataFrame, percent: int = PERCENT, with_text: bool = False) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` (line numbers from 0), one row per row of ``docs``.

    Only lines with a word count, and only they can be removed; a null text has none. Rows of the
    same id and text are one document, and each gives up the same lines; other rows that share an
    id, or have none, are documents of their own; an empty table gives no rows. ``with_text`` adds
    ``text`` without the removed lines.
    """
    gone = duplicate_lines(docs, percent)
    gone = gone.groupBy("did", "uid").agg(F.sort_array(F.collect_list("at")).alias("removed"))
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    counted = F.size(F.filter(lines, lambda x: F.regexp_like(x, F.lit(_HAS_WORD))))
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(-1)).alias("did"),
        F.xxhash64(doc_id, F.coalesce("text", F.lit(""))).alias("uid"),
        counted.cast("long").alias("n_lines"),
        *(["text"] if with_text else []),
    )
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    rows = rows.join(gone, ["did", "uid"], "left").withColumn("removed", removed)
    if with_text:
        kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("removed", i))
        rows = rows.withColumn("text", F.array_join(kept, "\n"))
    size = F.size("removed").cast("long").alias("n_removed")
    return rows.select("doc_id", "n_lines", size, "removed", *(["text"] if with_text else []))
