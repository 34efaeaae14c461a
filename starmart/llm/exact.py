"""Exact deduplication by deterministic naming of blocks.

A text is cut into fixed-size blocks of bytes. Sorting the blocks gives each distinct one an
integer name; then neighbouring names are paired and the pairs named again, until one name is left
of each document. Names stand for contents, not for hashes of them, so equal names are equal texts.

Within a task each distinct block is written once and other occurrences refer to it, so the copies
of a block that meet in the sort are at most one a task (or a full memory of one).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import stored, text_bytes

BLOCK = 4096
# Bytes of blocks that a task remembers before it forgets them and names them anew.
REMEMBERED = 48 << 20
_ROWS = 4096
_SCHEMA = "rid long, doc_id long, text_sha256 string, n_blocks int, at int, ref long, content binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks; ``content`` stands at the block that others refer to."""
    schema = pa.schema(
        [
            ("rid", pa.int64()),
            ("doc_id", pa.int64()),
            ("text_sha256", pa.string()),
            ("n_blocks", pa.int32()),
            ("at", pa.int32()),
            ("ref", pa.int64()),
            ("content", pa.binary()),
        ]
    )
    base = TaskContext.get().partitionId() << 40
    known: dict[bytes, int] = {}
    held = n_rows = n_blocks = size = 0
    out: list[list] = [[] for _ in schema]
    for batch in batches:
        ids, sums = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        data, offsets = text_bytes(batch.column(2))
        data = data.tobytes()
        for doc_id, digest, start, stop in zip(ids, sums, offsets[:-1], offsets[1:], strict=True):
            count = max(1, -(-int(stop - start) // BLOCK))
            for at in range(count):
                block = data[start + at * BLOCK : min(stop, start + (at + 1) * BLOCK)]
                ref = known.get(block)
                new = ref is None
                if new:
                    if held > REMEMBERED:
                        known.clear()
                        held = 0
                    ref = base | n_blocks
                    n_blocks += 1
                    known[block] = ref
                    held += len(block) + 100
                    size += len(block)
                first = at == 0
                row = (
                    base | n_rows,
                    doc_id if first else None,
                    digest if first else None,
                    count,
                    at,
                    ref,
                    block if new else None,
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
                if len(out[0]) >= _ROWS or size > 4 << 20:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema
                    )
                    out, size = [[] for _ in schema], 0
            n_rows += 1
    if out[0]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema
        )


def _name_blocks(blocks: DataFrame) -> DataFrame:
    """``rid, n_blocks, at, name``; the smallest reference to a content is its name."""
    same = Window.partitionBy("content")
    names = (
        blocks.where("content is not null")
        .select("ref", F.min("ref").over(same).alias("name"))
        .where("ref <> name")
    )
    return blocks.select("rid", "n_blocks", "at", "ref").join(names, "ref", "left").select(
        "rid", "n_blocks", "at", F.coalesce("name", "ref").alias("name")
    )


def _name_pairs(level: DataFrame) -> DataFrame:
    """Half as many rows: each pair of neighbours under one name."""
    odd = F.col("at") % 2 == 1
    pairs = level.groupBy("rid", "n_blocks", F.shiftright("at", 1).alias("at")).agg(
        F.max(F.when(~odd, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("b"),
    )
    pairs = stored(pairs, "name-pairs")
    names = stored(
        pairs.select("a", "b").distinct().withColumn("name", F.monotonically_increasing_id()),
        "pair-names",
    )
    return pairs.join(names, ["a", "b"]).select("rid", "n_blocks", "at", "name")


def identities(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, text_sha256, n_blocks, name``; rows with equal last two have equal texts."""
    text = F.coalesce("text", F.lit(""))
    blocks = stored(
        docs.select("doc_id", F.sha2(text, 256), text).mapInArrow(_blocks, _SCHEMA), "blocks"
    )
    longest = blocks.agg(F.max("n_blocks")).first()[0] or 1
    # one block more than the last level could pair: a document's level is set by its length
    level = stored(_name_blocks(blocks), "names")
    done, left = [level.where("n_blocks = 1").select("rid", "n_blocks", "name")], 1
    while left < longest:
        level = stored(_name_pairs(level.where(F.col("n_blocks") > left)), "names")
        ready = (F.col("n_blocks") > left) & (F.col("n_blocks") <= left * 2)
        done.append(level.where(ready).select("rid", "n_blocks", "name"))
        left *= 2
    named = done[0]
    for part in done[1:]:
        named = named.unionByName(part)
    rows = blocks.where("at = 0").select("rid", "doc_id", "text_sha256")
    return rows.join(named, "rid")


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per row of ``docs``.

    Of equal texts the row with the largest id stays (one of them if rows repeat it; a null id
    comes before any other). A null text equals an empty one; an empty table gives no rows.
    """
    rows = stored(identities(docs.select(F.col("doc_id").cast("long"), "text")), "identities")
    groups = rows.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "rid")).alias("keep"), F.count("*").alias("group_size")
    )
    # stored, so that the join's own exchanges meet and a large group's rows can be split
    groups = stored(groups.where("group_size > 1"), "groups")
    alone = F.col("group_size").isNull()
    return rows.join(groups, ["n_blocks", "name"], "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("rid") == F.col("keep.rid"))).alias("kept"),
        "text_sha256",
    )
