"""A trie over conversations, built by bursting.

The conversations below a trie head form a container. A container of more than ``LIMIT`` turns is
burst by the ids of its next turns, twice as many in each round, so that a container of copies of
one very long conversation takes few rounds. What is left below a head is small: it is sorted by
turn ids in one task and swept into nodes. A conversation alone in its container is a chain, which
needs no sweep and is never gathered.

Heads are counted with map-side aggregates. What a subtree holds is summed along one member of
each node, chunk by chunk where a conversation is long.
"""

from __future__ import annotations

import hashlib
import operator
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import n_words, stored, tasks_for

# Turns of a container that one task sorts and sweeps.
LIMIT = 20_000
GROUP = 20
MOST_SHARED = 3
# Turns of a conversation over which a window runs; beyond it, totals of chunks are carried on.
CHUNK = 4096
_TASK_TURNS = 100_000
# Bytes of ids in a row that goes to the hash.
_PIECE = 4096
_KEY = 32
_ROW_BITS = 33
_NOTHING = hashlib.sha256().hexdigest()
_HEAD = ["at", "d1", "d2"]
_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string"
)
_SWEPT = _NODES + ", d1 long, d2 long"
_PIECES = "depth long, d1 long, d2 long, seq long, ids string"
_HASHES = "depth long, d1 long, d2 long, ends_sha256 string"


def _numbered(conversations: DataFrame) -> DataFrame:
    """``conv, pos, key, words``: each conversation's turns from 1 on, in order.

    Rows are range-partitioned, so a conversation may spread over tasks; the turns that it has in
    earlier ones are added to the places in a later one.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.left(
            F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(_KEY)
        ).alias("key"),
        n_words(F.col("text")).alias("words"),
    )
    order = ["conv", "turn", "role", "text"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("id", F.monotonically_increasing_id()).drop("turn", "role", "text")
    rows = stored(rows, "turns").withColumn("part", F.shiftright("id", _ROW_BITS))
    spread = rows.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a conversation goes on in a later task at most once for each task
    later = spread.withColumn("earlier", F.sum("n").over(before)).where("earlier is not null")
    place = F.row_number().over(Window.partitionBy("conv", "part").orderBy("id"))
    rows = rows.withColumn("place", place).join(
        F.broadcast(later.drop("n")), ["conv", "part"], "left"
    )
    return rows.select(
        "conv", (F.col("place") + F.coalesce("earlier", F.lit(0))).alias("pos"), "key", "words"
    )


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, depth, key, words`` of the turns and ``conv, n`` of the conversations rebuilt.

    The first ``h`` turns come from the first conversation of the group, the others are its own.
    """
    turns = stored(_numbered(conversations), "numbered-turns")
    h = F.crc32(F.col("conv").cast("string")) % (MOST_SHARED + 1)
    convs = turns.groupBy("conv").agg(F.max("pos").alias("own")).withColumn("h", h)
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % GROUP)
    first = turns.where((F.col("conv") % GROUP == 0) & (F.col("pos") <= MOST_SHARED))
    first = first.groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "key", "words"))).alias("lent")
    )
    convs = convs.join(first, "base", "left").withColumn(
        "lent", F.slice(F.coalesce("lent", F.array()), 1, F.col("h").cast("int"))
    )
    tail = F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = stored(
        convs.select("conv", "h", "lent", (F.size("lent") + tail).cast("long").alias("n")),
        "conversations",
    )
    lent = convs.select("conv", F.explode("lent").alias("t"))
    lent = lent.select("conv", F.col("t.pos").cast("long").alias("depth"), "t.key", "t.words")
    own = turns.join(convs.select("conv", "h", F.size("lent").alias("k")), "conv")
    own = own.where("pos > h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("k")).cast("long").alias("depth"), "key", "words"
    )
    return stored(lent.unionByName(own), "rebuilt"), convs.select("conv", "n")


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _running(
    rows: DataFrame, names: list[str], total: Callable[[Column], Column],
    both: Callable[[Column, Column], Column], place: Column, down: bool,
) -> DataFrame:
    """``names`` totalled along each conversation, up to and with the row.

    ``place`` counts a conversation's rows from 0 on; ``down`` runs from the last to the first.
    ``both`` is the total of two.
    """
    rows = rows.withColumn("_place", place).withColumn("_chunk", F.expr(f"_place div {CHUNK}"))
    order, chunks = (-F.col(c) if down else F.col(c) for c in ("_place", "_chunk"))
    sums = rows.groupBy("conv", "_chunk").agg(*[total(F.col(c)).alias(c) for c in names])
    before = Window.partitionBy("conv").orderBy(chunks)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    earlier = [total(F.col(c)).over(before).alias(f"_{c}") for c in names]
    # one chunk is the rule, and has nothing before it
    sums = sums.select("conv", "_chunk", *earlier).where(f"_{names[0]} is not null")
    within = Window.partitionBy("conv", "_chunk").orderBy(order)
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({c: total(F.col(c)).over(within) for c in names})
    rows = rows.join(sums, ["conv", "_chunk"], "left")
    none = F.lit(0).cast("long")
    rows = rows.withColumns({c: both(F.col(c), F.coalesce(f"_{c}", none)) for c in names})
    return rows.drop("_place", "_chunk", *[f"_{c}" for c in names])


def _digests() -> list[Column]:
    """Two numbers of a turn at its depth, from either half of its key."""
    half = _KEY // 2
    return [
        F.xxhash64(F.left("key", F.lit(half)), "depth"),
        F.xxhash64(F.right("key", F.lit(half)), "depth"),
    ]


def _burst(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``heads`` and ``containers``.

    Heads are rows ``conv, n, depth, words, d1, d2, p1, p2`` of each conversation at each depth
    down to its container; ``d1, d2`` name the node, ``p1, p2`` its parent. Containers are rows
    ``conv, n, at, d1, d2, members, rep`` of the conversations that go on below their last head;
    ``rep`` is the head's smallest member.
    """
    zero = F.lit(0).cast("long")
    heads = convs.select(
        "conv", "n", zero.alias("depth"), zero.alias("words"), zero.alias("d1"), zero.alias("d2"),
        zero.alias("p1"), zero.alias("p2"),
    )
    # stored, as a join on constants would be one without a condition
    heads = stored(heads, "heads")
    state = heads.select("conv", "n", F.col("depth").alias("at"), "d1", "d2")
    containers, at, width = None, 0, 1
    while True:
        sizes = stored(
            state.groupBy(*_HEAD).agg(
                F.count_if(F.col("n") > at).alias("members"),
                F.sum(F.col("n") - at).alias("load"),
                F.min("conv").alias("rep"),
            ),
            "container-sizes",
        )
        full = (F.col("members") > 1) & (F.col("load") > LIMIT)
        below = state.where(F.col("n") > at)
        ready = below.join(sizes.where(~full), _HEAD).drop("load")
        containers = ready if containers is None else containers.unionByName(ready)
        if not sizes.where(full).head(1):
            return heads, containers
        below = stored(below.join(sizes.where(full).select(*_HEAD), _HEAD), "burst")
        upto = at + width
        rows = turns.where((F.col("depth") > at) & (F.col("depth") <= upto))
        rows = rows.join(below, "conv")
        e1, e2 = _digests()
        rows = rows.select("conv", "n", "depth", "words", "d1", "d2", e1.alias("e1"), e2.alias("e2"))
        own = rows.withColumns({"x1": F.col("e1"), "x2": F.col("e2")})
        own = _running(own, ["x1", "x2"], F.bit_xor, _xor, F.col("depth") - F.lit(at + 1), False)
        level = own.select(
            "conv", "n", "depth", "words",
            *[F.col(f"d{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"d{i}") for i in (1, 2)],
            *[
                F.col(f"d{i}").bitwiseXOR(F.col(f"x{i}")).bitwiseXOR(F.col(f"e{i}")).alias(f"p{i}")
                for i in (1, 2)
            ],
        )
        level = stored(level, "heads")
        heads = heads.unionByName(level)
        state = level.where(F.col("depth") == upto)
        state = state.select("conv", "n", F.col("depth").alias("at"), "d1", "d2")
        at, width = upto, 2 * width


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """The rows as a batch; ``rows`` is empty after."""
    columns = zip(zip(*rows, strict=True), schema, strict=True)
    made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=schema)
    rows.clear()
    return made


def _schema(fields: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in fields.split(","))])


class _Node:
    __slots__ = ("conv", "depth", "parent", "n", "children", "leaves", "saved", "ends", "words")

    def __init__(self, depth: int, words: int, parent: _Node | None) -> None:
        self.conv, self.depth, self.parent, self.words = None, depth, parent, words
        self.n = self.children = self.leaves = self.saved = 0
        self.ends = None

    def end(self, conv: int) -> None:
        """``conv`` has its last turn here; equal conversations come by rising id."""
        if self.ends is None:
            self.ends = hashlib.sha256(b"%d" % conv)
        else:
            self.ends.update(b",%d" % conv)
        self.n += 1
        self.conv = conv if self.conv is None else min(self.conv, conv)

    def close(self) -> None:
        """Its subtree is complete: pass it on to the parent."""
        if not self.children:
            self.leaves = 1
        self.saved += (self.n - 1) * self.words
        up = self.parent
        up.conv = self.conv if up.conv is None else min(up.conv, self.conv)
        up.n += self.n
        up.children += 1
        up.leaves += self.leaves
        up.saved += self.saved

    def row(self, rep: int) -> tuple:
        above = self.parent
        return (
            self.conv, self.depth, above.conv if above.parent else rep, self.n, self.children,
            self.leaves, self.saved, self.ends.hexdigest() if self.ends else _NOTHING,
        )


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted containers to nodes, and to one row for each head with what lies below it."""
    schema = _schema(_SWEPT)
    out: list[tuple] = []
    head = top = last = None
    nodes: list[_Node] = []
    path: list[_Node] = []

    def settled() -> None:
        while len(path) > 1:
            path.pop().close()
        (at, d1, d2), rep = head
        out.extend((*node.row(rep), None, None) for node in nodes)
        out.append((top.conv, at, None, None, top.children, top.leaves, top.saved, None, d1, d2))
        nodes.clear()

    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        for at, d1, d2, rep, conv, seq, words in rows:
            if head is None or head[0] != (at, d1, d2):
                if head is not None:
                    settled()
                    if len(out) >= 10_000:
                        yield _batch(out, schema)
                head, last = ((at, d1, d2), rep), ""
                top = _Node(at, 0, None)
                path[:] = [top]
            shared = 0
            most = min(len(seq), len(last))
            while shared < most and seq[shared : shared + _KEY] == last[shared : shared + _KEY]:
                shared += _KEY
            shared //= _KEY
            while len(path) > shared + 1:
                path.pop().close()
            for k in range(shared, len(words)):
                node = _Node(at + k + 1, words[k], path[-1])
                nodes.append(node)
                path.append(node)
            path[-1].end(conv)
            last = seq
    if head is not None:
        settled()
    if out:
        yield _batch(out, schema)


def _sweep(turns: DataFrame, containers: DataFrame) -> DataFrame:
    rows = turns.join(containers, "conv").where("depth > at")
    rows = rows.groupBy(*_HEAD, "rep", "conv").agg(
        F.array_sort(F.collect_list(F.struct("depth", "key", "words"))).alias("row")
    )
    rows = rows.select(
        *_HEAD, "rep", "conv", F.array_join("row.key", "").alias("seq"), F.col("row.words").alias("words")
    )
    total = containers.agg(F.coalesce(F.sum(F.col("n") - F.col("at")), F.lit(0))).first()[0]
    rows = rows.repartition(tasks_for(total, _TASK_TURNS), *_HEAD)
    rows = rows.sortWithinPartitions(*_HEAD, "seq", "conv")
    return stored(rows.mapInArrow(_swept, _SWEPT), "swept")


def _chains(turns: DataFrame, alone: DataFrame) -> DataFrame:
    """The nodes below a head of a conversation that nothing else follows."""
    rows = turns.join(alone, "conv").where("depth > at")
    last = F.col("depth") == F.col("n")
    return rows.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == F.col("at") + 1, F.col("rep")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        (~last).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(_NOTHING).alias("ends_sha256"),
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``depth, d1, d2, conv`` to rows of joined ids, numbered in their order."""
    base, seq = TaskContext.get().partitionId() << _ROW_BITS, 0
    schema = _schema(_PIECES)
    node, ids, size = None, [], 0
    out: list[tuple] = []
    for batch in batches:
        for *key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != node or size > _PIECE:
                if ids:
                    out.append((*node, base + seq, ",".join(ids)))
                    seq += 1
                node, ids, size = key, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if out:
            yield _batch(out, schema)
    if ids:
        yield _batch([(*node, base + seq, ",".join(ids))], schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``depth, d1, d2, seq, ids`` to one hash a node; holds one row at a time."""
    schema = _schema(_HASHES)
    node = digest = None
    out: list[tuple] = []
    for batch in batches:
        for depth, d1, d2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (depth, d1, d2) != node:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (depth, d1, d2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield _batch(out, schema)
    if node:
        yield _batch([(*node, digest.hexdigest())], schema)


def _ends(heads: DataFrame) -> DataFrame:
    """``depth, d1, d2, ends_sha256`` of the heads where conversations end.

    Ids are sorted and joined in as many tasks as they take; a node's hash then reads rows of ids.
    """
    name = ["depth", "d1", "d2"]
    rows = heads.where("n = depth").select(*name, "conv")
    rows = rows.repartitionByRange(*name, "conv").sortWithinPartitions(*name, "conv")
    rows = stored(rows.mapInArrow(_pieces, _PIECES), "ends")
    rows = rows.repartition(*name).sortWithinPartitions(*name, "seq")
    return rows.mapInArrow(_hashed, _HASHES)


def _head_nodes(heads: DataFrame, below: DataFrame) -> DataFrame:
    """Nodes of the heads; ``below`` has ``conv, at, d1, d2, n_children, n_leaves, saved_tokens``."""
    name = ["depth", "d1", "d2"]
    nodes = heads.groupBy(*name).agg(
        F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("words").alias("words"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.count_if(F.col("n") == F.col("depth")).alias("n_ends"),
    )
    nodes = stored(nodes, "head-nodes")
    one, both = F.lit(1).cast("long"), ["n_leaves", "saved_tokens"]
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")]
    children = nodes.where("depth > 0").select(*up, one.alias("k"))
    children = children.unionByName(
        below.select(F.col("at").alias("depth"), "d1", "d2", F.col("n_children").alias("k"))
    )
    children = children.groupBy(*name).agg(F.sum("k").alias("n_children"))
    # each node's and container's own part stands at one member, at its depth
    leaf = F.col("n_ends") == F.col("n_convs")
    saved = (F.col("n_convs") - 1) * F.col("words")
    parts = nodes.select(
        F.col("conv_id").alias("conv"), "depth", leaf.cast("long").alias("n_leaves"),
        saved.alias("saved_tokens"),
    ).unionByName(below.select("conv", F.col("at").alias("depth"), *both))
    parts = parts.groupBy("conv", "depth").agg(*[F.sum(c).alias(c) for c in both])
    parts = stored(parts, "subtree-parts")
    rows = heads.select("conv", *name).join(parts.select("conv").distinct(), "conv", "left_semi")
    rows = rows.join(parts, ["conv", "depth"], "left").fillna(0, both)
    rows = _running(rows, both, F.sum, operator.add, F.col("depth"), True)
    sums = stored(rows.groupBy(*name).agg(*[F.sum(c).alias(c) for c in both]), "subtrees")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    found = nodes.join(stored(children, "children"), name, "left").join(sums, name)
    found = found.join(stored(_ends(heads), "end-hashes"), name, "left")
    found = found.join(parents, ["depth", "p1", "p2"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), *both,
        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null at the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Turns of one
    number stand by role and text; null roles and texts are empty, null turns come first, rows that
    repeat are turns of their own. Rows without a conversation id belong to none. A conversation
    without a turn after rebuilding ends at the root. An empty table has no node.
    """
    turns, convs = rebuild(conversations)
    heads, containers = _burst(turns, convs)
    containers = stored(containers, "containers")
    swept = _sweep(turns, containers.where("members > 1"))
    alone = containers.where("members = 1")
    one = F.lit(1).cast("long")
    below = swept.where("d1 is not null").select(
        F.col("conv_id").alias("conv"), F.col("depth").alias("at"), "d1", "d2",
        "n_children", "n_leaves", "saved_tokens",
    ).unionByName(
        alone.select("conv", *_HEAD, one.alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    )
    nodes = _head_nodes(heads, below)
    deeper = swept.where("d1 is null").drop("d1", "d2")
    return nodes.unionByName(deeper).unionByName(_chains(turns, alone))
