"""Candidate pairs from buckets, and connected components, both star-shaped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import stored, tasks_for


# Rows of two or three longs handled by one task.
TASK_ROWS = 50_000


def _large_star(edges: DataFrame, width: int) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    up = both.where("b > a").join(stored(low, "lowest", width), "a").where("b <> m")
    return up.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, width: int) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of those; ``a`` is above ``b``."""
    low = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "lowest", width)
    down = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links`` (two columns of longs, either order).

    Alternates large stars and small stars. ``component`` is the smallest node that can be reached.
    Rounds go on until every link leads to a node that leads nowhere, about the logarithm of the
    longest shortest path. No node's links are gathered in one place: smallest neighbours are
    aggregated, stored, and joined back in a join whose hot keys can be split. Tasks are as many as
    the links need.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b")
    edges = stored(edges, "links")
    width = tasks_for(edges.count(), TASK_ROWS)
    while True:
        large = stored(_large_star(edges, width), "links", width)
        edges = stored(_small_star(large, width), "links", width)
        # stars: each node has one link, and to one that has none
        seen = edges.agg(F.count("*"), F.count_distinct("a")).first()
        roots = edges.select(F.col("b").alias("node")).distinct()
        if seen[0] == seen[1] and not edges.join(roots, edges["a"] == roots["node"], "semi").head(1):
            break
    roots = roots.select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def with_ends(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """``a, b, x, y``: pairs with the values (``node``, value) of both ends.

    The values are brought down to the nodes of the pairs before they move, so that few pairs move
    little; how many tasks the joins take then follows from the bytes that are left.
    """
    node, value = values.columns
    ends = pairs.select(F.col("a").alias(node)).unionByName(pairs.select(F.col("b").alias(node)))
    held = values.join(ends.distinct(), node, "left_semi")
    left = held.select(F.col(node).alias("a"), F.col(value).alias("x"))
    right = held.select(F.col(node).alias("b"), F.col(value).alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


# Centres of a bucket in every turn but the first.
CENTRES = 4


def _orders(turn: int) -> list[Column]:
    """The orders by which centres are chosen; at first the node with the fullest buckets is one.

    What many others are variants of shares more bands with them than they do with each other.
    """
    if turn == 0:
        return [-F.col("weight")]
    return [F.xxhash64("node", F.lit(turn * CENTRES + k)) for k in range(CENTRES)]


def star_pairs(buckets: DataFrame, turn: int, tasks: int) -> DataFrame:
    """Pairs ``a, b`` of a bucket's centres and its members outside the centre's component.

    ``buckets`` has ``bucket, node, weight, component``. The centres are aggregated per bucket
    before they are joined back, so a bucket of any size is never gathered.
    """
    centres = [
        F.min(F.struct(o.alias("o"), "node", "component")).alias(f"c{k}")
        for k, o in enumerate(_orders(turn))
    ]
    names = [f"c{k}" for k in range(len(centres))]
    mixed = buckets.groupBy("bucket").agg(
        *centres, F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    centre = mixed.where("lo <> hi").select(
        "bucket", F.array_distinct(F.array(*[F.struct(f"{c}.node", f"{c}.component") for c in names])).alias("centres")
    )
    # stored, so that the join can split a hot bucket
    centre = stored(centre, "centres", tasks)
    pairs = (
        buckets.join(centre, "bucket")
        .select("node", "component", F.explode("centres").alias("c"))
        .where("component <> c.component")
        .select(
            F.greatest("node", "c.node").alias("a"),
            F.least("node", "c.node").alias("b"),
        )
        .distinct()
    )
    return stored(pairs, "pairs", tasks)


def crowded(buckets: DataFrame, tasks: int) -> DataFrame:
    """``node, bucket, weight`` of buckets with two nodes or more.

    ``weight`` is how many rows the node's buckets have together.
    """
    full = buckets.groupBy("bucket").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("size")
    )
    full = stored(full.where("lo <> hi").select("bucket", "size"), "crowded", tasks)
    shared = stored(buckets.join(full, "bucket"), "shared", tasks)
    weights = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    shared = shared.join(weights, "node").select("node", "bucket", "weight")
    return stored(shared, "weighted", tasks)


def cluster(
    shared: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    apart: Callable[[DataFrame], DataFrame],
    crowd: int = 0,
) -> DataFrame:
    """``node, component`` of the nodes that ``confirm`` links to another one of their bucket.

    ``confirm(pairs)`` keeps the pairs that are similar. Each turn pairs every bucket's
    members with its centres, over the buckets that still hold two components, with other centres
    each time. Turns end with the one that links under a tenth of its pairs. They only save work:
    ``apart(nodes)`` then gives every pair of different components, of the nodes that have one in
    a bucket (``node, component``), that can be similar at all, and those not yet compared are.
    Turns also end when no bucket of several components has more than ``crowd`` nodes.
    """
    tasks = tasks_for(shared.count(), TASK_ROWS)
    state, found, turn = shared.withColumn("component", F.col("node")), None, 0
    tested = None
    while True:
        pairs = _untested(star_pairs(state, turn, tasks), tested, tasks)
        tested = pairs if tested is None else tested.unionByName(pairs)
        n, new, links = _confirmed(pairs, confirm)
        if found is None:
            found = stored(components(new), "components", tasks)
        elif links:
            found = stored(_joined(found, new), "components", tasks)
        state = shared.join(found, "node", "left").select(
            "node", "bucket", "weight", F.coalesce("component", "node").alias("component")
        )
        turn += 1
        if links * 10 < n or not links:
            break
        if crowd and not _mixed(state).where(F.col("size") > crowd).head(1):
            break
    mixed = stored(_mixed(state).select("bucket"), "open-buckets", tasks)
    nodes = state.join(mixed, "bucket").select("node", "component").distinct()
    nodes = stored(nodes, "open-nodes", tasks)
    if not nodes.head(1):
        return found
    _, new, links = _confirmed(_untested(apart(nodes), tested, tasks), confirm)
    return stored(_joined(found, new), "components", tasks) if links else found


def _mixed(state: DataFrame) -> DataFrame:
    """``bucket, size`` of the buckets that hold several components."""
    both = F.min("component").alias("lo"), F.max("component").alias("hi")
    mixed = state.groupBy("bucket").agg(*both, F.count("*").alias("size"))
    return mixed.where("lo <> hi").select("bucket", "size")


def _untested(pairs: DataFrame, tested: DataFrame | None, tasks: int) -> DataFrame:
    if tested is None:
        return pairs
    return stored(pairs.join(tested, ["a", "b"], "left_anti"), "untested", tasks)


def _confirmed(
    pairs: DataFrame, confirm: Callable[[DataFrame], DataFrame]
) -> tuple[int, DataFrame, int]:
    """How many pairs, those that are linked, and how many these are."""
    n = pairs.count()
    if not n:
        return 0, pairs, 0
    new = stored(confirm(pairs).select("a", "b"), "confirmed")
    return n, new, new.count()


def _joined(found: DataFrame, new: DataFrame) -> DataFrame:
    """``found`` after the links ``new`` between its components, or nodes outside of them."""
    for end in ("a", "b"):
        of = found.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
        new = new.join(of, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    merged = components(new.select("ca", "cb").distinct())
    # a single node stands for itself in the new links
    alone = merged.join(found, "node", "left_anti")
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("to"))
    moved = found.join(merged, "component", "left").select(
        "node", F.coalesce("to", "component").alias("component")
    )
    return moved.unionByName(alone)
