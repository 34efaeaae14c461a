"""Temperature mixing of sources to target weights.

A source's share of the tokens is raised to an exponent between 0 (all sources alike) and 1 (as
found). The exponent is the largest that reaches a target entropy, or the smallest that keeps every
source within a number of repeats, found by bisection in Spark. The normalised weights times the
token budget are each source's own budget; it is met by whole passes over the source and a part of
a last one, each pass over the source's blocks in a new order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import n_words, stored

MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 13
SEED = 17
# Sources are broadcast up to so many rows and bytes of names; beyond that they are joined.
BROADCAST_SOURCES = 2000
BROADCAST_BYTES = 1 << 17
# Each round evaluates so many exponents in one pass and keeps the step that holds the answer.
_STEPS = 32
_ROUNDS = 5
_CUTS = 256


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _name(source: Column) -> Column:
    """A null source is a source of its own."""
    return F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name"))


def _bisect(sources: DataFrame, target_entropy: float | None, max_repeats: float, budget) -> float:
    """The exponent; ``sources`` has ``tokens`` above 0. One small row a round reaches the driver."""
    total = sources.agg(F.sum("tokens"), F.max("tokens"), F.count("*")).first()
    if total[2] < 2:
        return 1.0
    share = F.col("tokens") / F.lit(float(total[0]))
    low, high = 0.0, 1.0
    for _ in range(_ROUNDS):
        grid = [low + (high - low) * k / _STEPS for k in range(_STEPS + 1)]
        power = F.pow(share, F.col("a"))
        at = (
            sources.select("tokens", F.explode(F.array(*map(F.lit, grid))).alias("a"))
            .groupBy("a")
            .agg(
                F.sum(power).alias("z"),
                F.sum(power * F.log(share)).alias("zl"),
                F.max(power / F.col("tokens")).alias("most"),
                F.max_by(power / F.col("tokens"), "tokens").alias("least"),
            )
        )
        # -sum w log w with w = share**a / z
        entropy = F.log("z") - F.col("a") * F.col("zl") / F.col("z")
        if budget is None:
            repeats = F.col("most") / F.col("least")
        else:
            repeats = F.lit(float(budget)) * F.col("most") / F.col("z")
        found = {r["a"]: r for r in at.select("a", entropy.alias("h"), repeats.alias("r")).collect()}
        if target_entropy is not None:
            good = [a for a in grid if found[a]["h"] >= target_entropy]
            edge = max(good, default=low)
            low, high = edge, min((a for a in grid if a > edge), default=edge)
        else:
            good = [a for a in grid if found[a]["r"] <= max_repeats]
            edge = min(good, default=high)
            low, high = max((a for a in grid if a < edge), default=edge), edge
        if low == high:
            break
    return low if target_entropy is not None else high


def source_weights(
    tokens: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float = MAX_REPEATS,
    token_budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per source: ``key, tokens, n_docs, alpha, weight, budget, epochs, blocks``.

    ``tokens`` has ``key, doc_id, n_tokens``. Without a ``token_budget`` the smallest one is taken
    with which no source is cut: the most reduced source is passed over once. ``target_entropy``
    (in nats) sets the exponent if given, ``max_repeats`` does otherwise. A source without tokens
    has weight 0 and is passed over once, so that its documents aren't lost.
    """
    sources = stored(
        tokens.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs")),
        "mix-sources",
    )
    real = sources.where("tokens > 0")
    alpha = _bisect(real, target_entropy, max_repeats, token_budget)
    raw = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(alpha)))
    sums = real.agg(F.sum(raw), F.max(F.col("tokens") / raw)).first()
    z = sums[0] or 1.0
    budget = float(token_budget) if token_budget is not None else z * (sums[1] or 0.0)
    weight = F.coalesce(raw / F.lit(z), F.lit(0.0))
    epochs = F.when(F.col("tokens") > 0, F.col("weight") * F.lit(budget) / F.col("tokens"))
    if token_budget is None:  # rounding mustn't cut the source that is passed over once
        epochs = F.greatest(epochs, F.lit(1.0))
    return sources.select(
        "key",
        "tokens",
        "n_docs",
        F.lit(alpha).alias("alpha"),
        weight.alias("weight"),
        (weight * F.lit(budget)).alias("budget"),
        F.ceil(F.col("tokens") / F.lit(block_tokens)).alias("blocks"),
    ).withColumn("epochs", F.coalesce(epochs, F.lit(1.0)))


def _small(sources: DataFrame) -> bool:
    size = sources.agg(F.count("*"), F.sum(F.octet_length("key.name"))).first()
    return size[0] <= BROADCAST_SOURCES and (size[1] or 0) <= BROADCAST_BYTES


def _block(seed: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "digest", F.lit(seed)), F.greatest(F.col("blocks"), F.lit(1)))


def _turn(epoch: Column, seed: int) -> Column:
    """Place of a block in a pass over its source."""
    return _unit(F.col("key"), F.col("block"), epoch, F.lit(seed + 1))


def _cuts(placed: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source the place up to which the blocks of the last, partial pass are taken.

    Blocks are taken in order until the budget is met; the one that meets it is still taken. The
    running sums go over a fixed number of ranges of places per source, then over the blocks of
    the one range that meets it, so no task adds up a whole source.
    """
    part = F.col("epochs") - F.floor("epochs")
    blocks = (
        placed.groupBy("key", "block")
        .agg(
            F.sum("n_tokens").alias("n_tokens"),
            F.first("epochs").alias("epochs"),
            F.first("tokens").alias("tokens"),
        )
        .select(
            "key",
            "n_tokens",
            (part * F.col("tokens")).alias("wanted"),
            _turn(F.floor("epochs"), SEED).alias("turn"),
        )
        .withColumn("range", F.floor(F.col("turn") * _CUTS).cast("int"))
    )
    ranges = blocks.groupBy("key", "range").agg(
        F.sum("n_tokens").alias("n"), F.first("wanted").alias("wanted")
    )
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    meets = ranges.where("before < wanted and before + n >= wanted")
    inside = blocks.join(meets.select("key", "range", "before"), ["key", "range"])
    rank = Window.partitionBy("key").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn(
        "before", F.col("before") + F.coalesce(F.sum("n_tokens").over(rank), F.lit(0))
    )
    return inside.where("before < wanted").groupBy("key").agg(F.max("turn").alias("cut"))


def mix(docs: DataFrame, keep: list[str], **targets) -> tuple[DataFrame, DataFrame]:
    """The mixture, and the sources' weights.

    The mixture has the columns ``keep`` of each drawn row as struct ``row``, ``key`` (the source),
    ``n_tokens``, ``epoch`` (the pass, from 0), ``block`` and ``place``: ordered by it, every
    prefix of the mixture holds the sources by their weights. A row is drawn once in each whole
    pass, and in the last one if its block is. A null text has no tokens; a null source is a source;
    rows without an id are told apart by their texts; rows that repeat id and text stand in one
    block and are drawn alike, so that a source of copies alone is taken whole or not at all in its
    last pass; an empty table gives an empty mixture.
    """
    counted = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        "doc_id",
        _name(F.col("source")).alias("key"),
        # rows without an id, or that share one, are told apart by their texts
        F.xxhash64("text").alias("digest"),
        n_words(F.col("text")).alias("n_tokens"),
    )
    tokens = stored(counted.select("key", "doc_id", "digest", "n_tokens"), "mix-tokens")
    sources = stored(source_weights(tokens, **targets), "mix-weights")
    small = _small(sources)

    def with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(sources) if small else sources, "key")

    wanted = sources.select("key", "tokens", "blocks", "epochs")
    placed = with_sources(tokens, wanted).withColumn("block", _block(SEED))
    cuts = stored(_cuts(placed, sources), "mix-cuts")
    sources_cut = stored(wanted.join(cuts, "key", "left"), "mix-drawn")
    rows = with_sources(counted, sources_cut).withColumn("block", _block(SEED))
    whole = F.floor("epochs")
    last = F.coalesce(_turn(whole, SEED) <= F.col("cut"), F.lit(False))
    passes = whole + F.when(last, 1).otherwise(0)
    rows = rows.where(passes > 0).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), passes - 1))
    )
    # a block's rows stand side by side, spread over its share of the pass
    inside = _unit(F.col("doc_id"), F.col("digest"), F.lit(SEED + 2)) / F.greatest(F.col("blocks"), F.lit(1))
    turn = F.pmod(_turn(F.col("epoch"), SEED) + inside, F.lit(1.0))
    place = (F.col("epoch") + turn) / F.col("epochs")
    mixture = rows.select(
        "row",
        F.when(~F.col("key.none"), F.col("key.name")).alias("source"),
        "n_tokens",
        "epoch",
        "block",
        F.least(place, F.lit(1.0)).alias("place"),
    )
    return mixture, sources
