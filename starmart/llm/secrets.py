"""Secret scanning over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query of trigrams that any match must
contain: an "or" of "and"s. The index lists, per trigram and segment of the corpus, the documents
that contain it; intersecting the lists of a query gives the candidates, and only those are
verified with the expression itself. A rule without mandatory trigrams is verified everywhere.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT_DOCS = 8192
# A part of a rule that would unfold it to more literal variants than this asks for no trigrams.
MAX_VARIANTS = 64


@dataclass(frozen=True)
class Rule:
    """``value_group`` and ``min_chars``: that group must be so long, else the match is dropped."""

    kind: str
    pattern: str
    value_group: int = 0
    min_chars: int = 1


# The three base rules of the contract.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # a run of 16 or more is the same as [0-9a-f]+ of 16 or more
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("login", r"://[^/\s:@]{1,64}:[^/\s:@]{1,64}@"),
)


def _unfold(nodes, variants: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """Append a parsed expression to literal runs; the last run of a variant is still open."""
    for op, arg in nodes:
        name, before = str(op), variants
        if name == "LITERAL":
            variants = [(*v[:-1], v[-1] + chr(arg)) for v in variants]
        elif name == "SUBPATTERN":
            variants = _unfold(arg[-1], variants)
        elif name == "BRANCH":
            variants = [v for part in arg[1] for v in _unfold(part, variants)]
        elif name == "IN" and all(str(k) == "LITERAL" for k, _ in arg) and len(arg) <= 8:
            variants = [(*v[:-1], v[-1] + chr(c)) for v in variants for _, c in arg]
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[:2] == (0, 1):
            variants = variants + _unfold(arg[2], variants)
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and 0 < arg[0] <= 8:
            for _ in range(arg[0]):
                variants = _unfold(arg[2], variants)
            if arg[0] != arg[1]:
                variants = [(*v, "") for v in variants]
        elif name != "AT":  # a boundary takes no characters
            variants = [(*v, "") for v in variants]
        if len(set(variants)) > MAX_VARIANTS:  # let this part stand for any text
            variants = [(*v, "") for v in before]
    return list(dict.fromkeys(variants))


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Sets of lower-case trigrams; every match has all of at least one set.

    Empty if there is a variant without any trigram.
    """
    # the standard library's own parse of an expression
    variants = _unfold(re._parser.parse(pattern), [("",)])
    sets = {
        frozenset(run[i : i + 3].lower() for run in v for i in range(len(run) - 2))
        for v in variants
    }
    if frozenset() in sets:
        return []
    return [s for s in sets if not any(other < s for other in sets)]


def _key(docs: DataFrame) -> Column:
    """What the index calls a document; rows that share it are verified each for themselves."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def build_index(docs: DataFrame, trigrams: list[str], segments: int) -> DataFrame:
    """``trigram`` (its number), ``segment, ids``: the documents of a segment with the trigram.

    Only trigrams that some query asks for are indexed. A segment holds about ``SEGMENT_DOCS``
    documents, however many have the trigram.
    """
    low = docs.select("key", F.lower("text").alias("low"))
    found = F.array_compact(
        F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)])
    )
    return (
        low.select("key", F.explode_outer(found).alias("trigram"))
        .where("trigram is not null")
        .groupBy("trigram", F.pmod(F.xxhash64("key"), F.lit(segments)).alias("segment"))
        .agg(F.collect_set("key").alias("ids"))
    )


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]], trigrams: list[str]) -> DataFrame:
    """``key, kinds``: the rules whose Boolean query a document meets."""
    spark = index.sparkSession
    clauses = [
        (kind, n, trigrams.index(t), len(clause))
        for kind, query in queries.items()
        for n, clause in enumerate(query)
        for t in clause
    ]
    # as many rows as the rules have trigrams
    asked = spark.createDataFrame(clauses, "kind string, clause int, trigram int, size int")
    lists = index.join(F.broadcast(asked), "trigram").groupBy("kind", "clause", "segment", "size")
    met = (
        lists.agg(F.collect_list("ids").alias("lists"))
        .where(F.size("lists") == F.col("size"))
        .select(
            "kind",
            F.aggregate(
                F.slice("lists", 2, F.size("lists")),
                F.get("lists", F.lit(0)),
                F.array_intersect,
            ).alias("ids"),
        )
    )
    return (
        met.select("kind", F.explode_outer("ids").alias("key"))
        .where("key is not null")
        .groupBy("key")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _spans(rule: Rule, order: int, text: Column) -> Column:
    """``start, order, end, kind`` of the rule's leftmost non-overlapping matches, in order.

    The text split at the matches and the matches themselves give the lengths that add up to the
    places; all lengths are in code points.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.value_group))
    parts = F.zip_with(
        F.slice(F.split(text, rule.pattern), 1, F.size(found)),
        F.arrays_zip(found.alias("m"), value.alias("v")),
        lambda gap, m: F.struct(
            F.length(gap).alias("gap"), F.length(m["m"]).alias("n"), F.length(m["v"]).alias("v")
        ),
    )
    none = "array<struct<start:int,order:int,end:int,kind:string>>"
    empty = F.array().cast(none)

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + part["gap"]
        span = F.struct(
            start.alias("start"),
            F.lit(order).alias("order"),
            (start + part["n"]).alias("end"),
            F.lit(rule.kind).alias("kind"),
        )
        good = part["v"] >= rule.min_chars
        return F.struct(
            (start + part["n"]).alias("at"),
            F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"),
        )

    first = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    walked = F.aggregate(parts, first, step, lambda acc: acc["out"])
    return F.when(F.regexp_like(text, pattern), walked).otherwise(empty)


def _named(spans: Column) -> Column:
    text = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(text, ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``doc_id``, ``text`` and an array column of spans for each rule, one row per row.

    A null text counts as empty and has no spans; a null id is kept; rows that repeat an id are
    verified each; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", _key(rows))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted({t for query in queries.values() for clause in query for t in clause})
    segments = max(1, -(-docs.count() // SEGMENT_DOCS))
    index = build_index(rows, trigrams, segments)
    found = candidates(index, {k: q for k, q in queries.items() if q}, trigrams)
    rows = rows.join(found, "key", "left")
    for order, rule in enumerate(rules):
        spans = _spans(rule, order, F.col("text"))
        if queries[rule.kind]:
            asked = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
            spans = F.when(asked, spans).otherwise(F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>"))
        rows = rows.withColumn(rule.kind, spans)
    return rows.drop("key", "kinds")


def find_secrets(docs: DataFrame) -> DataFrame:
    """Counts and places of the base kinds, and the places of all kinds.

    Returns ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``; see ``scan`` for odd rows.
    """
    rows = scan(docs)

    def joined(rules: tuple[Rule, ...]) -> Column:
        return _named(F.sort_array(reduce(F.concat, [F.col(r.kind) for r in rules])))

    return rows.select(
        "doc_id",
        *[F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in BASE],
        F.sha2(joined(BASE), 256).alias("base_sha256"),
        joined(BASE + MORE).alias("spans"),
    )
