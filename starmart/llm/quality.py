"""Document statistics, and a hashed n-gram log-likelihood ratio between trusted and raw text.

Words and word pairs are hashed to a fixed number of buckets. Two smoothed multinomials over them,
one of trusted documents and one of the whole corpus, give each bucket a log ratio; a document's
score is the mean ratio of its n-grams, and it is kept if that isn't below a threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import SPACE, words

LOG_BUCKETS = 13
SMOOTHING = 1.0
# Ids of trusted documents are broadcast: at most about so many, drawn by hash of the id.
TRUSTED_DOCS = 8000
# Mean log ratio below which a document is unlike the trusted ones.
THRESHOLD = -0.045
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50


def _lines(text: Column) -> Column:
    has_word = F.lit(r"[^\x20\x09-\x0D]")
    return F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, has_word))


def _covered(repeats: Column) -> Column:
    """Positions covered by windows of three that start at the sorted positions."""
    gaps = F.transform(
        repeats, lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get(repeats, i - 1), p - 3))
    )
    return F.aggregate(gaps, F.lit(0), lambda a, x: a + x).cast("long")


def with_features(docs: DataFrame) -> DataFrame:
    """Add ``hashes`` (of the words) and ``grams`` (buckets of words and pairs) by column ``text``."""
    h = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    docs = docs.withColumn("hashes", h)
    hashes, size = F.col("hashes"), F.size("hashes")
    shift = 64 - LOG_BUCKETS
    ones = F.transform(hashes, lambda x: F.shiftrightunsigned(x, shift).cast("int"))
    twos = F.transform(
        F.slice(hashes, 1, F.greatest(size - 1, F.lit(0))),
        lambda x, i: F.shiftrightunsigned(F.xxhash64(x, F.get(hashes, i + 1)), shift).cast("int"),
    )
    return docs.withColumn("grams", F.concat(ones, twos))


def base_statistics(docs: DataFrame) -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``base_failed``.

    Needs ``text`` (not null) and ``hashes``. A text is looked at for repeated windows word by word
    only if it has any: the hashes of its windows are then fewer when made distinct.
    """
    hashes, text = F.col("hashes"), F.col("text")
    lines = _lines(text)
    docs = docs.withColumn("lines", lines).withColumn(
        "tri",
        F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(hashes, i + 1), F.get(hashes, i + 2)),
        ),
    )
    tri = F.col("tri")
    again = F.size(F.array_distinct(tri)) < F.size(tri)
    by_hash = F.when(
        again, F.sort_array(F.transform(tri, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    )
    docs = docs.withColumn("by_hash", by_hash)
    ordered = F.col("by_hash")
    twice = F.filter(
        ordered,
        lambda s, i: s["h"].eqNullSafe(F.get(ordered, i - 1)["h"])
        | s["h"].eqNullSafe(F.get(ordered, i + 1)["h"]),
    )
    docs = docs.withColumn("starts", F.sort_array(F.transform(twice, lambda s: s["i"])))
    repeated = F.when(F.col("starts").isNotNull(), _covered(F.col("starts"))).otherwise(F.lit(0))
    n, again = F.col("n_words"), F.col("n_repeat_words")
    return (
        docs.withColumn("n_words", F.size(hashes).cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace(text, SPACE, "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
        .withColumn(
            "n_dup_lines",
            (F.size("lines") - F.size(F.array_distinct(F.col("lines")))).cast("long"),
        )
        .withColumn("n_repeat_words", repeated.cast("long"))
        .withColumn("base_failed", (n < MIN_WORDS) | (again * 100 > n * 50))
    )


def fit_ratios(docs: DataFrame, trusted: DataFrame, trusted_docs: int = TRUSTED_DOCS) -> list[float]:
    """Log ratio of each bucket, from all of ``docs`` and those whose ``doc_id`` is trusted.

    The raw counts cover every document; the trusted ones at most about ``trusted_docs``, drawn by
    the hash of the id. Without trusted n-grams every ratio is 0.
    """
    ids = trusted.select("doc_id").where("doc_id is not null").distinct()
    n = ids.count()
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (1 << 20) * min(1.0, trusted_docs / max(n, 1))
    # bounded by trusted_docs, so it can be broadcast
    ids = ids.where(drawn).withColumn("trusted", F.lit(1))
    grams = with_features(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
            F.broadcast(ids), "doc_id", "left"
        )
    )
    # explode() would filter by the size of the whole expression, evaluated word by word
    counts = (
        grams.select("trusted", F.explode_outer("grams").alias("b"))
        .where("b is not null")
        .groupBy("b")
        .agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))
        .collect()
    )
    size = 1 << LOG_BUCKETS
    raw, target = [SMOOTHING] * size, [SMOOTHING] * size
    for r in counts:
        raw[r["b"]] += r["raw"]
        target[r["b"]] += r["target"]
    if sum(target) == SMOOTHING * size:
        return [0.0] * size
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [math.log(t) - math.log(r) + shift for t, r in zip(target, raw, strict=True)]


def judge(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """Statistics, ``score`` and ``kept`` of every row; a text without words has score 0.

    A null text counts as empty, and fails for its few words.
    """
    rows = with_features(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    rows = base_statistics(rows)
    # millionths: whole numbers add up to the same in any order
    table = F.expr(f"cast(split('{','.join(str(round(x * 1e6)) for x in ratios)}', ',') as array<long>)")
    total = F.aggregate("grams", F.lit(0).cast("long"), lambda a, b: a + F.get(table, b))
    score = F.coalesce(total / F.nullif(F.size("grams"), F.lit(0)) / 1e6, F.lit(0.0))
    return rows.withColumn("score", score).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"),
        "score",
    )


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Judge all documents against those labelled good and not toxic.

    Null, repeated or unknown ids in ``labels`` teach nothing more; an empty ``labels`` leaves the
    base rules alone to decide; an empty ``docs`` gives no rows; repeated rows are judged alike.
    """
    trusted = labels.where("quality = 1 and coalesce(toxic, 0) = 0")
    return judge(docs, fit_ratios(docs, trusted))
