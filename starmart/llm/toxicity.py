"""Toxicity by a factorization machine over hashed terms.

A document's terms are its lower-cased words and their first few letters, which an inflected word
keeps, hashed to ``BUCKETS`` numbers. The machine weighs each term and, by the product of two short
vectors, each pair of terms of a document, so that a pair can count for more than its two terms.
Only terms that lean towards one label enter it. It is learned from a bounded sample of the
labelled documents of the fold that teaches; every document is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import stored, tasks_for

BUCKETS = 1 << 24
PREFIXES = (4, 5)
# A term counts if its toxic documents are so many standard deviations from those expected.
LEAN = 4.0
# At most so many terms, those that lean most: the size of the model.
TERMS = 4096
FACTORS = 4
# Terms are chosen and the machine is fitted on about so many labelled documents.
SAMPLE_DOCS = 40_000
ROUNDS = 80
STEP = 0.1
DECAY = 1e-4
THRESHOLD = 0.7
_TASK_DOCS = 10_000
_DRAWS = 1 << 30


@dataclass(frozen=True)
class Toxicity:
    """``terms`` in order; without a ``machine`` every document gets ``base``."""

    terms: list[int]
    machine: FMClassificationModel | None
    base: float


def _bucket(term: Column, kind: int) -> Column:
    return F.pmod(F.xxhash64(term, F.lit(kind)), F.lit(BUCKETS)).cast("int")


def _terms(text: Column) -> Column:
    """All terms of a text in order, repeats included; none of a null."""
    runs = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+")
    kinds = [F.transform(runs, lambda w: _bucket(w, 0))]
    for n in PREFIXES:
        kinds.append(F.transform(runs, lambda w, n=n: _bucket(F.left(w, F.lit(n)), n)))
    return F.concat(*kinds)


def held_out(doc_id: Column) -> Column:
    """True for the fold that never teaches: crc32 of the id as text leaves 1 of 3; null is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of about ``SAMPLE_DOCS`` labelled documents that teach, drawn by their id.

    A document that any label calls toxic is; of rows that repeat an id the smallest text teaches.
    """
    known = labels.where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id")
    known = known.agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    share = min(1.0, SAMPLE_DOCS / max(1, known.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(_DRAWS)) < int(share * _DRAWS)
    # as many rows of two numbers as the sample has
    rows = docs.select("doc_id", "text").join(F.broadcast(known.where(draw)), "doc_id")
    text = F.coalesce("text", F.lit(""))
    return rows.groupBy("doc_id").agg(F.min(text).alias("text"), F.max("toxic").alias("toxic"))


def _leaning(rows: DataFrame, n: int, toxic: int) -> list[int]:
    """The terms whose toxic documents are far from as many as chance gives them."""
    share = toxic / n
    counts = (
        rows.select("toxic", F.explode("all_terms").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
    )
    expected = F.col("n") * share
    lean = F.abs(F.col("t") - expected) / F.sqrt(expected * (1 - share))
    top = counts.select("term", lean.alias("lean")).where(F.col("lean") >= LEAN)
    # a model's size of numbers comes to the driver
    found = top.orderBy(F.desc("lean"), "term").limit(TERMS).collect()
    return sorted(r["term"] for r in found)


def _vectors(rows: DataFrame, terms: list[int]) -> DataFrame:
    """``rows`` with ``features``, which of ``terms`` are in ``all_terms``."""
    held = F.array_intersect("all_terms", F.array(*[F.lit(t) for t in terms]))
    named = rows.withColumn("held_terms", held.cast("array<string>")).drop("all_terms")
    model = CountVectorizerModel.from_vocabulary(
        [str(t) for t in terms], "held_terms", "features", minTF=0.0, binary=True
    )
    return model.transform(named).drop("held_terms")


def fit(docs: DataFrame, labels: DataFrame) -> Toxicity:
    """Learn from a sample of the labelled rows of ``docs`` outside the held-out fold.

    Where only one label occurs, or no term leans to either, there is no machine and every document
    gets the toxic share (0 without a label).
    """
    terms = F.array_distinct(_terms(F.col("text"))).alias("all_terms")
    rows = stored(_sample(docs, labels).select("toxic", terms), "labelled-terms")
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = toxic / n if n else 0.0
    if not 0 < toxic < n:
        return Toxicity([], None, base)
    terms = _leaning(rows, n, toxic)
    if not terms:
        return Toxicity([], None, base)
    drawn = rows.coalesce(tasks_for(n, _TASK_DOCS))
    sample = _vectors(drawn.select("all_terms", F.col("toxic").cast("double")), terms)
    machine = FMClassifier(
        labelCol="toxic", factorSize=FACTORS, maxIter=ROUNDS, stepSize=STEP, regParam=DECAY, seed=7
    ).fit(sample)
    return Toxicity(terms, machine, base)


def score(docs: DataFrame, model: Toxicity, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` as struct ``row``, and ``score`` from 0 to 1."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    if model.machine is None:
        return docs.select(row, F.lit(model.base).cast("double").alias("score"))
    rows = _vectors(docs.select(row, _terms(F.col("text")).alias("all_terms")), model.terms)
    judged = model.machine.setProbabilityCol("probability").transform(rows)
    return judged.select("row", vector_to_array("probability")[1].alias("score"))


def judge_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    Learned from ``labels`` (``doc_id, toxic``) of rows outside the held-out fold. Null and empty
    texts have no term and get the score of none; a null id is not held out and teaches nothing;
    repeated rows are scored alike, and of rows that share an id one teaches; a document with
    several labels is toxic if one says so, null labels say nothing; an empty table gives no rows.
    """
    model = fit(docs, labels)
    judged = score(docs.select("doc_id", "text"), model, ["doc_id"])
    return judged.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
