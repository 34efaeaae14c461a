"""From raw documents to packed training batches, one operator a stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm import exact, langid, minhash, mixing, packing
from starmart.llm.common import stored

# A document whose best language knows less of its n-grams is in none of the learned ones.
MIN_SCORE = 0.05


def _whole(docs: DataFrame) -> Column:
    """All columns of a row in one, so that no name can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _keyed(docs: DataFrame, digest: Column) -> DataFrame:
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))
    return docs.select(_whole(docs), did.alias("did"), digest.alias("digest"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, or in none of the languages that the labels teach.

    That drops null and empty texts. A null id or lang and repeated rows are kept as they are; texts
    of any length are read whole; an empty table, or one without labels, gives no rows.
    """
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    judged = langid.predict(docs, model, docs.columns)
    good = (F.col("lang_pred") != langid.UND) & (F.col("score") >= MIN_SCORE)
    return judged.where(good).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep the row with the largest id; of rows that repeat it, any one.

    A null text equals an empty one, a null id is below all others; an empty table gives no rows.
    """
    judged = exact.deduplicate(docs.select("doc_id", "text")).where("kept")
    keep = judged.select(
        F.coalesce("doc_id", F.lit(-1)).alias("did"), F.col("text_sha256").alias("digest")
    )
    rows = _keyed(docs, F.sha2(F.coalesce("text", F.lit("")), 256))
    # rows that repeat an id and a text meet map-side, so that a third of the table may be one row
    rows = rows.dropDuplicates(["did", "digest"])
    return rows.join(keep, ["did", "digest"], "left_semi").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the smallest id.

    A row without an id goes if it is linked to one that has one; groups of which no row has an id
    stay whole. Null texts, and those without words, are linked with nothing and stay. An empty
    table gives no rows.
    """
    judged = minhash.near_duplicates(docs.select("doc_id", "text"))
    keep = judged.where("kept or component_id is null").select(
        F.coalesce("doc_id", F.lit(-1)).alias("did"), F.col("text_hash").alias("digest")
    )
    rows = _keyed(docs, F.xxhash64(F.coalesce("text", F.lit(""))))
    return rows.join(keep, ["did", "digest"], "left_semi").select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Raise small sources: each row once, those of smaller sources up to twice.

    A null source is a source of its own; a null text has no tokens; rows without an id are told
    apart by their texts; rows that repeat id and text are drawn alike; an empty table gives no rows.
    """
    mixed, _ = mixing.mix(docs, docs.columns)
    return mixed.select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every sequence in a batch of its length bucket.

    Nothing is dropped: a null or empty text is a sequence without tokens, a long one is cut into
    several, repeated rows take a place each. An empty table gives no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mix_sources", mixture),
    ("packing", packed),
]

# Learned languages and hashed shingles have no SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
