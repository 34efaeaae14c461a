"""The operators of this package as queries on the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from starmart.llm import (
    exact,
    langid,
    lines,
    minhash,
    mixing,
    packing,
    phrases,
    quality,
    secrets,
    spelling,
    toxicity,
    trie,
    urlfilter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixture, _ = mixing.mix(_table(spark, sf_dir, "documents"), ["doc_id"])
    return mixture.select("row.doc_id", "source", "n_tokens", "epoch", "block", "place")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicate_lines(_table(spark, sf_dir, "documents"))


def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.repeated_bytes(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.filter_quality(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(_table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge_toxicity(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_language_id,
        op2_mix_sources,
        op3_secret_scan,
        op4_minhash_near_dedup,
        op5_line_dedup,
        op6_repeated_bytes,
        op7_pack,
        op8_quality_rules,
        op9_url_filter,
        op10_exact_dedup,
        op11_toxicity,
        op12_prefix_trie,
        op13_spelling_groups,
    )
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}
