"""Language identification with a bit-sliced Bloom filter of byte n-grams.

Position p of the filter holds a bit mask with one bit per language. The masks at an n-gram's k
positions, and-ed, name all languages that contain the n-gram at once. Per document and language
the hits are counted, the hits expected by chance (the share of set bits to the power k) are taken
off, and the language with the largest corrected share of the n-grams wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import runs, text_bytes

UND = "und"
GRAM = 4
HASHES = 3
# The filter has 2**LOG_SIZE positions; with PROFILE n-grams a language fills under 5% of them.
LOG_SIZE = 18
PROFILE = 4000
# About so many labelled documents a language are read to fit the profiles, so many bytes of each.
SAMPLE_DOCS = 2000
CHUNK = 1 << 20
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class LanguageFilter:
    """``langs`` by falling number of training rows, then name; ``bits`` has 64 of them a row."""

    langs: list[str]
    bits: np.ndarray
    chance: np.ndarray


def _folded(text: Column) -> Column:
    # A space at both ends lets short words have n-grams too.
    return F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))


def _grams(data: np.ndarray) -> np.ndarray:
    """The n-gram that starts at each byte but the last three, as a number."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint32)
    part = data.astype(np.uint32)
    return part[:-3] | part[1:-2] << 8 | part[2:-1] << 16 | part[3:] << 24


def _positions(grams: np.ndarray) -> Iterator[np.ndarray]:
    wide = grams.astype(np.uint64)
    for factor in _MIX[:HASHES]:
        yield (wide * np.uint64(factor)) >> np.uint64(64 - LOG_SIZE)


def _profile_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count the n-grams of each language within a task's rows."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            kept = [
                _grams(data[offsets[i] : offsets[i + 1]]) for i in np.flatnonzero(langs == lang)
            ]
            grams, counts = np.unique(np.concatenate(kept), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(grams), pa.string()),
                    pa.array(grams.astype(np.int64)),
                    pa.array(counts.astype(np.int64)),
                ],
                ["lang", "gram", "n"],
            )


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageFilter:
    """Profiles from a frame of ``text`` and ``lang``; rows without either teach nothing.

    The classifier is fitted on a sample of about ``sample_docs`` rows a language, drawn by the
    hash of the text; each language's ``PROFILE`` most frequent n-grams enter the filter.
    """
    rows = labelled.select("lang", "text").where("lang is not null and text is not null")
    counts = sorted(((-r["count"], r["lang"]) for r in rows.groupBy("lang").count().collect()))
    langs = [lang for _, lang in counts]
    words = max(1, -(-len(langs) // 64))
    bits = np.zeros((1 << LOG_SIZE, words), np.uint64)
    if langs:
        share = F.create_map(
            *[F.lit(x) for n, lang in counts for x in (lang, min(1.0, sample_docs / -n))]
        )
        drawn = (F.crc32(F.encode("text", "utf-8")) / F.lit(2.0**32)) < share[F.col("lang")]
        grams = (
            rows.where(drawn)
            .select("lang", _folded(F.col("text")).alias("text"))
            .mapInArrow(_profile_counts, "lang string, gram long, n long")
            .groupBy("lang", "gram")
            .agg(F.sum("n").alias("n"))
        )
        order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
        top = grams.withColumn("at", F.row_number().over(order)).where(F.col("at") <= PROFILE)
        # PROFILE n-grams of each language come to the driver
        for lang, found in top.select("lang", "gram").toPandas().groupby("lang")["gram"]:
            k = langs.index(lang)
            for at in _positions(found.to_numpy().astype(np.uint32)):
                bits[at.astype(np.int64), k // 64] |= np.uint64(1 << (k % 64))
    fill = np.array(
        [
            ((bits[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()
            for k in range(len(langs))
        ]
    )
    if len(langs) <= 8:
        bits = bits.astype(np.uint8)
    return LanguageFilter(langs, bits, fill**HASHES)


def _shares(model: LanguageFilter, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per document and language the corrected share of the document's n-grams."""
    grams = _grams(data)
    mask = None
    for at in _positions(grams):
        found = model.bits[at.astype(np.int64)]
        mask = found if mask is None else mask & found
    # n-grams that begin in a document and end in it
    first = np.minimum(offsets[:-1], len(grams))
    last = np.maximum(np.minimum(offsets[1:] - GRAM + 1, len(grams)), first)
    n = np.maximum(last - first, 1)
    shares = np.zeros((len(offsets) - 1, len(model.langs)))
    for k in range(len(model.langs)):
        one = mask.dtype.type(1 << (k % 64))
        hits = np.concatenate(([0], np.cumsum((mask[:, k // 64] & one) != 0)))
        seen = (hits[last] - hits[first]) / n
        shares[:, k] = (seen - model.chance[k]) / (1 - model.chance[k])
    return np.clip(shares, 0, 1)


def predict(docs: DataFrame, model: LanguageFilter, keep: list[str]) -> DataFrame:
    """The columns ``keep`` as struct ``row``, with ``lang_pred``, ``score`` and ``margin``.

    ``lang_pred`` is ``und`` where the text is null or has no letter, or nothing was learned; ties
    go to the language with more training rows, then to the smaller name. ``score`` is the
    language's corrected share of the n-grams, ``margin`` that less the second language's.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 2**LOG_SIZE positions of 8 bytes a 64 languages

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            n = batch.num_rows
            data, offsets = text_bytes(batch.column(1))
            letter = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            shares = np.zeros((n, max(2, len(model.langs))))
            if model.langs:
                for i, j in runs(offsets, CHUNK):
                    part = data[offsets[i] : offsets[j]]
                    shares[i:j, : len(model.langs)] = _shares(
                        model, part, offsets[i : j + 1] - offsets[i]
                    )
            best = shares.argmax(1)
            top = np.partition(shares, -2, axis=1)
            names = [
                model.langs[b] if known and model.langs else UND
                for b, known in zip(best, letter, strict=True)
            ]
            known = letter & bool(model.langs)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names, pa.string()),
                    pa.array(np.where(known, top[:, -1], 0.0)),
                    pa.array(np.where(known, top[:, -1] - top[:, -2], 0.0)),
                ],
                ["row", "lang_pred", "score", "margin"],
            )

    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    source = F.col("text")
    rows = docs.select(
        row,
        _folded(source).alias("text"),
        F.coalesce(F.regexp_like(source, F.lit(r"\p{L}")), F.lit(False)).alias("letter"),
    )
    schema = T.StructType([rows.schema["row"]]).add("lang_pred", "string")
    return rows.mapInArrow(judge, schema.add("score", "double").add("margin", "double"))


def held_out(doc_id: Column) -> Column:
    """True for the fold that never teaches: crc32 of the id as text leaves 2 of 4; null is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Language of every document, learned from those outside the held-out fold.

    Returns ``doc_id, held_out, lang_pred, score, margin``, one row per row of ``docs``. A null
    text, or one without a letter, is ``und`` with score 0; a null id is not held out; repeated
    rows are judged alike; an empty table gives no rows.
    """
    fold = held_out(F.col("doc_id"))
    model = fit(docs.where(~fold))
    slim = docs.select("doc_id", fold.alias("held_out"), "text")
    judged = predict(slim, model, ["doc_id", "held_out"])
    return judged.select("row.doc_id", "row.held_out", "lang_pred", "score", "margin")
