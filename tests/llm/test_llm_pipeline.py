"""The pipeline, stage by stage, against what each operator decides."""

from collections import Counter

from odd import documents, odd_rows
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import langid, minhash, mixing
from starmart.llm.common import stored

SF_DIR = "/root/testdata/sf0.001"


def walk(spark, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_DIR), f"test-{name}"))
    return out


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = walk(spark, docs)
    for part in made[:-1]:
        assert part.dtypes == docs.dtypes
    rows = [p.collect() for p in made]
    judged = {r.doc_id: r for r in langid.identify(docs).collect()}
    want = [r for r in rows[0] if judged[r.doc_id].score >= corpus_pipeline.MIN_SCORE]
    assert Counter(rows[1]) == Counter(want)
    last = {}
    for r in rows[1]:
        last[r.text] = max(last.get(r.text, r), r, key=lambda x: x.doc_id)
    assert Counter(rows[2]) == Counter(last.values())
    near = {r.doc_id for r in minhash.near_duplicates(made[2]).collect() if r.kept}
    assert Counter(rows[3]) == Counter(r for r in rows[2] if r.doc_id in near)
    mixed = mixing.mix(made[3], ["doc_id"])[0].groupBy("row.doc_id").count()
    assert Counter(r.doc_id for r in rows[4]) == {r[0]: r[1] for r in mixed.collect()}
    assert set(rows[4]) == set(rows[3])
    words = Counter()
    for r in rows[5]:
        words[r.doc_id] += r.n_tokens
    want = Counter()
    for r in rows[4]:
        want[r.doc_id] += len(r.text.split())
    assert words == want
    run = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(run) == Counter(rows[5])


def test_odd_rows_pass(spark):
    rows = odd_rows()
    made = walk(spark, documents(spark, rows))
    kept = Counter((r.doc_id, r.text) for r in made[3].collect())
    assert max(kept.values()) == 1
    assert (2, rows[0][1]) not in kept or (3, rows[3][1]) not in kept
    assert (None, "alone without an id here") in kept
    assert all(r.text for r in made[4].collect())


def test_empty_table_passes(spark):
    for part in walk(spark, documents(spark, odd_rows()).where(F.lit(False))):
        assert part.count() == 0
