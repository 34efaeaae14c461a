"""Exact, near, line and byte-string duplicates against plain versions."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from odd import documents, odd_rows
from pyspark.sql import functions as F

from starmart.llm import exact, lines, minhash, phrases
from starmart.llm.components import components

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def alike(a, b, percent=80):
    return bool(a | b) and 100 * len(a & b) >= percent * len(a | b)


# exact copies


def test_exact_equals_grouping(spark):
    rows = odd_rows()
    got = exact.deduplicate(documents(spark, rows)).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    assert len(got) == len(rows)
    for r in got:
        (ids,) = [
            v for t, v in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256
        ]
        assert r.doc_id in ids and r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in got) == len(groups)


def test_exact_tells_blocks_apart(spark, monkeypatch):
    monkeypatch.setattr(exact, "BLOCK", 4)
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 22))) for _ in range(300)]
    texts += ["abcd" * k for k in range(1, 12)] + ["abcd" * 5]
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in exact.deduplicate(docs).collect()}
    last = {t: i for i, t in enumerate(texts)}
    sizes = Counter(texts)
    assert all(got[i].keep_id == last[t] for i, t in enumerate(texts))
    assert all(got[i].group_size == sizes[t] for i, t in enumerate(texts))


def test_exact_forgets_blocks_safely(spark, monkeypatch):
    monkeypatch.setattr(exact, "REMEMBERED", 100)
    docs = documents(spark, [(i, f"text {i % 7}", None, None) for i in range(60)])
    got = exact.deduplicate(docs).collect()
    assert sorted(r.doc_id for r in got if r.kept) == list(range(53, 60))


# near copies


def sets_of(texts, width):
    out = []
    for t in texts:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER))
        whole = {tuple(w)} if w else set()
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or whole)
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_near_equals_all_pairs(spark, width):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    rows = [(r.doc_id, r.text, None, None) for r in docs]
    rng = random.Random(width)
    for k in range(60):  # copies with a share of the words changed
        words = rows[k][1].split()[:200]
        for _ in range(rng.randint(1, 1 + len(words) // 20)):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        rows.append((10_000 + k, " ".join(words).upper(), None, None))
        rows.append((20_000 + k, " ".join(rows[k][1].split()[:200]), None, None))
    sets = sets_of([r[1] for r in rows], width)
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if alike(sets[a], sets[b])]
    want = roots(len(rows), links)
    got = minhash.near_duplicates(documents(spark, rows), width=width)
    got = {r.doc_id: r for r in got.collect()}
    for i, (doc_id, *_) in enumerate(rows):
        assert got[doc_id].n_shingles == len(sets[i])
        assert got[doc_id].component_id == rows[want[i]][0]
        assert got[doc_id].kept == (want[i] == i)


def test_near_links_a_chain(spark):
    words = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(30):
        rows.append((k, " ".join(words), None, None))
        words = [f"x{k}_{i}" for i in range(8)] + words[:-8]
    got = minhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_near_odd_rows(spark):
    rows = odd_rows()
    got = minhash.near_duplicates(documents(spark, rows), width=4).collect()
    assert len(got) == len(rows)
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == {(297, 1, True)} and by_id[2] == {(297, 1, False)}
    assert {c for _, c, _ in by_id[3]} == {1} and {c for _, c, _ in by_id[4]} == {4}
    assert by_id[5] == {(0, 5, True)} and by_id[6] == {(0, 6, True)} and by_id[7] == {(0, 7, True)}
    assert by_id[10] == {(1, 10, True)}
    assert {c for _, c, _ in by_id[13]} == {9}
    assert by_id[None] == {(297, 1, False), (2, None, False), (0, None, False)}


def test_signature_of_few_hashes_fills_every_bin():
    probes = minhash._probes(240)
    for n in (1, 2, 5, 300):
        hashes = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
        values = minhash.signature(hashes, probes)
        assert len(values) == 240 and set(values) <= set(hashes)


def test_signature_agreement_estimates_similarity():
    probes, rng = minhash._probes(240), np.random.default_rng(0)
    same = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 450, dtype=np.uint64) * np.uint64(2)
        a, b = np.sort(pool[:400]), np.sort(pool[50:])
        same.append((minhash.signature(a, probes) == minhash.signature(b, probes)).mean())
    assert abs(np.mean(same) - 350 / 450) < 0.02


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100)}
    assert components(frame.where("a < 0")).count() == 0


# lines


def plain_lines(rows):
    places, sets = defaultdict(list), {}
    for doc_id, text, *_ in rows:
        doc_id = -1 if doc_id is None else doc_id
        for at, line in enumerate((text or "").split("\n")):
            if re.search("[^\x20\x09-\x0d]", line):
                line = line.strip(" ").lower()
                places[line].append((doc_id, at))
                sets[line] = {line[i : i + 12] for i in range(max(1, len(line) - 11))}
    names = list(sets)
    want = roots(
        len(names),
        [
            (a, b)
            for a, b in combinations(range(len(names)), 2)
            if 5 * min(len(sets[names[a]]), len(sets[names[b]]))
            >= 4 * max(len(sets[names[a]]), len(sets[names[b]]))
            and alike(sets[names[a]], sets[names[b]])
        ],
    )
    first, gone = {}, defaultdict(set)
    for name, root in zip(names, want, strict=True):
        first[root] = min([first.get(root, (1 << 60, 0)), *places[name]])
    for name, root in zip(names, want, strict=True):
        for doc_id, at in places[name]:
            if (doc_id, at) != first[root]:
                gone[doc_id].add(at)
    return gone


def test_lines_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").limit(120).collect()
    rows = [(r.doc_id, r.text, None, None) for r in docs]
    for k in range(40):
        line = max(rows[k][1].split("\n"), key=len).split()
        line[len(line) // 2] = "other"
        rows.append((5000 + k, "start\n" + " ".join(line).upper() + "\nend", None, None))
    gone = plain_lines(rows)
    got = lines.deduplicate_lines(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: set(r.removed) for r in got} == {r[0]: gone[r[0]] for r in rows}


def test_lines_odd_rows(spark):
    rows = odd_rows()
    gone = plain_lines(rows)
    got = lines.deduplicate_lines(documents(spark, rows), with_text=True).collect()
    assert len(got) == len(rows)
    for r in got:
        assert set(r.removed) == gone[-1 if r.doc_id is None else r.doc_id]
        if r.doc_id == 12:
            assert r.text == "one\ntwo\n" and r.n_lines == 4 and r.n_removed == 2


# repeated byte strings


def plain_bytes(rows, length):
    """Starts by content over all documents, as sets of whole strings."""
    data = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(
        d[i : i + length] for d in data for i in range(len(d) - length + 1)
    )
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        yield len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def passages(seed):
    """Texts that share passages of about the length asked for, at any place and any overlap."""
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choice("abcdef ghi\n") for _ in range(n))

    shared = [prose(n) for n in (398, 399, 400, 401, 430, 700, 1500)]
    texts = []
    for _ in range(60):
        out = prose(rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, max(0, len(p) - 300))
            out += p[a : a + rng.randint(200, 1200)] + prose(rng.randint(0, 200))
        texts.append(out)
    texts += ["a" * 900, "ab" * 700, "xyz" + "ab" * 300, texts[0], texts[0][5:], "é" * 500, "q" * 399]
    texts += ["ä" * 3 + shared[5] + "z", None, ""]
    return [(i, t, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_equal_all_windows(spark, seed):
    rows = passages(seed)
    got = phrases.repeated_bytes(documents(spark, rows).repartition(5))
    got = {r.doc_id: r for r in got.collect()}
    assert len(got) == len(rows)
    for (doc_id, *_), want in zip(rows, plain_bytes(rows, 400), strict=True):
        r = got[doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, doc_id


def test_bytes_of_other_lengths(spark):
    rows = passages(7)
    got = phrases.repeated_bytes(documents(spark, rows), length=100, reach=8)
    got = {r.doc_id: r for r in got.collect()}
    for (doc_id, *_), want in zip(rows, plain_bytes(rows, 100), strict=True):
        r = got[doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, doc_id
    with pytest.raises(ValueError):
        phrases.repeated_bytes(documents(spark, rows), length=50, reach=40)


def test_bytes_odd_rows(spark):
    rows = odd_rows()
    got = phrases.repeated_bytes(documents(spark, rows)).collect()
    want = Counter(
        (r[0], *w) for r, w in zip(rows, plain_bytes(rows, 400), strict=True)
    )
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_empty_tables(spark):
    docs = documents(spark, odd_rows()).where(F.lit(False))
    for made in (
        exact.deduplicate(docs),
        minhash.near_duplicates(docs),
        lines.deduplicate_lines(docs),
        phrases.repeated_bytes(docs),
    ):
        assert made.count() == 0


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in found.mkString(",").split(",") if "/shuffle_" in name}


def test_lines_leave_no_shuffle_files_behind(spark):
    line = "a line of some length that two documents share with a small change at its end"
    rows = [(k, f"{line} {k % 10}\nalone {k} " + "xyz" * k, None, None) for k in range(40)]
    docs, before = documents(spark, rows), shuffle_files(spark)
    gone = lines.duplicate_lines(docs)
    deadline = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < deadline:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert gone.count() == 39
