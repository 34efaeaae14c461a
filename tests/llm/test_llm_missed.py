"""Near-copy documents and lines that once were missed, or lines that once went astray."""

import random
from collections import defaultdict

import numpy as np
import pytest
from odd import documents

from starmart.llm import lines, minhash

LETTERS = "abcdefghijklmnopqrstuvwxyz"
HAN = [chr(0x4E00 + i) for i in range(3000)]


def plain_shingles(line, width=12):
    """Shingles from each character on, of a line of at least one."""
    return {line[i : i + width] for i in range(max(1, len(line) - width + 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_near_finds_pairs_within_a_family(spark):
    common = [f"same{i}" for i in range(300)]
    rows = []
    for k in range(120):
        rows.append((k, " ".join(common + [f"own{k}_{i}" for i in range(100)]), None, None))
    for k in range(20, 40):  # near copies of members that are no bucket's centre
        words = rows[k][1].split()
        words[350] = "changed"
        rows.append((1000 + k, " ".join(words), None, None))
    got = minhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i % 1000 for i, *_ in rows}


def test_lines_find_pairs_within_a_family(spark):
    rng = random.Random(4)
    common = "".join(rng.choice(LETTERS) for _ in range(300))
    rows = []
    for k in range(120):
        rows.append((k, common + "".join(rng.choice(LETTERS) for _ in range(90)), None, None))
    for k in range(20, 40):
        line = rows[k][1]
        rows.append((1000 + k, line[:350] + "0" + line[351:], None, None))
    got = lines.deduplicate_lines(documents(spark, rows)).collect()
    assert {r.doc_id for r in got if r.removed} == set(range(1020, 1040))


def test_lines_take_shingles_of_every_place(spark):
    rng = random.Random(8)
    han = "".join(rng.choice(HAN) for _ in range(120))
    url = "://example.org/" + "".join(rng.choice(LETTERS) for _ in range(80))
    short = "\U0001f600\U0001f601 tiny"
    texts = [han, han[0] + "新" + han[1:], "http" + url, "https" + url, short, short + "!"]
    for k in range(40):  # spaced lines with a character or two changed, kept or lost by the rule
        line = " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 9))) for _ in range(14))
        other = list(line)
        for _ in range(1 + k % 2):
            other[rng.randrange(len(other))] = "0"
        texts += [line, "".join(other)]
    sets = [plain_shingles(t) for t in texts]
    want = {i for i in range(1, len(texts), 2) if jaccard(sets[i - 1], sets[i]) >= 0.8}
    assert {1, 3} < want and 5 not in want and len(want) < len(texts) // 2
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    got = lines.deduplicate_lines(documents(spark, rows)).collect()
    assert {r.doc_id for r in got if r.removed} == want


def test_lines_of_small_buckets_need_no_prefix_filter(spark, monkeypatch):
    """Pairs below the bound keep buckets open; those of few lines are compared as they are."""
    rng = random.Random(12)
    rows = []
    for k in range(30):
        line = "".join(rng.choice(LETTERS) for _ in range(300))
        own = "".join(rng.choice(LETTERS) for _ in range(50 if k % 3 else 20))
        rows += [(2 * k, line, None, None), (2 * k + 1, line[: -len(own)] + own, None, None)]
    sets = [plain_shingles(r[1]) for r in rows]
    want = {i for i in range(1, 60, 2) if jaccard(sets[i - 1], sets[i]) >= 0.8}
    assert len(want) == 10 and all(jaccard(sets[i - 1], sets[i]) > 0.65 for i in range(1, 60, 2))
    filtered = []
    plain = lines.pairs_apart
    monkeypatch.setattr(lines, "pairs_apart", lambda *a: filtered.append(1) or plain(*a))
    got = lines.deduplicate_lines(documents(spark, rows)).collect()
    assert {r.doc_id for r in got if r.removed} == want
    assert not filtered


@pytest.mark.parametrize("union", [5, 10, 15, 30, 100])
def test_bands_find_sets_of_any_size(union):
    rng = np.random.default_rng(union)
    # four fifths of the union are in both sets
    all_of = rng.integers(0, 1 << 64, (20_000, union), dtype=np.uint64)
    same, part = union * 4 // 5, union * 9 // 10
    a, b = all_of[:, :part], np.delete(all_of, np.arange(same, part), axis=1)
    signed = [
        np.array(lines.bands(x.ravel(), np.arange(0, x.size + 1, x.shape[1]))) for x in (a, b)
    ]
    assert (signed[0] == signed[1]).any(axis=0).mean() >= 0.999


def test_lines_of_rows_that_share_an_id(spark):
    rows = [(None, "x dup\nunique A"), (None, "unique B\nx dup"), (3, "one more\nx dup"), (3, "x dup\nlast")]
    docs = documents(spark, [(*r, None, None) for r in rows])
    got = lines.deduplicate_lines(docs, with_text=True).collect()
    left = defaultdict(list)
    for r in got:
        assert r.n_lines - r.n_removed == len(r.text.split("\n"))
        left[r.doc_id] += r.text.split("\n")
    assert sorted(left[None]) == ["unique A", "unique B", "x dup"]
    assert sorted(left[3]) == ["last", "one more"]


def test_near_copies_without_an_id_are_linked(spark):
    """To a row with an id, and to each other; the id names the component where there is one."""
    rng = random.Random(31)
    base = [f"w{rng.randrange(10_000)}" for _ in range(200)]
    other = [f"v{rng.randrange(10_000)}" for _ in range(200)]

    def changed(words, at):
        return " ".join([*words[:at], "changed", *words[at + 1 :]])

    rows = [
        (1, " ".join(base), "en", "a"), (None, changed(base, 50), "en", "a"),
        (None, changed(base, 150), "en", "a"), (None, changed(base, 150), "en", "a"),
        (None, " ".join(other), "en", "a"), (None, changed(other, 20), "en", "a"), (9, "alone", "en", "a"),
    ]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    of_base = [r for r in found if r["component_id"] == 1]
    assert len(of_base) == 4 and sum(r["kept"] for r in of_base) == 1
    assert [r["component_id"] for r in found].count(None) == 2
