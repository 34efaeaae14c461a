"""Spelling groups, the conversation trie and toxicity against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from odd import documents, key, odd_rows

from starmart.llm import spelling, toxicity, trie

LETTERS = "abcdefghijklmnopqrstuvwxyzéß"


def plain_spellings(rows):
    """By comparing the words that are left when one letter is taken out."""
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    without = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            without[w[:i], w[i + 1 :]].add(w)
    near = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            near[w] |= without[w[:i], w[i + 1 :]] - {w}
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda u: (-words[u], u))
            if words[best] >= 10 * words[w]:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=repr)


def spelled(frame):
    return sorted((tuple(r) for r in spelling.group_spellings(frame).collect()), key=repr)


def edited(rng, word):
    i = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:i] + rng.choice(LETTERS) + word[i:]
    if kind == 1:
        return word[:i] + word[i + 1 :]
    return word[:i] + rng.choice(LETTERS) + word[i + 1 :]


def spelling_rows(seed):
    """Families of words under one stem, with edits of edits, at counts that differ much."""
    rng = random.Random(seed)
    stems = ["".join(rng.choices(LETTERS, k=rng.randint(6, 12))) for _ in range(12)]
    # one part that a third of all words share
    stems += ["commonstem" + "".join(rng.choices("abc", k=3)) for _ in range(60)]
    words = []
    for stem in stems:
        for _ in range(8):
            w = stem
            for _ in range(rng.randint(0, 3)):
                w = edited(rng, w)
            words += [w] * rng.choice((1, 2, 3, 30, 400))
    rng.shuffle(words)
    text = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)]
    return [(None if i % 17 == 3 else i, t, "en", "a") for i, t in enumerate(text)]


@pytest.mark.parametrize("crowd", [12, 10_000])
def test_spellings_equal_a_plain_version(spark, monkeypatch, crowd):
    """Also where buckets are cut again and again."""
    monkeypatch.setattr(spelling, "CROWD", crowd)
    rows = spelling_rows(3)
    want = plain_spellings([r[:2] for r in rows])
    assert spelled(documents(spark, rows)) == want
    assert any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want)


def test_spellings_of_odd_rows(spark):
    rows = odd_rows()
    long = "x" * 300 + "y" * 300
    rows += [(20, f"{long} {long} {long[1:]} {long[1:]} ÀÉÎ÷×ÿabc ÀÉÎ÷×ÿabc ÀÉÎ÷×ÿab ÀÉÎ÷×ÿab", None, None)]
    assert spelled(documents(spark, rows)) == plain_spellings([r[:2] for r in rows])


@pytest.mark.parametrize("rows", [[], [(1, None, "en", "a")], [(1, "short", "en", "a")]])
def test_no_word_no_spelling(spark, rows):
    assert spelled(documents(spark, rows)) == []


def test_a_bucket_of_more_than_64_words(spark):
    """All words near each other in two ways: the last letter, and one before it."""
    words = [f"sevenab{a}{b}" for a in "abcdefghij" for b in "klmnopqrstuvwxyz"]
    text = " ".join(w for i, w in enumerate(words) for _ in range(2 + 25 * (i % 7 == 0)))
    rows = [(1, text, "en", "a")]
    want = plain_spellings([r[:2] for r in rows])
    assert spelled(documents(spark, rows)) == want and {r[4] for r in want} >= {24}


def plain_trie(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for turns in own.values():
        turns.sort()
    seqs = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = own.get(conv - int(math.fmod(conv, 20)), [])
        seqs[conv] = tuple(t[1:] for t in base[:h] + turns[h:])
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for conv in sorted(seqs):
        for d in range(len(seqs[conv]) + 1):
            members[seqs[conv][:d]].append(conv)
        ends[seqs[conv]].append(conv)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, held in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(held) - 1) * words
            leaves[p[:d]] += not children[p]
    out = []
    for p, held in members.items():
        ids = ",".join(map(str, ends.get(p, [])))
        up = members[p[:-1]][0] if p else None
        digest = hashlib.sha256(ids.encode()).hexdigest()
        out.append((held[0], len(p), up, len(held), children[p], leaves[p], saved[p], digest))
    return sorted(out, key=repr)


def conversations(spark, rows):
    """Rows with columns named like the operator's own."""
    kinds = "conv_id long, turn long, role string, text string, conv long, n long, at long, d1 string"
    return spark.createDataFrame([(*r, 5, 6, 7, "z") for r in rows], kinds)


def trie_of(spark, rows):
    found = trie.prefix_trie(conversations(spark, rows))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def trie_rows(seed):
    """Groups of copies and of common beginnings, a long conversation twice, one of no own turn."""
    rng = random.Random(seed)
    rows = []
    for conv in range(-25, 140):
        if conv % 20 == 0 and conv in (40, 100):
            continue  # nothing to borrow
        family = conv // 10 % 3
        for turn in range(rng.choice((1, 2, 4, 5))):
            said = f"turn {turn} of {family}" if conv % 4 else rng.choice(("a b c", "", "d e"))
            rows.append((conv, turn, rng.choice(("user", "assistant")) if conv % 7 == 0 else "user", said))
    for conv in (201, 221, 222):
        rows += [(conv, t, "user", f"long {t % 5} x") for t in range(70 + conv % 2)]
    return rows


@pytest.mark.parametrize("limit, chunk", [(20_000, 4096), (30, 3), (3, 1)])
def test_trie_equals_a_plain_version(spark, monkeypatch, limit, chunk):
    """Swept at once, burst a little, and burst to the end; totals over one chunk and many."""
    monkeypatch.setattr(trie, "LIMIT", limit)
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = trie_rows(4)
    assert trie_of(spark, rows) == plain_trie(rows)


def test_ids_of_one_node_in_many_pieces(spark, monkeypatch):
    """A hash over ids that were joined in several tasks."""
    monkeypatch.setattr(trie, "LIMIT", 3)
    monkeypatch.setattr(trie, "_PIECE", 10)
    rows = [(c, t, "user", "same") for c in range(300) for t in range(4)]
    assert trie_of(spark, rows) == plain_trie(rows)


def test_trie_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (1, None, None, None), (1, None, "user", "first"), (1, 2, "user", "b"), (1, 2, "user", "a"),
        (1, 2, "user", "a"), (2, 1, "", ""), (2, 2, "user", long), (3, 1, "us", "erx"),
        (3, 2, "user", "x"), (None, 1, "user", "no conversation"), (20, 5, "user", long),
        (21, 1, "user", "x"), (22, 1, "user", "x"), (22, 2, "user", long), (23, 1, "user", long),
        (23, 1, "user", long), (23, 3, "user", "z"), (23, 4, "user", "z"), (23, 5, "user", "é"),
    ]
    assert trie_of(spark, rows) == plain_trie(rows)


def test_no_conversation_no_node(spark):
    assert trie_of(spark, []) == [] and trie_of(spark, [(None, 1, "user", "x")]) == []


LABELS = "doc_id long, quality int, toxic int, score double, text string"


def labels(spark, rows):
    return spark.createDataFrame([(d, 1, t, 0.5, "z") for d, t in rows], LABELS)


def teaches(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 != 1


def test_toxicity_learns_what_only_pairs_tell(spark):
    """Neither of two terms is toxic by itself, and both together are; judged on the other fold."""
    rng = random.Random(9)
    calm = [f"calm{a}{b}" for a in "abcdefgh" for b in "ijklmnop"]
    rows, marks = [], []
    for doc_id in range(1500):
        terms = rng.choices(calm, k=rng.randint(3, 30))
        insult, group = doc_id % 4 in (1, 3), doc_id % 4 in (2, 3)
        terms += ["dreckskerl"] * insult + ["nachbarn"] * group
        rng.shuffle(terms)
        rows.append((doc_id, " ".join(terms), "en", "a"))
        marks.append((doc_id, int(insult and group)))
    found = toxicity.judge_toxicity(documents(spark, rows), labels(spark, marks)).collect()
    truth = dict(marks)
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if not teaches(d)}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.99 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found)


def test_toxicity_reads_whole_long_texts_and_no_held_out_label(spark):
    """An inflected insult at the end of a long text counts; labels of the other fold do not."""
    rng = random.Random(2)
    calm = [f"word{a}{b}{c}" for a in "abcdefgh" for b in "ijklmnop" for c in "qrs"]
    rows, marks = [], []
    for doc_id in range(1200):
        terms = rng.choices(calm, k=2000 if doc_id % 100 == 0 else 40)
        toxic = doc_id % 5 == 0
        terms += [f"lowei{rng.choice(('der', 'ung', 'heit', 'o', 'isch'))}."] * toxic
        rows.append((doc_id, " ".join(terms), "de", "a"))
        marks.append((doc_id, int(toxic) if teaches(doc_id) else 1 - int(toxic)))
    found = toxicity.judge_toxicity(documents(spark, rows), labels(spark, marks)).collect()
    assert all(r["predicted"] == (r["doc_id"] % 5 == 0) for r in found)


def test_toxicity_of_odd_rows(spark):
    rows = odd_rows()
    marks = [(1, 1), (1, 0), (4, None), (5, 0), (9, 0), (10, 0), (None, 1), (99, 1)]
    found = toxicity.judge_toxicity(documents(spark, rows), labels(spark, marks)).collect()
    assert sorted((key(r["doc_id"]) for r in found)) == sorted(key(r[0]) for r in rows)
    empty = {r["score"] for r in found if r["doc_id"] in (6, 7)}
    assert len(empty) == 1 and all(r["held_out"] is not None for r in found)


@pytest.mark.parametrize("marks, base", [([], 0.0), ([(d, 1) for d in range(14)], 1.0)])
def test_toxicity_without_two_labels(spark, marks, base):
    found = toxicity.judge_toxicity(documents(spark, odd_rows()), labels(spark, marks)).collect()
    assert {r["score"] for r in found} == {base}
    assert toxicity.judge_toxicity(documents(spark, []), labels(spark, marks)).collect() == []
