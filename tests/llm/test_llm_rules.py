"""Language, mixing, secrets, packing, quality and URL operators against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations
from zlib import crc32

import numpy as np
import pytest
from odd import LONG, documents, odd_rows
from pyspark.sql import functions as F

from starmart.llm import langid, mixing, packing, quality, secrets, urlfilter

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# language


def test_language_of_the_held_out_fold(docs):
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].held_out == (crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= got[r.doc_id].score <= 1
    fold = [r for r in rows if got[r.doc_id].held_out and r.lang]
    right = sum(got[r.doc_id].lang_pred == r.lang for r in fold)
    assert len(fold) > 20 and right >= 0.97 * len(fold)


def test_language_learns_nothing_from_the_held_out_fold(spark, docs):
    fold = langid.held_out(F.col("doc_id"))
    other = docs.withColumn("lang", F.when(fold, "xx").otherwise(F.col("lang")))
    a = langid.identify(docs).orderBy("doc_id").collect()
    assert a == langid.identify(other).orderBy("doc_id").collect()


def test_filter_shares_equal_those_of_sets(docs):
    model = langid.fit(docs)
    assert len(model.langs) == 4 and (model.chance < 1e-3).all()
    grams = {}
    for k, lang in enumerate(model.langs):
        count = Counter()
        for r in docs.where(F.col("lang") == lang).collect():
            data = np.frombuffer(f" {r.text.lower()} ".encode(), np.uint8)
            count.update(langid._grams(data).tolist())
        top = sorted(count, key=lambda g: (-count[g], g))[: langid.PROFILE]
        grams[k] = set(top)
    texts = [f" {r.text.lower()} ".encode() for r in docs.limit(30).collect()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    shares = langid._shares(model, data, offsets)
    for i, t in enumerate(texts):
        own = langid._grams(np.frombuffer(t, np.uint8)).tolist()
        for k in grams if len(own) >= 200 else ():
            assert abs(shares[i, k] - sum(g in grams[k] for g in own) / len(own)) < 0.01


def test_language_odd_rows(spark):
    rows = odd_rows()
    got = langid.identify(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    letterless = Counter(r[0] for r in rows if not re.search(r"[^\W\d_]", r[1] or ""))
    assert Counter(r.doc_id for r in got if r.lang_pred == "und") == letterless
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert langid.identify(documents(spark, [(1, "abc def", None, None)])).first().lang_pred == "und"
    assert langid.identify(documents(spark, rows).where(F.lit(False))).count() == 0


# mixing


def test_mixture_keeps_every_row_and_limits_repeats(spark):
    rng = random.Random(1)
    sizes = {"big": 600, "mid": 120, "small": 15, None: 60}
    rows = [
        (i, " ".join("w" for _ in range(rng.randint(20, 60))), None, s)
        for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))
    ]
    mixture, weights = mixing.mix(documents(spark, rows), ["doc_id"], block_tokens=200)
    got = mixture.select("row.doc_id", "source", "n_tokens", "epoch", "place").collect()
    w = {(None if r.key.none else r.key.name): r for r in weights.collect()}
    assert math.isclose(sum(r.weight for r in w.values()), 1)
    assert math.isclose(max(r.epochs for r in w.values()), 2, rel_tol=1e-4)
    assert math.isclose(w["big"].epochs, 1, rel_tol=1e-4)
    alpha = w["big"].alpha
    power = {s: r.tokens**alpha for s, r in w.items()}
    for s, r in w.items():
        assert math.isclose(r.weight, power[s] / sum(power.values()), rel_tol=1e-6)
        drawn = sum(x.n_tokens for x in got if x.source == s)
        assert r.budget - 1 <= drawn <= r.budget + 260  # at most one block too many
    times = Counter(x.doc_id for x in got)
    assert set(times) == {r[0] for r in rows} and max(times.values()) <= 2
    assert len({(x.doc_id, x.epoch) for x in got}) == len(got)
    assert all(0 <= x.place <= 1 for x in got)
    half = sum(x.n_tokens for x in got if x.place < 0.5 and x.source == "big")
    assert abs(half / sum(x.n_tokens for x in got if x.place < 0.5) - w["big"].weight) < 0.1


def test_mixture_to_an_entropy_and_a_budget(spark):
    rows = [(i, "a b c d", None, "x" if i % 10 else "y") for i in range(1000)]
    frame = documents(spark, rows)
    _, weights = mixing.mix(frame, ["doc_id"], target_entropy=0.6, block_tokens=8)
    found = [r.weight for r in weights.collect()]
    assert math.isclose(-sum(p * math.log(p) for p in found), 0.6, abs_tol=1e-3)
    mixture, weights = mixing.mix(
        frame, ["doc_id"], target_entropy=0.6, token_budget=1000, block_tokens=8
    )
    tokens = mixture.agg(F.sum("n_tokens")).first()[0]
    assert 1000 <= tokens <= 1100


def test_mixture_odd_rows(spark):
    rows = odd_rows()
    mixture, _ = mixing.mix(documents(spark, rows), ["doc_id", "text", "row", "key"])
    got = mixture.where("epoch = 0").select("row.*").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(r[:2] for r in rows)
    assert mixing.mix(documents(spark, rows).where(F.lit(False)), ["doc_id"])[0].count() == 0


# secrets


PLAIN = {
    "assign": re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.A,  # the letters s and k have other cases outside ASCII
    ),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def plain_spans(text):
    out = []
    least = {"assign": 12, "access": 18, "hex": 16}
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text or ""):
            if len(m.group(2 if kind == "assign" else 0)) >= least[kind]:
                out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def secret_texts():
    rng = random.Random(4)
    parts = [
        "password", "PassWd", "token", "api_key", "APIKEY", "secret", "=", ":", " = ", "'", '"',
        "abcdefghijkl", "deadbeefdeadbeef", "0123456789abcdef0", "AKIA", "AKIAABCDEFGHIJKLMN", "\n",
        "é", "\U0001f600", " ", "short", "AKIA1234567890", "ghp_" + "a1B2" * 9, "://me:pw@host",
        "-----BEGIN RSA PRIVATE KEY-----", "xoxb-1234567890-ab", "ſecret=abcdefghijklm",
    ]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(400)]


def test_secrets_equal_plain_matching(spark):
    rows = [(i, t, None, None) for i, t in enumerate(secret_texts())]
    rows += [(1000, None, None, None), (1000, "token=abcdefghijkl", None, None), (None, "x", "", "")]
    rows += [(1001, LONG + " password: aaaaaaaaaaaa1 " + LONG, None, None)]
    got = secrets.find_secrets(documents(spark, rows)).collect()
    want = Counter(
        (r[0], hashlib.sha256(plain_spans(r[1]).encode()).hexdigest()) for r in rows
    )
    assert Counter((r.doc_id, r.base_sha256) for r in got) == want
    base = {r[0]: plain_spans(r[1]) for r in rows if r[0] is not None and r[0] < 1000}
    for r in got:
        if r.doc_id in base:
            spans = [s for s in r.spans.split(",") if s.split(":")[0] in PLAIN]
            assert ",".join(spans) == base[r.doc_id]
            assert r.n_hex == sum(s.startswith("hex:") for s in spans)
    kinds = {s.split(":")[0] for r in got for s in r.spans.split(",")}
    assert {"github", "login", "pem", "slack"} <= kinds


def test_trigram_queries_miss_no_match():
    for rule in secrets.BASE + secrets.MORE:
        query = secrets.trigram_query(rule.pattern)
        for text in secret_texts():
            for m in re.finditer(rule.pattern, text, re.A):
                low = m.group().lower()
                assert not query or any(all(t in low for t in clause) for clause in query)
    assert secrets.trigram_query("[0-9a-f]{16,}") == []
    assert secrets.trigram_query("abcd|xy[0-9]+wxyz") == [
        {"abc", "bcd"},
        {"wxy", "xyz"},
    ] or len(secrets.trigram_query("abcd|xy[0-9]+wxyz")) == 2


def test_secrets_of_no_rows(spark):
    assert secrets.find_secrets(documents(spark, odd_rows()).where(F.lit(False))).count() == 0
    assert secrets.find_secrets(documents(spark, odd_rows())).count() == len(odd_rows())


# packing


def test_boundaries_are_optimal():
    rng = random.Random(2)
    for _ in range(40):
        lengths = np.array(sorted(rng.sample(range(1, 60), rng.randint(1, 9))))
        counts = np.array([rng.randint(1, 50) for _ in lengths])
        k = rng.randint(1, 5)
        best = min(
            int(sum(c * min(b for b in chosen if b >= x) for x, c in zip(lengths, counts, strict=True)))
            for n in range(1, min(k, len(lengths)) + 1)
            for chosen in combinations(lengths.tolist(), n)
            if chosen[-1] == lengths[-1]
        )
        bounds, cost = packing.boundaries(lengths, counts, k)
        assert cost == best and len(bounds) <= k
        padded = sum(c * min(b for b in bounds if b >= x) for x, c in zip(lengths, counts, strict=True))
        assert padded == best


def test_boundaries_of_many_lengths():
    rng = np.random.default_rng(5)
    lengths = np.sort(rng.choice(np.arange(1, 8193), 400, replace=False))
    counts = rng.integers(1, 10**6, 400)
    below = np.concatenate(([0], np.cumsum(counts)))
    cost = [int(c) for c in lengths * below[1:]]
    for _ in range(15):  # every end of the bucket before is tried
        cost = [
            min([cost[j]] + [cost[i] + int(lengths[j] * (below[j + 1] - below[i + 1])) for i in range(j)])
            for j in range(400)
        ]
    bounds, best = packing.boundaries(lengths, counts, 16)
    assert best == cost[-1] and len(bounds) <= 16
    assert best == sum(int(c) * min(b for b in bounds if b >= x) for x, c in zip(lengths, counts, strict=True))


def test_rows_without_an_id_fill_many_shards(spark):
    text = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("one of many rows"))
    docs = spark.range(0, 6000, 1, 4).select(F.lit(None).cast("long").alias("doc_id"), text.alias("text"))
    got = packing.pack(docs, shard_rows=500).groupBy("bucket", "shard").count().collect()
    assert sum(r["count"] for r in got) == 6000 and max(r["count"] for r in got) < 700


def test_batches_hold_every_word_once(docs):
    got = packing.pack(docs, max_tokens=256, buckets=6, batch_tokens=2048, shard_rows=50).collect()
    words = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    total, batches = Counter(), defaultdict(list)
    for r in got:
        total[r.doc_id] += r.n_tokens
        batches[r.bucket, r.shard, r.batch].append(r)
        assert r.padding == r.bucket - r.n_tokens >= 0
    assert total == words and len({r.bucket for r in got}) <= 6
    for (bucket, *_), rows in batches.items():
        assert len(rows) * bucket <= 2048 or len(rows) == 1
        assert sorted(r.slot for r in rows) == list(range(len(rows)))


def test_packing_odd_rows(spark):
    rows = odd_rows()
    got = packing.pack(documents(spark, rows)).collect()
    want = Counter()
    for r in rows:
        want[r[0]] += max(1, -(-len(WORD.findall(r[1] or "")) // packing.MAX_TOKENS))
    assert Counter(r.doc_id for r in got) == want
    assert packing.pack(documents(spark, rows).where(F.lit(False))).count() == 0


# quality


def plain_quality(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    again = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(again),
        len(w) < 50 or 100 * len(again) > 50 * len(w),
    )


def statistics(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_quality_equals_plain_counts(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = odd_rows() + [(r.doc_id + 1000, r.text, None, None) for r in docs.collect()]
    rng = random.Random(8)
    rows += [
        (9000 + k, " ".join(rng.choice("ab|\n") for _ in range(rng.randint(0, 90))), None, None)
        for k in range(80)
    ]
    got = quality.filter_quality(documents(spark, rows), labels).collect()
    assert Counter((r.doc_id, *statistics(r)) for r in got) == Counter(
        (r[0], *plain_quality(r[1])) for r in rows
    )
    assert all(not r.kept for r in got if r.base_failed)


def test_quality_ratio_is_the_plain_one(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1 and toxic = 0")
    ratios = quality.fit_ratios(docs, labels)
    trusted = {r.doc_id for r in labels.collect()}
    grams = quality.with_features(docs.select("doc_id", "text")).select("doc_id", "grams").collect()
    size = 1 << quality.LOG_BUCKETS
    raw, target = np.ones(size), np.ones(size)
    for r in grams:
        np.add.at(raw, r.grams, 1)
        if r.doc_id in trusted:
            np.add.at(target, r.grams, 1)
    want = np.log(target / target.sum()) - np.log(raw / raw.sum())
    assert np.allclose(ratios, want)
    got = {r.doc_id: r.score for r in quality.judge(docs, ratios).collect()}
    for r in grams:
        plain = want[r.grams].mean() if r.grams else 0
        assert abs(got[r.doc_id] - plain) < 1e-5


def test_quality_tells_labels_apart(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = quality.filter_quality(docs, labels).join(labels, "doc_id").collect()
    clean = [r for r in got if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    junk = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in junk) <= 0.2 * len(junk)


def test_quality_without_labels(spark):
    docs = documents(spark, odd_rows())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.filter_quality(docs, none).collect()
    assert all(r.kept != r.base_failed for r in got) and len(got) == len(odd_rows())
    assert quality.filter_quality(docs.where(F.lit(False)), none).count() == 0


# urls


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        r
        for r in urlfilter.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


URLS = [
    "http://A.Example.ORG/es/1", "https://example.org/en/17", "http://example.org/en/2", "x://com",
    "http://a.com/fr/?x", "http://a.com/de/#y", "http://b.a.com/en/", "http://b.com/de/3", None, "no",
    "http://", "http://org", "http://org/", "http://c.net/a://b/fr/", "ftp://É.com/de/?q=/fr/", "", "://x.org/a",
    "http://notexample.org/es/1",
]


def pages_of(spark, links):
    rows = [(i, u, links.get(i), "extra", "clash") for i, u in enumerate(URLS)]
    return spark.createDataFrame(rows + rows[:2], "page_id long, url string, html string, host string, rule string")


def plain_ranks(links):
    """Trust and distrust by host, as the solution of the linear system."""
    parsed = [plain_rule(u) for u in URLS + URLS[:2]]
    html = [links.get(i) for i in [*range(len(URLS)), 0, 1]]
    weights = Counter()
    for (host, *_), text in zip(parsed, html, strict=True):
        for to in re.findall(r'href="(?:[a-z]+:)?//([^"/?#]*)', text or ""):
            if host and to and host != to.lower():
                weights[host, to.lower()] += 1
    hosts = sorted({h for e in weights for h in e} | {p[0] for p in parsed})

    def rank(edges, kind):
        seeds = Counter(p[0] for p in parsed if p[3] == kind)
        v = np.array([seeds[h] / max(1, sum(seeds.values())) for h in hosts])
        m = np.zeros((len(hosts), len(hosts)))
        for (a, b), w in edges.items():
            m[hosts.index(b), hosts.index(a)] = w
        m = m / np.maximum(m.sum(0), 1e-300)
        r = np.linalg.solve(np.eye(len(hosts)) - 0.85 * m, 0.15 * v)
        return dict(zip(hosts, r, strict=True))

    back = {(b, a): w for (a, b), w in weights.items()}
    return rank(weights, "allow"), rank(back, "block")


def test_urls_equal_plain_rules_and_ranks(spark):
    links = {
        6: '<a href="http://b.com/x">1</a><A class=q href="//a.com">2</A><a href="/own">3</a>',
        0: '<a href="http://c.net/">x</a> <a href="http://c.net/2">x</a>',
        3: '<a href="http://a.com/">back</a>',
        9: "",
        13: '<a href="http://a.example.org/">x</a><a href="http://b.com">y</a>',
        5: '<link rel=x href="https://B.com">',
        14: "no links",
    }
    got = urlfilter.judge_urls(pages_of(spark, links)).collect()
    assert len(got) == len(URLS) + 2
    trust, distrust = plain_ranks(links)
    for r in got:
        host, path, rule, verdict = plain_rule(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert math.isclose(r.trust, trust[host], abs_tol=1e-6)
        assert math.isclose(r.distrust, distrust[host], abs_tol=1e-6)
        own = "block" if r.distrust > urlfilter.DISTRUST_RATIO * r.trust else "allow"
        assert r.verdict == (verdict or own)
    assert any(r.verdict == "block" and r.rule is None for r in got)


def test_urls_of_no_rows(spark):
    assert urlfilter.judge_urls(pages_of(spark, {}).where(F.lit(False))).count() == 0


def test_a_chain_of_links_is_judged_to_its_start(spark):
    """21 hosts, each linking to the next, the last to a blocked one: all that lead there go."""
    rows = [(n, f"http://h{n}.net/", f'<a href="http://h{n + 1}.net/">on</a>') for n in range(20)]
    rows += [(20, "http://h20.net/", '<a href="http://bad.com/">on</a>')]
    rows += [(21, "http://bad.com/de/1", None), (22, "http://bank.co.uk/", None)]
    rows += [(23, "http://shop.co.uk/", '<a href="http://bad.com/">on</a>'), (24, "http://10.0.0.1/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r for r in urlfilter.judge_urls(pages).collect()}
    assert all(got[f"h{n}.net"].verdict == "block" for n in range(21))
    assert got["shop.co.uk"].verdict == "block"
    # a shared suffix is no link
    assert got["bank.co.uk"].verdict == got["10.0.0.1"].verdict == "allow"
    assert got["bank.co.uk"].distrust == 0


def test_ranks_that_never_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "MOST_ROUNDS", 8)
    rows = [(n, f"http://h{n}.net/", f'<a href="http://h{n + 1}.net/">on</a>') for n in range(20)]
    rows += [(20, "http://h20.com/de/", None), (21, "http://h20.net/", '<a href="http://h20.com/">')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    with pytest.raises(RuntimeError, match="not settled"):
        urlfilter.judge_urls(pages)


def test_budgets_hold_for_rows_without_an_id(spark):
    """A third of all rows has no id, or shares one: they are told apart by their texts."""
    rows = [(None, f"lost {i} " + "w " * 48, "en", "a") for i in range(4000)]
    rows += [(7, f"same {i} " + "w " * 48, "en", "b") for i in range(4000)]
    rows += [(i, f"own {i} " + "w " * 48, "en", "c") for i in range(100, 4100)]
    mixture, weights = mixing.mix(
        documents(spark, rows), ["doc_id"], token_budget=300_000, block_tokens=1000
    )
    drawn = {r["source"]: r["n"] for r in mixture.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    assert {w["budget"] for w in weights.collect()} == {100_000.0}
    assert all(98_000 <= n <= 104_000 for n in drawn.values())
