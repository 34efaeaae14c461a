"""Spelling variants: words one edit apart, by a bit-sliced position index.

Words one edit apart agree before the edit and after it, so of any cut of the shorter one either
the part before the cut or the part behind it is the same. Words are gathered in buckets by such a
part; a bucket of more than ``CROWD`` words is cut again, which leaves small ones in the end (words
that agree in all but one place). Within a bucket a bit set over its words is held for each
position and letter, and each word runs through them: sets of the words met without an error, with
a replaced, an added or a missing letter, each with the positions shifted accordingly, are carried
on letter by letter, 64 words in one number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import stored, tasks_for

MIN_LETTERS = 7
MIN_COUNT = 2
# A form's count is so many times the word's.
FACTOR = 10
SLIP = 31
# A bucket of more words is cut further. Words that agree in all but one place, of one letter or
# of two in the longer, are under 91 + 91 * 91, as the alphabet has 90 letters.
CROWD = 10_000
# Bytes of bit sets held at a time, unless one bucket takes more.
INDEX_BYTES = 32 << 20
_BATCH_WORDS = 20_000
_LETTERS = 91
# Words of buckets handled by one task.
_TASK_WORDS = 100_000
_RUN = r"[A-Za-zÀ-ÿ]{%d,}" % MIN_LETTERS
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NEVER = 1 << 30


def occurrences(docs: DataFrame) -> DataFrame:
    """``word`` of each run of letters that keeps ``MIN_LETTERS`` of them, after its slip if any."""
    # a run that is too short before a letter goes is too short after it
    text = F.coalesce(F.col("text"), F.lit(""))
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(_RUN), F.lit(0))).alias("run"),
    ).select("id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    runs = runs.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.left("run", at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= MIN_LETTERS)


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words that occur often enough, counted map-side first."""
    counts = occurrences(docs).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


def _halves(rows: DataFrame) -> DataFrame:
    """Both buckets of each row's: the first half of what is open agrees, or the second.

    ``s`` is the length of the bucket's shorter words, whose first ``lo`` and last ``hi`` letters
    agree. ``x`` keeps a pair out of all buckets but one: pairs that agree in the first ``x``
    letters are met elsewhere.
    """
    half = F.expr("(s - lo - hi) div 2")
    first = F.struct((F.col("lo") + half).alias("lo"), F.col("hi"), F.col("x"))
    second = F.struct(
        F.col("lo"), F.expr("s - lo - (s - lo - hi) div 2").alias("hi"),
        F.least(F.col("x"), F.col("lo") + half).alias("x"),
    )
    rows = rows.select("word", "n", "s", F.explode(F.array(first, second)).alias("cut"))
    return rows.select("word", "n", "s", "cut.lo", "cut.hi", "cut.x", _key("cut").alias("key"))


def _key(cut: str) -> Column:
    """A hash of what agrees; two buckets under one would be met as one, with the same pairs."""
    return F.xxhash64(
        "s", f"{cut}.lo", f"{cut}.hi", f"{cut}.x",
        F.left("word", F.col(f"{cut}.lo")), F.right("word", F.col(f"{cut}.hi")),
    )


def buckets(words: DataFrame) -> DataFrame:
    """``word, n, s, lo, hi, x, key``: every word in each bucket that holds another one."""
    # a word is met by those as long, and by those one letter longer or shorter
    rows = words.withColumn("s", F.explode(F.array(F.length("word"), F.length("word") - 1)))
    rows = _halves(rows.select("word", "n", "s", F.lit(0).alias("lo"), F.lit(0).alias("hi"),
                               F.lit(_NEVER).alias("x")))
    done = None
    while True:
        rows = stored(rows, "cut-words")
        sizes = rows.groupBy("key").agg(
            F.count("*").alias("size"), F.max(F.expr("s - lo - hi")).alias("open")
        )
        sizes = stored(sizes.where("size > 1"), "cut-sizes")
        rows = rows.join(sizes, "key")
        crowded = (F.col("size") > CROWD) & (F.col("open") > 1)
        ready = rows.where(~crowded).drop("size", "open")
        done = ready if done is None else done.unionByName(ready)
        if not sizes.where(crowded).head(1):
            return done
        rows = _halves(rows.where(crowded))


_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 8)], np.uint8)


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points, one word a row, with zeros behind."""
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


class _Batch:
    """Buckets of one length, side by side: 64 words of a bucket in each block."""

    def __init__(self, words: list[str], starts: np.ndarray, s: int) -> None:
        n = len(words)
        sizes = np.diff(np.append(starts, n))
        self.blocks = -(-sizes // 64)
        self.first = np.concatenate(([0], np.cumsum(self.blocks)))
        self.bucket = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(n) - starts[self.bucket]
        self.block_of = self.first[self.bucket] + place // 64
        self.bit_of = np.uint64(1) << (place % 64).astype(np.uint64)
        self.starts = starts
        self.length = np.array([len(w) for w in words])
        codes = _codes(words, s + 1)
        letters, dense = np.unique(codes, return_inverse=True)
        self.codes = dense.reshape(codes.shape)
        # index[position, block, letter]: the words with that letter there
        self.index = np.zeros((s + 1, self.first[-1], len(letters)), np.uint64)
        for p in range(s + 1):
            np.bitwise_or.at(self.index[p], (self.block_of, self.codes[:, p]), self.bit_of)
        self.sized = np.zeros((2, self.first[-1]), np.uint64)
        np.bitwise_or.at(self.sized, (self.length - s, self.block_of), self.bit_of)

    def near(self, s: int, x: int, ask: np.ndarray) -> tuple[np.ndarray, ...]:
        """For words ``ask``: which, in which block, and the set of words one edit away there."""
        times = self.blocks[self.bucket[ask]]
        who = np.repeat(ask, times)
        begin = np.concatenate(([0], np.cumsum(times)[:-1]))
        block = self.first[self.bucket[who]] + np.arange(len(who)) - np.repeat(begin, times)
        zero = np.full(len(who), ~np.uint64(0))
        replaced = np.zeros(len(who), np.uint64)
        added, missing, before = replaced.copy(), replaced.copy(), replaced.copy()
        agreed = replaced.copy()
        long = self.length[who] > s
        for p in range(s + 1):
            letter = self.codes[who, p]
            # beyond its end a shorter word asks for nothing more
            live = (self.length[who] > p)
            here = self.index[p, block, letter]
            # the letter asked for is one further on in a word with a letter added before it
            on = self.index[p + 1, block, letter] if p < s else np.zeros_like(here)
            back = self.index[p - 1, block, letter] if p else np.zeros_like(here)
            now_replaced = (replaced & here) | (zero & ~here)
            now_added = (added | zero) & on
            now_missing = (missing & back) | zero
            zero, replaced, added, missing = (
                np.where(live, zero & here, zero),
                np.where(live, now_replaced, replaced),
                np.where(live, now_added, added),
                np.where(live, now_missing, missing),
            )
            if p + 1 == x:
                agreed = zero.copy()
        same, longer = self.sized[0, block], self.sized[1, block]
        found = np.where(long, missing & same, (replaced & same) | ((added | zero) & longer))
        return who, block, found & ~agreed


def _first_bit(bits: np.ndarray) -> np.ndarray:
    low = bits & (~bits + np.uint64(1))
    return np.log2(low.astype(np.float64)).astype(np.int64)


def _answers(words: list[str], counts: list[int], starts: np.ndarray, s: int, x: int) -> list:
    """``word, n_near, form, form_n`` of the words with a near one, by bucket.

    A bucket's words stand in the order in which they would be chosen, so the first bit wins.
    """
    batch = _Batch(words, starts, s)
    out: list[list] = [[], [], [], []]
    # questions at a time, so that (question, block) pairs stay few
    cost = np.cumsum(batch.blocks[batch.bucket])
    at = 0
    while at < len(words):
        base = cost[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(cost, base + 200_000, "right")))
        who, block, found = batch.near(s, x, np.arange(at, end))
        at = end
        hit = np.flatnonzero(found)
        if not len(hit):
            continue
        who, block, found = who[hit], block[hit], found[hit]
        n_near = _POPCOUNT[found.view(np.uint8).reshape(-1, 8)].sum(1, dtype=np.int64)
        best = (block - batch.first[batch.bucket[who]]) * 64 + _first_bit(found)
        best += batch.starts[batch.bucket[who]]
        firsts = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        for i, total in zip(firsts, np.add.reduceat(n_near, firsts), strict=True):
            out[0].append(words[who[i]])
            out[1].append(int(total))
            out[2].append(words[best[i]])
            out[3].append(counts[best[i]])
    return out


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``s, x, key, n, word`` in that order (largest n first) to answers, bucket by bucket."""
    names = ["word", "n_near", "form", "form_n"]
    words: list[str] = []
    counts: list[int] = []
    starts: list[int] = []
    kind = last = None

    def answered() -> Iterator[pa.RecordBatch]:
        """Settle the buckets that are held, which are of one kind."""
        found = _answers(words, counts, np.array(starts), *kind)
        for held in (words, counts, starts):
            held.clear()
        if found[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names)

    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
        for s, x, key, n, word in rows:
            if (s, x, key) != last:
                size = (len(words) // 64 + len(starts)) * (s + 1) * _LETTERS * 8
                if starts and (kind != (s, x) or size > INDEX_BYTES or len(words) > _BATCH_WORDS):
                    yield from answered()
                starts.append(len(words))
                kind, last = (s, x), (s, x, key)
            words.append(word)
            counts.append(n)
    if starts:
        yield from answered()


def _nearest(words: DataFrame) -> DataFrame:
    """``word, n_near, best`` of the words with a near one; ``best`` is ``-n, form``."""
    rows = buckets(words).select("s", "x", "key", "n", "word")
    # buckets of one kind side by side, so that many small ones are met at once
    tasks = tasks_for(4 * words.count(), _TASK_WORDS)
    rows = rows.repartition(tasks, "key").sortWithinPartitions("s", "x", "key", F.desc("n"), "word")
    found = rows.mapInArrow(_asked, "word string, n_near long, form string, form_n long")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"),
    )


def _rooted(rows: DataFrame) -> DataFrame:
    """``word, root`` of words with a form; a form's count is ten times as large, so chains end."""
    links = stored(rows.where("form is not null").select("word", "form"), "forms")
    ways = links.select("word", F.col("form").alias("root"))
    while True:
        # each round doubles the steps taken
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = stored(
            ways.join(on, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "roots",
        )
        if not ways.where("moved").head(1):
            return ways.drop("moved")
        ways = ways.drop("moved")


def group_spellings(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word of the texts.

    A word is near to another if one inserted, deleted or replaced code point tells them apart. Its
    ``form`` is the near word that occurs most (the smallest in code-point order of equals), if
    that is at least ``FACTOR`` times as often; ``root`` is where forms lead. Null and empty texts
    have no words; a null id stands for an empty one in the slip's hash; repeated rows count as
    often as they occur; a text or a run of any length is read whole; no word, no rows.
    """
    words = stored(vocabulary(docs), "vocabulary")
    rows = words.join(stored(_nearest(words), "nearest"), "word", "left")
    often = -F.col("best.less") >= FACTOR * F.col("n")
    rows = rows.select(
        "word",
        F.when(often, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(often, -F.col("best.less")).alias("form_n"),
    )
    rows = stored(rows, "spellings")
    roots = _rooted(rows)
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
