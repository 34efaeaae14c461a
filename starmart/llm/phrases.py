"""Repeated byte strings across the corpus, by prefix-free parsing.

A rolling hash over eight bytes triggers a cut wherever it is smaller than at all places near by.
Since that depends on the bytes around a cut alone, equal passages are cut alike wherever they
stand. The phrases between cuts are the dictionary, the sequence of their names is the parse.

All that matters of the corpus order is which neighbours agree on ``length`` bytes, so the parse
suffixes are ordered by that prefix only: a suffix is keyed by the names of the phrases that cover
every window of ``length`` bytes starting in its first phrase. Suffixes with equal keys stand
together, and all those windows are repeats. Windows that reach past an equal stretch are left;
one with a phrase found nowhere else is no repeat; the remaining few, at the edges of repeated
passages, are compared by their own bytes. What is highly repetitive is thus handled by phrase.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import stored, text_bytes

LENGTH = 400
# A cut is a minimum among so many places on each side; phrases have twice as many bytes at a mean.
REACH = 20
_ROLL = 8
_U = np.uint64
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_FIRST, _LAST = _U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F)
_ROWS = 2048


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_CODE = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.cumprod(self.up), np.cumprod(self.down)
        return self.up[:n], self.down[:n]


class _Sums:
    """Hash of any stretch of a sequence of numbers, from running sums."""

    def __init__(self, values: np.ndarray, powers: _Powers) -> None:
        up, self.down = powers.of(len(values) + 1)
        self.total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.total[1:])

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        size = (stop - start).astype(np.uint64)
        return _mix((self.total[stop] - self.total[start]) * self.down[start] + size * _FIRST)


def cuts(data: np.ndarray, reach: int) -> np.ndarray:
    """Places whose rolling hash is below the ``reach`` before and not above the ``reach`` after."""
    if len(data) < _ROLL + 2 * reach:
        return np.zeros(0, np.int64)
    eight = np.ascontiguousarray(sliding_window_view(data, _ROLL)).view("<u8").ravel()
    rolled = (_mix(eight) >> _U(32)).astype(np.uint32)
    rim = np.full(reach, 0xFFFFFFFF, np.uint32)
    padded = np.concatenate((rim, rolled, rim))
    low, width = padded, 1
    while width * 2 <= reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < reach:
        low = np.minimum(low[: width - reach], low[reach - width :])
    n = len(rolled)
    at = np.flatnonzero((rolled < low[:n]) & (rolled <= low[reach + 1 : reach + 1 + n]))
    return at[at > 0]


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of an Arrow list column as arrays; a null row is empty."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), sizes, 0)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield values[a:b]


class _Rows:
    """Collects rows of an Arrow schema and hands them out in batches."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.columns = schema, [[] for _ in schema]

    def add(self, *row) -> None:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)

    def take(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.columns[0]) >= least:
            arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self.columns = [[] for _ in self.schema]


_INTS, _LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
_PARSED = pa.schema(
    [
        ("rid", pa.int64()),
        ("did", pa.int64()),
        ("uid", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("sha", pa.string()),
        ("bounds", _INTS),
        ("names", _LONGS),
    ]
)
_JUDGED = pa.schema(
    [
        *[_PARSED.field(k) for k in range(6)],
        ("sure", _INTS),
        ("ask", _INTS),
        ("tell", _INTS),
        ("wanted", _LONGS),
        ("offered", _LONGS),
        ("offers", _INTS),
    ]
)


def _with_key(docs: DataFrame) -> DataFrame:
    """``did, uid, doc_id, text``: rows with the same first two are copies of one row."""
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    did = F.coalesce(doc_id, F.lit(-1)).alias("did")
    return docs.select(did, F.xxhash64(doc_id, text).alias("uid"), doc_id.alias("doc_id"), text.alias("text"))


def parse(docs: DataFrame, length: int, reach: int) -> DataFrame:
    """The parse of each document: ``bounds`` (0, the cuts, the end) and ``names`` between them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, out = _Powers(), _Rows(_PARSED)
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys = [batch.column(k).to_pylist() for k in range(4)]
            data, offsets = text_bytes(batch.column(4))
            for did, uid, doc_id, sha, a, b in zip(*keys, offsets[:-1], offsets[1:], strict=True):
                part, bounds, names = data[a:b], [], []
                if len(part) >= length:
                    bounds = np.concatenate(([0], cuts(part, reach), [len(part)]))
                    names = _Sums(_CODE[part], powers).hashes(bounds[:-1], bounds[1:]).view(np.int64)
                out.add(rid, did, uid, doc_id, int(b - a), sha, bounds, names)
                rid += 1
                yield from out.take(_ROWS)
        yield from out.take()

    rows = _with_key(docs).select("did", "uid", "doc_id", F.sha2("text", 256).alias("sha"), "text")
    schema = "rid long, did long, uid long, doc_id long, n_bytes long, sha string, bounds array<int>, names array<long>"
    return rows.mapInArrow(cut, schema)


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    """The keys that occur twice or more; stored, so that a join with them can split a hot one."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return stored(counts.where("n > 1").select(key), f"repeated-{key}")


def _suffixes(length: int):
    """Rows ``rid, at, key`` of the parse suffixes that may be repeated."""
    schema = pa.schema([("rid", pa.int64()), ("at", pa.int32()), ("key", pa.int64())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            found = []
            rids = batch.column(0).to_pylist()
            lists = zip(rids, *[_lists(batch.column(k)) for k in (1, 2, 3)], strict=True)
            for rid, bounds, names, known in lists:
                k = len(names)
                if not k:
                    continue
                salted = names.view(np.uint64).copy()
                salted[0] ^= _FIRST
                salted[-1] ^= _LAST
                alone = np.ones(k, np.int64)
                alone[known] = 0
                alone[[0, -1]] = 0
                alone = np.concatenate(([0], np.cumsum(alone)))
                at = np.flatnonzero(bounds[:-1] <= bounds[-1] - length)
                stop = np.minimum(np.searchsorted(bounds, bounds[at + 1] + (length - 1)), k)
                good = alone[stop] == alone[at]
                at, stop = at[good], stop[good]
                if len(at):
                    keys = _Sums(salted, powers).hashes(at, stop).view(np.int64)
                    found.append((np.full(len(at), rid, np.int64), at.astype(np.int32), keys))
            if found:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return walk


def _ranges(mask: np.ndarray) -> np.ndarray:
    """Where runs of True begin and end, in turn."""
    return np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))


def _marked(size: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """True in any of the ranges."""
    start, stop = np.clip(start, 0, size), np.clip(stop, 0, size)
    some = stop > start
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, start[some], 1)
    np.add.at(steps, stop[some], -1)
    return np.cumsum(steps[:-1]) > 0


def _judge(length: int, reach: int):
    """Which windows are surely repeats, which ask for others, which tell others, by document."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_JUDGED)
        for batch in batches:
            plain = [batch.column(k).to_pylist() for k in range(6)]
            lists = [_lists(batch.column(k)) for k in range(6, 11)]
            for *row, bounds, names, known, same, first in zip(*plain, *lists, strict=True):
                n = len(names)
                if not n:
                    out.add(*row, [], [], [], [], [], [])
                    continue
                size = int(bounds[-1]) - length + 1  # windows
                sure = _marked(size, bounds[same], bounds[same + 1])
                lone = np.ones(n, bool)
                lone[known] = False
                lone[[0, -1]] = False
                lone = np.flatnonzero(lone)
                never = _marked(size, bounds[lone + 1] + (reach + _ROLL - length), bounds[lone] - reach + 1)
                # the first cut that a window's own bytes determine, and whether the next is one too
                inner = bounds[1:-1].astype(np.int64)
                maybe = np.flatnonzero(~never)
                cut = np.searchsorted(inner, maybe + reach)
                after = np.append(inner, [1 << 40, 1 << 40])[cut + 1]
                whole = after + (reach + _ROLL) <= maybe + length
                ask = np.zeros(size, bool)
                ask[maybe] = ~sure[maybe]
                tell = np.zeros(size, bool)
                tell[maybe[~whole]] = True
                wanted = np.unique(names[cut[whole & ask[maybe]] + 1])
                speaks = _marked(size, bounds[first], bounds[first + 1])[maybe] & whole
                place, phrase = maybe[speaks], cut[speaks] + 1
                edge = np.flatnonzero((np.diff(place) != 1) | (np.diff(phrase) != 0))
                begin = np.concatenate(([0], edge + 1)) if len(place) else edge
                end = np.append(edge, len(place) - 1) if len(place) else edge
                offers = np.column_stack((place[begin], place[end] + 1)).ravel() if len(place) else []
                out.add(
                    *row,
                    _ranges(sure),
                    _ranges(ask),
                    _ranges(tell & ~ask),
                    wanted,
                    names[phrase[begin]] if len(place) else [],
                    offers,
                )
                yield from out.take(_ROWS)
        yield from out.take()

    return walk


def _window_hashes(length: int):
    """Rows ``rid, at, key, asks`` for the windows in the ranges, by their bytes."""
    schema = pa.schema(
        [("rid", pa.int64()), ("at", pa.int32()), ("key", pa.int64()), ("asks", pa.bool_())]
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            rids = batch.column(0).to_pylist()
            data, offsets = text_bytes(batch.column(1))
            lists = zip(rids, _lists(batch.column(2)), _lists(batch.column(3)), strict=True)
            found, held = [], 0
            for (rid, ask, tell), a, b in zip(lists, offsets[:-1], offsets[1:], strict=True):
                size = int(b - a) - length + 1
                asks = _marked(size, ask[0::2].astype(np.int64), ask[1::2].astype(np.int64))
                tells = _marked(size, tell[0::2].astype(np.int64), tell[1::2].astype(np.int64))
                at = np.flatnonzero(asks | tells)
                if len(at):
                    keys = _Sums(_CODE[data[a:b]], powers).hashes(at, at + length).view(np.int64)
                    rid = np.full(len(at), rid, np.int64)
                    found.append((rid, at.astype(np.int32), keys, asks[at]))
                    held += len(at)
                if held > 1 << 18:
                    columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)
                    found, held = [], 0
            if found:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return walk


def _cut_out(length: int):
    """What is left of each text without the windows that start in the ranges and at the places."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("n_bytes", pa.int64()),
                ("n_removed", pa.int64()),
                ("n_spans", pa.int64()),
                ("kept_sha256", pa.string()),
                ("spans", _INTS),
            ]
        )
        out = _Rows(schema)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = text_bytes(batch.column(1))
            lists = zip(ids, _lists(batch.column(2)), _lists(batch.column(3)), strict=True)
            for (doc_id, sure, found), a, b in zip(lists, offsets[:-1], offsets[1:], strict=True):
                size = int(b - a)
                start = np.concatenate((sure[0::2], found)).astype(np.int64)
                stop = np.concatenate((sure[1::2] - 1, found)).astype(np.int64) + length
                gone = _marked(size, start, stop)
                spans = _ranges(gone)
                kept = data[a:b][~gone].tobytes()
                digest = hashlib.sha256(kept).hexdigest()
                out.add(doc_id, size, int(gone.sum()), len(spans) // 2, digest, spans)
                yield from out.take(_ROWS)
        yield from out.take()

    return walk


def _numbers(name: str) -> Column:
    return F.collect_list(name)


def repeated_bytes(docs: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """Bytes of each document covered by a string of ``length`` bytes that starts elsewhere too.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (begin and end of the
    removed runs, in turn), one row per row of ``docs``. Strings never cross documents and are
    judged on the input. A null text is empty; a null id is kept; a repeated row repeats all of its
    strings; an empty table gives no rows.
    """
    if length < 2 * (2 * reach + _ROLL):
        raise ValueError("length must leave room for a phrase between two cuts")
    parsed = stored(parse(docs, length, reach), "parse")

    # the dictionary: phrases between two cuts, and those found twice
    inner = F.expr("slice(names, 2, greatest(size(names) - 2, 0))")
    phrases = parsed.select("rid", F.posexplode_outer(inner).alias("at", "name")).where("name is not null")
    known = phrases.join(_repeated(phrases, "name"), "name").groupBy("rid")
    known = known.agg(F.collect_list((F.col("at") + 1).cast("int")).alias("known"))
    parsed = stored(parsed.join(known, "rid", "left"), "parse-known")

    # the parse: suffixes that agree on all windows of their first phrase
    suffixes = parsed.select("rid", "bounds", "names", "known").mapInArrow(
        _suffixes(length), "rid long, at int, key long"
    )
    suffixes = stored(suffixes, "suffixes")
    groups = suffixes.groupBy("key").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "at")).alias("first")
    )
    groups = stored(groups.where("n > 1").select("key", "first"), "repeated-suffixes")
    same = suffixes.join(groups, "key").groupBy("rid")
    speaks = F.col("first") == F.struct("rid", "at")
    same = same.agg(
        F.collect_list("at").alias("same"), F.collect_list(F.when(speaks, F.col("at"))).alias("first")
    )
    kinds = "sure array<int>, ask array<int>, tell array<int>, wanted array<long>, offered array<long>, offers array<int>"
    plain = "rid long, did long, uid long, doc_id long, n_bytes long, sha string"
    columns = ["rid", "did", "uid", "doc_id", "n_bytes", "sha", "bounds", "names", "known", "same", "first"]
    judged = parsed.join(same, "rid", "left").select(*columns)
    judged = stored(judged.mapInArrow(_judge(length, reach), f"{plain}, {kinds}"), "judged")

    # windows at the edges: compared with each other, and with one copy of what is repeated
    wanted = judged.select(F.explode("wanted").alias("name")).distinct()
    offers = judged.select("rid", "offers", F.posexplode("offered").alias("k", "name"))
    offers = offers.select(
        "rid", "name", F.get("offers", F.col("k") * 2).alias("lo"), F.get("offers", F.col("k") * 2 + 1).alias("hi")
    )
    offers = offers.join(wanted, "name", "left_semi").groupBy("rid")
    offers = offers.agg(F.flatten(F.collect_list(F.array("lo", "hi"))).alias("more"))
    asked = judged.select("rid", "did", "uid", "ask", "tell").join(offers, "rid", "left")
    none = F.array().cast("array<int>")
    asked = asked.withColumn("tell", F.concat("tell", F.coalesce("more", none)))
    asked = asked.where("size(ask) + size(tell) > 0").dropDuplicates(["did", "uid"])
    texts = _with_key(docs).where(F.octet_length("text") >= length)
    windows = texts.join(asked, ["did", "uid"]).select("rid", "text", "ask", "tell")
    windows = stored(
        windows.mapInArrow(_window_hashes(length), "rid long, at int, key long, asks boolean"),
        "windows",
    )
    answered = windows.where("asks").join(_repeated(windows, "key"), "key").groupBy("rid")
    answered = answered.agg(_numbers("at").alias("found"))

    gone = judged.select("rid", "did", "uid", "sure").join(answered, "rid", "left")
    gone = gone.withColumn("found", F.coalesce("found", none))
    gone = gone.where("size(sure) + size(found) > 0").dropDuplicates(["did", "uid"])
    gone = stored(gone.select("did", "uid", "sure", "found"), "repeats")
    cut = texts.join(gone, ["did", "uid"]).select("doc_id", "text", "sure", "found")
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<int>"
    cut = cut.mapInArrow(_cut_out(length), result)
    zero = F.lit(0).cast("long")
    rest = judged.join(gone, ["did", "uid"], "left_anti").select(
        "doc_id",
        "n_bytes",
        zero.alias("n_removed"),
        zero.alias("n_spans"),
        F.col("sha").alias("kept_sha256"),
        none.alias("spans"),
    )
    return cut.unionByName(rest)
