"""Warehouse tables as Parquet snapshots.

A table is a set of immutable Parquet folders plus a numbered list that names those which form
the current state. Readers see the old state until the next list appears, and a load never
overwrites what it reads. Adding rows writes only the new rows.
"""

from __future__ import annotations

import json
import threading
import uuid
import warnings
from collections.abc import Callable, Collection, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.keys import next_key
from starmart.schemas import SLICE_KEYS, TABLES, empty_frame

# How the slice column follows from the columns of a table, and whether rows are gathered by
# slice before writing. Gathering avoids a file per task and slice where there are many slices;
# AQE cuts a large slice into several tasks.
_SLICES = {
    "order_month": (lambda name, slots: F.col("order_date").cast("string").substr(1, 7), True),
    "key_slice": (
        lambda name, slots: F.concat(
            F.when(F.col("end_date").isNull(), _OPEN).otherwise(_CLOSED),
            _slot(name, slots).cast("string"),
        ),
        True,
    ),
    "is_readable": (lambda name, slots: F.col("time").isNotNull().cast("int"), False),
}
# What follows the tables of a root, by name: the tables it depends on and how it is made again.
_FOLLOWERS: dict[str, dict[str, tuple[frozenset[str], Callable[[Warehouse], None]]]] = {}
_FOLLOWING = threading.RLock()
_WHOLE = ""
_OPEN, _CLOSED = "open-", "closed-"
KEY_SLOTS = 16


def _slot(name: str, slots: int) -> Column:
    """The slot of a dimension's key, the same for keys of another numeric type."""
    schema = TABLES[name][0]
    key = [F.col(c).cast(schema[c].dataType) for c in SLICE_KEYS[name]]
    return F.pmod(F.xxhash64(*key), F.lit(slots))


class Warehouse:
    """Named tables below ``root``, a folder all executors reach. One writer per table.

    A dimension is kept in slices by the hash of its key, open and closed versions apart, so that
    a load touches the slices of its keys only. ``key_slots`` is how many hashes there are in a
    table that is written for the first time.
    """

    def __init__(self, spark: SparkSession, root: str, key_slots: int = KEY_SLOTS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key_slots = key_slots
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def table(self, name: str, slices: Collection[str] | None = None) -> DataFrame:
        """The current rows in declared column order; of the named slices only, if given."""
        return self._rows(name, self._state(name)["parts"], slices)

    def _rows(self, name: str, parts, slices: Collection[str] | None) -> DataFrame:
        schema = TABLES[name][0]
        paths = [p for s, p in parts if slices is None or s in slices]
        if not paths:
            return empty_frame(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{name}/{p}" for p in paths])

    def follow(
        self, name: str, tables: Iterable[str], remake: Callable[[Warehouse], None]
    ) -> None:
        """Call ``remake`` now, and again whenever this process publishes a state of ``tables``.

        That holds for every ``Warehouse`` of this root; the same ``name`` replaces what followed
        before. States published by other processes are taken over by ``catch_up``.
        """
        with _FOLLOWING:
            remake(self)
            _FOLLOWERS.setdefault(self.root, {})[name] = (frozenset(tables), remake)

    def unfollow(self, name: str) -> None:
        with _FOLLOWING:
            _FOLLOWERS.get(self.root, {}).pop(name, None)

    def catch_up(self, table: str | None = None) -> None:
        """Make again what follows ``table``, or any table of this root."""
        with _FOLLOWING:
            for tables, remake in list(_FOLLOWERS.get(self.root, {}).values()):
                if table is None or table in tables:
                    remake(self)

    def version(self, name: str) -> int:
        """The number of the current state; 0 for a table never written."""
        return self._state(name)["version"]

    def slices(self, name: str) -> list[str]:
        """The slices a table has rows in."""
        return sorted({s for s, _ in self._state(name)["parts"]})

    def open_slices(self, name: str) -> list[str]:
        """The slices of a dimension that hold open versions."""
        return [s for s in self.slices(name) if not s.startswith(f"key_slice={_CLOSED}")]

    def key_counts(self, name: str, keys: DataFrame) -> dict[int, int]:
        """How many rows of ``keys`` (a dimension's key columns) each slot has."""
        slot = _slot(name, self._slots(self._state(name))).alias("slot")
        # one number for each slot comes to the driver
        return {r["slot"]: r["count"] for r in keys.groupBy(slot).count().collect()}

    def slot_slices(self, name: str, slots: Iterable[int]) -> list[str]:
        """The slices of a dimension in which keys of these slots can be."""
        wanted = {f"{kind}{slot}" for slot in slots for kind in (_OPEN, _CLOSED)}
        named = [(s, s.partition("=")) for s in self.slices(name)]
        return [s for s, (col, _, value) in named if col != "key_slice" or value in wanted]

    def next_key(self, name: str, sk: str) -> int:
        """The first surrogate key that is not in use; noted with each load that adds some."""
        top = self._state(name).get("top_key")
        return next_key(self.table(name), sk) if top is None else top + 1

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        """Replace all rows."""
        return self._commit(name, df, lambda s: True)

    def append(
        self,
        name: str,
        df: DataFrame,
        batch: tuple[str, int] | None = None,
        top_key: int | None = None,
    ) -> DataFrame:
        """Add rows. ``top_key`` is the highest surrogate key of a dimension, these rows included.

        ``batch`` = (feed, number) makes a rerun harmless: numbers of a feed rise, and the last
        one added adds nothing again. A lower number means that the feed was started anew, and
        fails: its rows may be new ones under an old number.
        """
        if batch is not None:
            last = self._state(name)["batches"].get(batch[0], {"number": -1})["number"]
            if batch[1] < last:
                raise ValueError(f"{name}: {batch[0]} is at batch {last}, {batch[1]} came again")
            if batch[1] == last:
                return self.table(name)
        return self._commit(name, df, lambda s: False, batch, top_key)

    def batch(self, name: str, feed: str, slices: Collection[str] | None = None) -> DataFrame:
        """The rows of the batch that a feed added last."""
        state = self._state(name)
        folder = state["batches"][feed]["folder"]
        parts = [(s, p) for s, p in state["parts"] if p.split("/")[0] == folder]
        return self._rows(name, parts, slices)

    def feeds(self, name: str) -> list[str]:
        """The feeds that have added batches."""
        return sorted(self._state(name)["batches"])

    def clear(self, name: str) -> None:
        """Remove all rows, and forget which batches were added."""
        state = self._state(name)
        if state["parts"] or state["batches"]:
            self._publish(name, {"version": state["version"] + 1, "parts": [], "batches": {}})

    def replace_slices(
        self, name: str, df: DataFrame, slices: Collection[str], top_key: int | None = None
    ) -> DataFrame:
        """Drop the named slices and add the rows of ``df``, in one step."""
        gone = set(slices)
        return self._commit(name, df, lambda s: s in gone, top_key=top_key)

    def merge_dimension(self, name: str, changes: DataFrame) -> DataFrame:
        """Take over ``scd2_changes``: open versions are replaced, newly closed ones added."""
        return self.replace_slices(name, changes, self.open_slices(name))

    def expire(self, name: str, keep: int = 1) -> None:
        """Remove the files that none of the newest ``keep`` states uses.

        Readers of older states lose them; not to be called while the table is being loaded. What
        follows the table is brought to the newest state first.
        """
        self.catch_up(name)
        lists = self._lists(name)
        if not lists:
            return
        live = {p.split("/")[0] for n in lists[-keep:] for _, p in self._read(name, n)["parts"]}
        for found in self._fs.listStatus(self._path(f"{self.root}/{name}")):
            folder = found.getPath().getName()
            if folder.startswith("data-") and folder not in live:
                self._fs.delete(found.getPath(), True)
        for old in lists[:-keep]:
            self._fs.delete(self._path(f"{self.root}/{name}/_lists/{old}"), False)

    def _slots(self, state: dict) -> int:
        """A table with rows keeps the number of slots that they were written with."""
        return state.get("key_slots", self.key_slots) if state["parts"] else self.key_slots

    def _commit(self, name: str, df: DataFrame, drops, batch=None, top_key=None) -> DataFrame:
        schema, slice_col = TABLES[name]
        state = self._state(name)
        folder = f"data-{uuid.uuid4().hex}"
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        writer = rows.write
        if slice_col:
            # Without this, every task would hold a writer open per slice.
            value, gather = _SLICES[slice_col]
            rows = rows.withColumn(slice_col, value(name, self._slots(state)))
            if gather:
                rows = rows.hint("rebalance", F.col(slice_col))
            writer = rows.write.partitionBy(slice_col)
        writer.parquet(f"{self.root}/{name}/{folder}")
        added = {batch[0]: {"number": batch[1], "folder": folder}} if batch else {}
        parts = [p for p in state["parts"] if not drops(p[0])]
        parts += self._written(name, folder, slice_col)
        following = {
            "version": state["version"] + 1,
            "parts": parts,
            "batches": {**state["batches"], **added},
        }
        if slice_col == "key_slice":
            following["key_slots"] = self._slots(state)
            if top_key is not None:
                following["top_key"] = top_key
        self._publish(name, following)
        return self.table(name)

    def _written(self, name: str, folder: str, slice_col: str | None) -> list[list[str]]:
        if slice_col is None:
            return [[_WHOLE, folder]]
        listed = self._fs.listStatus(self._path(f"{self.root}/{name}/{folder}"))
        slices = [s.getPath().getName() for s in listed if s.isDirectory()]
        return [[s, f"{folder}/{s}"] for s in slices if s.startswith(f"{slice_col}=")]

    def _lists(self, name: str) -> list[str]:
        """File names of the published lists, oldest first."""
        folder = self._path(f"{self.root}/{name}/_lists")
        listed = self._fs.listStatus(folder) if self._fs.exists(folder) else []
        names = [s.getPath().getName() for s in listed]
        return sorted(n for n in names if n.endswith(".json") and not n.startswith("."))

    def _read(self, name: str, file: str) -> dict:
        stream = self._fs.open(self._path(f"{self.root}/{name}/_lists/{file}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _state(self, name: str) -> dict:
        lists = self._lists(name)
        if not lists:
            return {"version": 0, "parts": [], "batches": {}}
        return self._read(name, lists[-1])

    def _publish(self, name: str, state: dict) -> None:
        """Write the list under a private name, then rename: readers see all of it or nothing."""
        final = self._path(f"{self.root}/{name}/_lists/{state['version']:012d}.json")
        draft = self._path(f"{self.root}/{name}/_lists/.{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError(f"{name}: another writer published version {state['version']}")
        try:
            self.catch_up(name)
        except Exception as trouble:
            # The rows are loaded; a caller that took this for a failed load would add them twice.
            warnings.warn(f"{name}: what follows it keeps its old state ({trouble})", stacklevel=2)

