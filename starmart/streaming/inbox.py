"""Folders that files are dropped into: each file is loaded once and then archived.

A file is what its path, modification time and length say, so one that is dropped again under a
name of before is a new one. A table of the files taken, by batch, is kept in a state folder: the
inbox is listed and what the table has is left out by an anti join. A batch is noted before it is
handled and again when it is done; one that failed in between comes again with the same files under
the same number.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.plans.pipelines import run_leads, run_logs
from starmart.schemas import STAGED_LEADS
from starmart.sources.spreadsheet import parse_workbooks
from starmart.sources.store import Warehouse

_FORMATS = {
    "text": "value string",
    "binaryFile": "path string, modificationTime timestamp, length bigint, content binary",
}
_FILE = ["path", "modificationTime", "length"]
_TAKEN = "feed string, number long, path string, modificationTime timestamp, length bigint"
_DONE = "number long"
_MOVERS = 16


class _State:
    """The files taken and the batches done, as two Parquet tables below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        there = self._path(path)
        if not there.getFileSystem(self._conf).exists(there):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def taken(self) -> DataFrame:
        return self._table("taken", _TAKEN)

    def feed(self) -> str:
        """The inbox's name: its state folder and a mark given when that was made."""
        first = self.taken().select("feed").first()
        return first["feed"] if first else f"{self.folder}#{uuid.uuid4().hex}"

    def next_number(self) -> int:
        last = self.taken().agg(F.max("number")).first()[0]
        return 0 if last is None else last + 1

    def take(self, feed: str, number: int, files: list) -> None:
        rows = [(feed, number, *f) for f in files]
        self.spark.createDataFrame(rows, _TAKEN).coalesce(1).write.mode("append").parquet(
            f"{self.folder}/taken"
        )

    def finish(self, number: int) -> None:
        done = self.spark.createDataFrame([(number,)], _DONE).coalesce(1)
        done.write.mode("append").parquet(f"{self.folder}/done")

    def open_batches(self) -> Iterator[tuple[int, list]]:
        """Batches that were taken and not finished: the last one, if any."""
        left = self.taken().join(self._table("done", _DONE), "number", "left_anti")
        numbers = [r["number"] for r in left.select("number").distinct().collect()]
        for number in sorted(numbers):
            yield number, [tuple(r) for r in left.filter(F.col("number") == number).select(*_FILE).collect()]

    def _listed(self, inbox: str, glob: str | None) -> DataFrame | None:
        """The files that are in the inbox now."""
        there = self._path(inbox)
        if not there.getFileSystem(self._conf).exists(there):
            return None
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        # contents aren't read, as their column isn't
        return reader.load(inbox).select(*_FILE)

    def left_behind(self, inbox: str, glob: str | None) -> dict[int, list[tuple]]:
        """Files of finished batches that are still in the inbox, by batch."""
        listed = self._listed(inbox, glob)
        if listed is None:
            return {}
        done = self.taken().join(self._table("done", _DONE), "number")
        found: dict[int, list[tuple]] = {}
        for r in listed.join(done, _FILE).select("number", *_FILE).collect():
            found.setdefault(r["number"], []).append(tuple(r)[1:])
        return found

    def new_files(self, inbox: str, glob: str | None) -> list[tuple]:
        """Files of the inbox that were never taken, the oldest first."""
        listed = self._listed(inbox, glob)
        if listed is None:
            return []
        new = listed.join(self.taken().select(*_FILE), _FILE, "left_anti")
        # a reader of files is given their paths on the driver in any case
        return [tuple(r) for r in new.orderBy("modificationTime", "path").collect()]


def _literal(path: str) -> str:
    """A path that means itself where patterns are read."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", path)


def _rows(spark: SparkSession, fmt: str, files: list) -> DataFrame:
    reader = spark.read.format(fmt).schema(_FORMATS[fmt])
    return reader.load([_literal(path) for path, _, _ in files])


def ingest_inbox(
    spark: SparkSession,
    inbox: str,
    state: str,
    handler: Callable[[DataFrame, int], None],
    archive: str | None = None,
    fmt: str = "text",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Hand the files that are new in ``inbox`` to ``handler(rows, batch_number)``, then return.

    ``state`` is a folder that remembers the files taken. All new files are one batch, or at most
    ``files_per_batch`` each, the oldest first. With ``archive`` the files of a finished batch are
    moved to a folder of its number there.
    """
    _ingest(_State(spark, state), inbox, lambda rows, number, feed: handler(rows, number),
            archive, fmt, glob, files_per_batch)


def _ingest(known: _State, inbox, handler, archive=None, fmt="text", glob=None, files_per_batch=None):
    spark, feed = known.spark, known.feed()

    def put_away(number: int, files: list) -> None:
        if archive:
            _move(spark, inbox, f"{archive.rstrip('/')}/{feed[-8:]}-{number:08d}", files)

    def handle(number: int, files: list) -> None:
        handler(_rows(spark, fmt, files), number, feed)
        known.finish(number)
        put_away(number, files)

    for number, files in known.left_behind(inbox, glob).items() if archive else ():
        put_away(number, files)
    for number, files in known.open_batches():
        handle(number, files)
    files, number = known.new_files(inbox, glob), known.next_number()
    size = files_per_batch or max(1, len(files))
    for i in range(0, len(files), size):
        known.take(feed, number, files[i : i + size])
        handle(number, files[i : i + size])
        number += 1


def _move(spark: SparkSession, inbox: str, target: str, files: list) -> None:
    """Move a batch's files, side by side; one that was dropped anew meanwhile stays."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(inbox).getFileSystem(spark._jsc.hadoopConfiguration())
    root = fs.makeQualified(path(inbox)).toString().rstrip("/") + "/"

    def move(file: tuple) -> None:
        name, modified, length = file
        old = path(name)
        if not fs.exists(old):
            return
        found = fs.getFileStatus(old)
        if found.getLen() != length or found.getModificationTime() != round(modified.timestamp() * 1000):
            return
        inside = old.toString()
        new = path(f"{target}/{inside.removeprefix(root) if inside.startswith(root) else old.getName()}")
        fs.mkdirs(new.getParent())
        if not fs.rename(old, new):
            raise RuntimeError(f"{old} could not be moved to {new}")

    with ThreadPoolExecutor(_MOVERS) as pool:
        list(pool.map(move, files))


def _same_inbox(wh: Warehouse, fact: str, state: str, feed: str) -> None:
    """Fail if the state folder was made anew since the fact was loaded from it.

    Files that are still in the inbox would be taken again.
    """
    others = [f for f in wh.feeds(fact) if f.startswith(f"{state.rstrip('/')}#") and f != feed]
    if others:
        raise ValueError(f"{fact} was loaded from {others[0]}; {state} was made anew")


def ingest_weblogs(
    wh: Warehouse,
    inbox: str,
    state: str,
    geo: DataFrame | None,
    load_ts,
    load_options: Mapping | None = None,
    **options,
) -> None:
    """Load the new log files of an inbox; a batch repeated after a failure adds nothing.

    ``load_options`` go to ``run_logs`` (``countries``, ``tz``, ``hot_ips`` ...), the others to
    ``ingest_inbox``. Unreadable lines and rejects of all batches stay until the next call.
    """

    def load(lines: DataFrame, number: int, feed: str) -> None:
        _same_inbox(wh, "fact_logs", state, feed)
        run_logs(wh, lines, geo, load_ts, batch=(feed, number), **(load_options or {}))

    wh.clear("stg_logs")
    _ingest(_State(wh.spark, state), inbox, load, **options)


def ingest_leads(
    wh: Warehouse,
    inbox: str,
    state: str,
    load_ts,
    load_options: Mapping | None = None,
    **options,
) -> None:
    """Load the new workbooks of an inbox; rejects of all batches stay until the next call."""

    def load(books: DataFrame, number: int, feed: str) -> None:
        _same_inbox(wh, "fact_leads", state, feed)
        leads = parse_workbooks(books, STAGED_LEADS)
        run_leads(wh, leads, load_ts, batch=(feed, number), **(load_options or {}))

    wh.clear("stg_leads")
    _ingest(_State(wh.spark, state), inbox, load, fmt="binaryFile", glob="*.xlsx", **options)
