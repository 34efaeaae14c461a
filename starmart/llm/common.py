"""Words, whole rows and Arrow text shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def words(text: Column) -> Column:
    """The words of a text in order; none of a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def tasks_for(rows: int, each: int) -> int:
    """Tasks for so many rows; more than there are partitions leaves the partitions alone."""
    return 1 + rows // each


def stored(
    frame: DataFrame, label: str, tasks: int | None = None, codec: str | None = None
) -> DataFrame:
    """The rows, written to the shared folder and read again.

    Cuts the lineage: a lost executor costs at most the tasks that ran on it, and what draws on
    the rows twice doesn't compute them twice. ``tasks`` limits the files where a table's rows are
    known to be few for its partitions. ``codec`` is the session's unless named; text takes about
    a third less with zstd than with snappy.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    writer = (frame.coalesce(tasks) if tasks else frame).write
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Steps run within give up their shuffle files when they end.

    Otherwise these lie on disk until the driver collects garbage. For steps that store their rows:
    a frame that is run again has to be made again.
    """
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of an Arrow text column, and where each row's begin (one more than rows)."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes together; a longer row stands alone."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop
