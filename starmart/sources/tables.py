"""The seven tables of the order system, from wherever they are kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from starmart.schemas import SOURCE_SCHEMAS


class SourceTables(Mapping):
    """Table name -> DataFrame, checked for the columns the extracts read."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        for name, schema in SOURCE_SCHEMAS.items():
            if name not in frames:
                raise KeyError(f"source table {name} is missing")
            lacking = set(schema.names) - set(frames[name].columns)
            if lacking:
                raise ValueError(f"source table {name} lacks {sorted(lacking)}")
        self._frames = dict(frames)

    @classmethod
    def load(cls, read: Callable[[str], DataFrame]) -> SourceTables:
        """Build from a function that reads one table by name."""
        return cls({name: read(name) for name in SOURCE_SCHEMAS})

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> SourceTables:
        return cls.load(lambda name: spark.read.parquet(f"{folder}/{name}"))

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> SourceTables:
        return cls.load(lambda name: spark.table(f"{database}.{name}"))

    def replaced(self, **frames: DataFrame) -> SourceTables:
        """A copy with some tables exchanged."""
        return SourceTables({**self._frames, **frames})

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)
