"""Relational tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000
INSERT_ROWS = 5_000


@dataclass(frozen=True)
class Partitioning:
    """Read a table as ``parts`` ranges of a numeric, date or timestamp column.

    ``lower`` and ``upper`` only place the cuts; rows beyond them are read too.
    """

    column: str
    lower: object
    upper: object
    parts: int


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition: Partitioning | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a table; filters and column choices are sent to the database.

    Without ``partition`` one task reads everything, which suits small tables only. Put user,
    password and driver class into ``options``.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", FETCH_ROWS)
        .option("preferTimestampNTZ", "true")
        .options(**dict(options or {}))
    )
    if partition is not None:
        reader = (
            reader.option("partitionColumn", partition.column)
            .option("lowerBound", str(partition.lower))
            .option("upperBound", str(partition.upper))
            .option("numPartitions", partition.parts)
        )
    return reader.load()


def write_jdbc_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    truncate: bool = False,
    connections: int = 16,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a table in batches over at most ``connections`` parallel connections.

    ``truncate`` keeps the table definition when overwriting.
    """
    (
        df.write.format("jdbc")
        .mode(mode)
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", INSERT_ROWS)
        .option("numPartitions", connections)
        .option("truncate", str(truncate).lower())
        .options(**dict(options or {}))
        .save()
    )
