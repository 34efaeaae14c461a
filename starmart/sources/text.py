"""Text files: web logs and one-column lookup lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_weblogs(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Log lines of a file or folder as column ``value``."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(path)


def read_lookup_list(spark: SparkSession, path: str) -> DataFrame:
    """One entry per line as column ``value``; blank lines are left out.

    Read as text, since entries may hold unquoted commas.
    """
    return spark.read.text(path).filter(F.trim("value") != "")


def write_text(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-column frame as text, one file per partition."""
    lines.write.mode(mode).text(path)
