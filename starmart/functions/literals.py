"""Wall-clock literals and repeatable picks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(value: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal; goes through text so that no time zone is applied."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def pick(n: int, *parts) -> Column:
    """A repeatable number in ``[0, n)`` drawn from the text of ``parts``.

    Uses md5, so the same rows come out of any partitioning and of any other SQL engine. 15 hex
    digits keep the draw inside a positive BIGINT.
    """
    digest = F.md5(F.concat_ws(":", *[_text(p) for p in parts]))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(n))


def _text(part) -> Column:
    return (part if isinstance(part, Column) else F.lit(part)).cast("string")
