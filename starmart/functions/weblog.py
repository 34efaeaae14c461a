"""Combined Log Format lines -> columns, without a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.literals import wall_clock

# A quoted field, where a backslash guards the next character. Possessive, so that the matcher
# loops instead of recursing: a field of any length fits on the stack.
_QUOTED = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
LINE = (
    rf"^(\S+) (\S+) (\S+) \[([^\]]+)\] {_QUOTED} (\d{{3}}|-) (\d+|-)"
    rf"(?: {_QUOTED} {_QUOTED})?\s*$"
)
STAMP = r"^\d{2}/[A-Za-z]{3}/\d{4}:\d{2}:\d{2}:\d{2}"
GROUPS = 9
FIELD_MARK = "\u0001"
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
# Stands for "time not readable" where such rows are kept.
UNREADABLE_TIME = "1950-01-01 00:00:00"


def _fields(line: Column) -> Column:
    """The nine groups of a matching line as an array.

    One regex pass rewrites the line with a mark between the groups and a plain split cuts it;
    nine ``regexp_extract`` calls would match the line nine times. A line that already holds
    the mark takes the slow way.
    """
    rewritten = F.regexp_replace(
        line, F.lit(LINE), F.lit(FIELD_MARK.join(f"${i}" for i in range(1, GROUPS + 1)))
    )
    slow = F.when(
        line.rlike(LINE), F.array(*[F.regexp_extract(line, LINE, i) for i in range(1, GROUPS + 1)])
    )
    return F.when(line.contains(FIELD_MARK), slow).otherwise(F.split(rewritten, FIELD_MARK))


def log_time(stamp: Column, tz: str = "wall") -> Column:
    """``10/Jan/2021:14:03:00 -0700`` -> TIMESTAMP_NTZ, NULL when unreadable.

    ``tz="wall"`` keeps the clock time written in the line, ``tz="utc"`` applies its offset. The
    text is reordered to ISO and cast, which no session time zone can shift.
    """
    month_number = F.create_map(
        *[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, f"{i:02d}")]
    )
    iso = F.concat(
        stamp.substr(8, 4),
        F.lit("-"),
        F.try_element_at(month_number, stamp.substr(4, 3)),
        F.lit("-"),
        stamp.substr(1, 2),
        F.lit(" "),
        stamp.substr(13, 8),
    )
    clock = F.when(stamp.rlike(STAMP), iso).try_cast("timestamp_ntz")
    if tz == "wall":
        return clock
    if tz != "utc":
        raise ValueError(f"unknown tz mode {tz!r}")
    sign = F.when(stamp.substr(22, 1) == "-", -1).otherwise(1)
    offset = F.make_dt_interval(
        F.lit(0),
        sign * stamp.substr(23, 2).try_cast("int"),
        sign * stamp.substr(25, 2).try_cast("int"),
        F.lit(0),
    )
    return clock - offset


def parse_weblogs(lines: DataFrame, value_col: str = "value", tz: str = "wall") -> DataFrame:
    """One output row per line; the fields of a line that does not parse are NULL.

    The one-element explode keeps the cut fields a column of their own: a filter on a parsed
    column would otherwise be pushed below it and match every line again, once per mention.
    """
    line = F.col(value_col)
    cut = lines.select(line.alias("value"), F.explode(F.array(_fields(line))).alias("_f"))
    fits = F.size("_f") == GROUPS

    def field(i: int) -> Column:
        return F.when(fits, F.get("_f", F.lit(i)))

    def optional(i: int) -> Column:
        return F.when(fits, F.nullif(F.get("_f", F.lit(i)), F.lit("")))

    return cut.select(
        field(0).alias("ipaddr"),
        field(1).alias("identity"),
        field(2).alias("username"),
        log_time(field(3), tz).alias("time"),
        field(4).alias("request"),
        field(5).try_cast("int").alias("status"),
        field(6).try_cast("bigint").alias("bytes"),
        optional(7).alias("referer"),
        optional(8).alias("useragent"),
        "value",
    )


def readable(parsed: DataFrame, keep_unparsable: bool = False) -> DataFrame:
    """Rows with a readable time; or all rows, the unreadable ones marked 1950-01-01."""
    if keep_unparsable:
        return parsed.withColumn("time", F.coalesce("time", wall_clock(UNREADABLE_TIME)))
    return parsed.filter(F.col("time").isNotNull())


def quarantine(parsed: DataFrame) -> DataFrame:
    """The raw lines whose time could not be read."""
    return parsed.filter(F.col("time").isNull()).select("value")
