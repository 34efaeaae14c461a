"""Repeatable web log lines for development."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.literals import pick, wall_clock
from starmart.functions.weblog import MONTHS
from starmart.operators.geo import indexed
from starmart.operators.joins import lookup_join

# Fixed value: the part every generated line has between its time and its agent.
LINE_TAIL = ' -0700] "GET /favicon.ico HTTP/1.1" 404 209 "http://www.example.com/start.html" "'


def log_stamp(time: Column) -> Column:
    """TIMESTAMP_NTZ -> ``10/Jan/2021:14:03:00``.

    Cut from the ISO text: ``date_format`` would go through the session time zone, where some
    clock times do not exist.
    """
    iso = time.cast("string")
    names = F.array(*[F.lit(m) for m in MONTHS])
    return F.concat(
        iso.substr(9, 2),
        F.lit("/"),
        F.element_at(names, F.month(time)),
        F.lit("/"),
        iso.substr(1, 4),
        F.lit(":"),
        iso.substr(12, 8),
    )


def synth_weblogs(
    spark: SparkSession,
    customers: DataFrame,
    agents: DataFrame,
    n: int,
    seed: int = 0,
    start: datetime = datetime(2021, 1, 1),
    end: datetime = datetime(2021, 12, 31, 23, 59, 59),
    partitions: int | None = None,
) -> DataFrame:
    """``n`` log lines (column ``value``) with drawn ip, customer, second and agent.

    Line *i* depends on ``i`` and ``seed`` only, not on the partitioning. ``customers`` needs
    ``customer_id`` and ``username``; ``agents`` is a one-column list. The second lies in
    ``[start, end)``.
    """
    users, n_users = indexed(customers.select("customer_id", "username"), ["customer_id"])
    kinds, n_kinds = indexed(agents.toDF("agent").distinct(), ["agent"])
    span = int((end - start).total_seconds())

    def draw(size: int, tag: str):
        return pick(size, F.lit(seed), tag, F.col("id"))

    octet = [F.shiftright(F.col("_ip"), s).bitwiseAND(F.lit(255)) for s in (16, 8, 0)]
    drawn = spark.range(0, n, 1, partitions).select(
        # First octet 1 to 223: unicast addresses.
        draw(223 << 24, "ip").alias("_ip"),
        draw(n_users, "user").alias("_user"),
        draw(span, "second").alias("_second"),
        draw(n_kinds, "agent").alias("_agent"),
    )
    rows = lookup_join(drawn, users.drop("customer_id"), [("_user", "_idx")]).drop("_idx")
    rows = lookup_join(rows, kinds, [("_agent", "_idx")])
    time = wall_clock(start) + F.make_dt_interval(secs=F.col("_second"))
    return rows.select(
        F.concat(
            F.concat_ws(
                ".", (F.shiftright(F.col("_ip"), 24) + 1).cast("string"),
                *[o.cast("string") for o in octet],
            ),
            F.lit(" - "),
            F.col("username"),
            F.lit(" ["),
            log_stamp(time),
            F.lit(LINE_TAIL),
            F.col("agent"),
            F.lit('"'),
        ).alias("value")
    )
