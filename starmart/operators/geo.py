"""Country of an ip address: from a lookup table, or a repeatable stand-in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.literals import pick
from starmart.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, lookup_join, measured
from starmart.operators.keys import assign_keys


# Keys that rows without an ip are spread over.
_SPREAD = 100_000


def unique_geo(geo: DataFrame) -> DataFrame:
    """One row per ip; of several countries the first by name is kept."""
    return geo.groupBy("ip").agg(F.min("country_name").alias("country_name"))


def enrich_country(logs: DataFrame, geo: DataFrame, hot: Sequence[int] = ()) -> DataFrame:
    """Add ``country_name`` to each log row; NULL for an unknown ip.

    ``geo`` must be unique per ip (``unique_geo`` makes it so); then the row count stays. Rows
    without an ip match nothing; they are spread over keys that no ip equals.
    """
    side = geo.select(F.col("ip").alias("_geo_ip"), "country_name")
    none = F.concat(F.lit("no ip "), F.pmod(F.xxhash64(*logs.columns), F.lit(_SPREAD)))
    keyed = logs.withColumn("_ip", F.coalesce("ipaddr", none))
    return lookup_join(keyed, side, [("_ip", "_geo_ip")], "left", hot).drop("_ip", "_geo_ip")


def indexed(values: DataFrame, order_cols: list[str]) -> tuple[DataFrame, int]:
    """``values`` numbered from 0 as ``_idx``, hinted for broadcast if short; and its length."""
    rows = assign_keys(values, "_idx", order_cols, start=0)
    n, size = measured(rows)
    few = n <= BROADCAST_ROWS and size <= BROADCAST_BYTES
    return (F.broadcast(rows) if few else rows), n


def assign_country(
    logs: DataFrame, countries: DataFrame, ip_col: str = "ipaddr", seed: int = 0
) -> DataFrame:
    """Add a made-up ``country_name``: the same ip always gets the same entry of the list.

    A NULL ip has no country.

    ``countries`` has one column, as ``read_lookup_list`` returns it. Needs no shuffle of the
    logs, since the entry follows from the ip alone.
    """
    names, n = indexed(countries.toDF("country_name").distinct(), ["country_name"])
    drawn_no = F.when(F.col(ip_col).isNotNull(), pick(n, F.lit(seed), F.col(ip_col)))
    drawn = logs.withColumn("_pick", drawn_no)
    return lookup_join(drawn, names, [("_pick", "_idx")], "left").drop("_pick", "_idx")
