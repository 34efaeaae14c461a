"""User agent -> operating system family and device kind, as native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed rule table: the first family with a matching mark wins.
OS_FAMILIES = [
    ("Windows Phone", ["Windows Phone"]),
    ("Windows", ["Windows"]),
    ("iOS", ["iPhone", "iPad", "iPod"]),
    ("Android", ["Android"]),
    ("Chrome OS", ["CrOS"]),
    ("Mac OS X", ["Mac OS X", "Macintosh"]),
    ("Ubuntu", ["Ubuntu"]),
    ("Linux", ["Linux", "X11"]),
]
TABLET_MARKS = ["iPad", "Kindle", "PlayBook", "Silk/"]
MOBILE_MARKS = [
    "iPhone",
    "iPod",
    "Windows Phone",
    "BlackBerry",
    "IEMobile",
    "Opera Mini",
    "Opera Mobi",
]
PC_MARKS = ["Windows NT", "Macintosh", "CrOS"]


def _has_any(agent: Column, marks: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [agent.contains(m) for m in marks])


def classify_user_agent(df: DataFrame, col: str = "useragent") -> DataFrame:
    """Add ``device``, ``is_mobile``, ``is_pc`` and ``is_tablet`` derived from ``col``.

    An absent agent counts as ``Other`` with all flags 0.
    """
    family, *more = OS_FAMILIES
    agent = F.col("_agent")
    device = F.when(_has_any(agent, family[1]), family[0])
    for name, marks in more:
        device = device.when(_has_any(agent, marks), name)
    android, phone_mark = agent.contains("Android"), agent.contains("Mobile")
    tablet = _has_any(agent, TABLET_MARKS) | (
        android & ~phone_mark & ~agent.contains("Windows Phone")
    )
    mobile = _has_any(agent, MOBILE_MARKS) | (android & phone_mark)
    pc = _has_any(agent, PC_MARKS) | (agent.contains("X11") & agent.contains("Linux"))
    # In steps, so that each test is generated and evaluated once.
    return (
        df.withColumn("_agent", F.coalesce(F.col(col), F.lit("")))
        .select(
            "*",
            device.otherwise("Other").alias("device"),
            tablet.alias("_tablet"),
            mobile.alias("_mobile"),
            pc.alias("_pc"),
        )
        .select(
            *[F.col(c) for c in df.columns],
            "device",
            (~F.col("_tablet") & F.col("_mobile")).cast("int").alias("is_mobile"),
            (~F.col("_tablet") & ~F.col("_mobile") & F.col("_pc")).cast("int").alias("is_pc"),
            F.col("_tablet").cast("int").alias("is_tablet"),
        )
    )
