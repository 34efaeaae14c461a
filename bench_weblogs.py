"""Log lines per second: the native parse and classification against one Python UDF per column.

The second form is how such a job is often written: every column is a row-at-a-time Python UDF
that matches the whole line, or tests the whole agent, again. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import adapters
from starmart.functions.useragent import MOBILE_MARKS, PC_MARKS, TABLET_MARKS, classify_user_agent
from starmart.functions.weblog import LINE, parse_weblogs, readable
from starmart.session import configure, scratch_path

COPIES = int(os.environ.get("BENCH_COPIES", "10"))


def native(lines: DataFrame) -> DataFrame:
    parsed = readable(parse_weblogs(lines)).select("ipaddr", "username", "time", "useragent")
    return classify_user_agent(parsed).drop("useragent")


def per_column_udfs(lines: DataFrame) -> DataFrame:
    pattern = re.compile(LINE)

    def group(i: int):
        def get(line):
            m = pattern.match(line)
            return m.group(i) if m else None

        return F.udf(get, "string")

    def any_of(marks):
        return F.udf(lambda agent: int(any(m in (agent or "") for m in marks)), "int")

    value = F.col("value")
    stamp = F.substring(group(4)(value), 1, 20)
    return (
        lines.withColumn("ipaddr", group(1)(value))
        .withColumn("useragent", group(9)(value))
        .withColumn("username", group(3)(value))
        .withColumn("time", F.try_to_timestamp(stamp, F.lit("dd/MMM/yyyy:HH:mm:ss")))
        .filter(F.col("time").isNotNull())
        .withColumn("device", F.udf(lambda a: (a or "").split(" ")[0], "string")("useragent"))
        .withColumn("is_mobile", any_of(MOBILE_MARKS)("useragent"))
        .withColumn("is_pc", any_of(PC_MARKS)("useragent"))
        .withColumn("is_tablet", any_of(TABLET_MARKS)("useragent"))
        .drop("useragent", "value")
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    path = scratch_path(spark, "bench-lines")
    copies = F.explode(F.array_repeat("value", COPIES)).alias("value")
    adapters.weblog_lines(spark, sf_dir).select(copies).repartition(int(cpus)).write.text(path)
    lines = spark.read.text(path)
    n = lines.count()
    rates = {}
    for name, form in (("native", native), ("python_udf_per_column", per_column_udfs)):
        best = float("inf")
        for _ in range(3):
            start = time.perf_counter()
            form(lines).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        rates[name] = round(n / best)
    spark.stop()
    print(json.dumps({"metric": "log lines per second", "lines": n, **rates}))


if __name__ == "__main__":
    main()
