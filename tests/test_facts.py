"""Joins with hot keys, fact loads, rejects, periods, geo lookup."""

import pytest
from pyspark.sql import functions as F

from starmart.operators.facts import Lookup, balance, fact_rejects, load_fact, replace_period, same
from starmart.operators.geo import assign_country, enrich_country, unique_geo
from starmart.operators.joins import hot_keys, lookup_join, measured

DIM = "sk_c bigint, name string, start_date timestamp_ntz, end_date timestamp_ntz"


def ts(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def dim_of(spark, *rows):
    text = DIM.replace("timestamp_ntz", "string")
    return ts(spark.createDataFrame(list(rows), text), "start_date", "end_date")


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, many identical; a few without a key."""
    return spark.range(30_000).select(
        F.when(F.col("id") < 10_000, "hot")
        .when(F.col("id") < 10_050, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
        .alias("k"),
        (F.col("id") % 3).alias("v"),
    )


def test_hot_keys_are_found(spark, skewed):
    hot = hot_keys(skewed, [("k",), ("k", "v")], share=0.05)
    want = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    assert hot[("k",)] == [want]
    assert len(hot[("k", "v")]) == 3


def test_hot_keys_of_nothing(spark, skewed):
    assert hot_keys(skewed.filter(F.lit(False)), [("k",)]) == {("k",): []}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spreading_hot_keys_keeps_the_result(spark, skewed, how):
    lookup = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), (None, 5)], "name string, sk int"
    )
    plain = lookup_join(skewed, lookup, [("k", "name")], how)
    spread = lookup_join(
        skewed, lookup, [("k", "name")], how, hot_keys(skewed, [("k",)], 0.05)[("k",)]
    )
    assert spread.columns == plain.columns
    assert plain.exceptAll(spread).count() == 0
    assert spread.exceptAll(plain).count() == 0


def test_a_hot_key_reaches_many_partitions(spark, skewed):
    """Even when all its rows are alike."""
    alike = skewed.select("k").repartition(8)
    lookup = spark.createDataFrame([("hot", 1), ("k1", 3)], "name string, sk int")
    hot = hot_keys(alike, [("k",)], 0.05)[("k",)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(alike, lookup, [("k", "name")], hot=hot)
        sizes = [
            r["count"]
            for r in joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 10_000
    assert len(sizes) >= 4


def test_fact_and_rejects_make_up_the_staged_rows(spark):
    staged = spark.createDataFrame(
        [("a", "x", 1), ("a", "?", 2), ("?", "x", 3), ("?", "?", 4), (None, "x", 5)],
        "name string, other string, v int",
    )
    d1 = dim_of(spark, (1, "a", None, None), (2, "?", None, "2024-01-01"))
    d2 = dim_of(spark, (7, "x", None, None)).withColumnRenamed("sk_c", "sk_o")
    lookups = [
        Lookup(d1, "sk_c", same("name")),
        Lookup(d2, "sk_o", (("other", "name"),)),
    ]
    fact = load_fact(staged, lookups, ["sk_c", "sk_o", "v as measure"])
    assert [tuple(r) for r in fact.collect()] == [(1, 7, 1)]
    rejects = {r["v"]: r["missing"] for r in fact_rejects(staged, lookups).collect()}
    assert rejects == {2: "o", 3: "c", 4: "c", 5: "c"}


def test_two_open_versions_multiply_facts_but_not_rejects(spark):
    staged = spark.createDataFrame([("a", "?")], "name string, other string")
    twice = dim_of(spark, (1, "a", None, None), (2, "a", None, None))
    none = dim_of(spark, (9, "z", None, None)).withColumnRenamed("sk_c", "sk_o")
    assert load_fact(staged, [Lookup(twice, "sk_c", same("name"))], ["sk_c"]).count() == 2
    lookups = [Lookup(twice, "sk_c", same("name")), Lookup(none, "sk_o", (("other", "name"),))]
    assert fact_rejects(staged, lookups).count() == 1


def test_names_may_differ_in_case_by_collation(spark):
    staged = spark.createDataFrame([("ANN", 1), ("bob", 2), (None, 3)], "name string, v int")
    dim = dim_of(spark, (1, "Ann", None, None), (2, "Bob", None, "2024-01-01"))
    exact, lax = (Lookup(dim, "sk_c", same("name"), collation=c) for c in (None, "UTF8_LCASE"))
    assert load_fact(staged, [exact], ["v"]).count() == 0
    assert [tuple(r) for r in load_fact(staged, [lax], ["sk_c", "v"]).collect()] == [(1, 1)]
    assert sorted(r["v"] for r in fact_rejects(staged, [lax]).collect()) == [2, 3]


def test_balance_broadcasts_small_dimensions_and_spreads_the_rest(spark, skewed, monkeypatch):
    small = dim_of(spark, (1, "hot", None, None), (2, "k1", None, None))
    large = dim_of(spark, *[(i, f"k{i}", None, None) for i in range(20)], (99, "hot", None, None))
    large = large.withColumnRenamed("sk_c", "sk_o")
    lookups = [Lookup(large, "sk_o", (("k", "name"),)), Lookup(small, "sk_c", (("k", "name"),))]
    monkeypatch.setattr("starmart.operators.facts.BROADCAST_ROWS", 10)
    how = balance(skewed, lookups)
    assert how.small == {"sk_c"} and len(how.hot[("k",)]) >= 1
    plain = load_fact(skewed, lookups, ["sk_o", "sk_c", "v"])
    spread = load_fact(skewed, lookups, ["sk_o", "sk_c", "v"], how)
    assert plain.exceptAll(spread).count() == spread.exceptAll(plain).count() == 0
    rejects = [fact_rejects(skewed, lookups, h) for h in (None, how)]
    assert rejects[0].exceptAll(rejects[1]).count() == rejects[1].exceptAll(rejects[0]).count() == 0
    assert plain.count() + rejects[0].count() == skewed.count()


def test_few_wide_rows_are_not_broadcast(spark, skewed, monkeypatch):
    short = dim_of(spark, (1, "hot", None, None), (2, "k1", None, None))
    wide = dim_of(spark, (1, "hot", None, None), (2, "w" * 5000, None, None), (None, None, None, None))
    wide = wide.withColumnRenamed("sk_c", "sk_o")
    lookups = [Lookup(short, "sk_c", (("k", "name"),)), Lookup(wide, "sk_o", (("k", "name"),))]
    monkeypatch.setattr("starmart.operators.facts.BROADCAST_BYTES", 4000)
    assert balance(skewed, lookups).small == {"sk_c"}
    assert measured(wide.select("name", "sk_o")) == (3, 3 * 16 + 3 + 5000 + 2)
    assert measured(wide.filter(F.lit(False))) == (0, 0)


def test_as_of_takes_the_version_of_the_day(spark):
    dim = dim_of(
        spark, (1, "a", "2020-01-01", "2021-01-01"), (2, "a", "2021-01-01", None)
    )
    staged = ts(
        spark.createDataFrame(
            [("a", "2019-12-31"), ("a", "2020-12-31"), ("a", "2021-01-01")],
            "name string, at string",
        ),
        "at",
    )
    fact = load_fact(staged, [Lookup(dim, "sk_c", same("name"), as_of="at")], ["sk_c", "at"])
    assert sorted((r["at"].year, r["sk_c"]) for r in fact.collect()) == [(2020, 1), (2021, 2)]


def test_period_edges_belong_to_the_period(spark):
    def rows(*pairs):
        return ts(spark.createDataFrame(list(pairs), "v int, at string"), "at")

    days = ["2020-01-01", "2020-01-10", "2020-01-20", "2020-01-21", None]
    fact = rows(*enumerate(days, 1))
    once = replace_period(fact, rows((9, "2020-01-15")), "at", "2020-01-10", "2020-01-20")
    assert sorted(r["v"] for r in once.collect()) == [1, 4, 5, 9]
    twice = replace_period(once, rows((9, "2020-01-15")), "at", "2020-01-10", "2020-01-20")
    assert sorted(r["v"] for r in twice.collect()) == [1, 4, 5, 9]


def test_geo_keeps_one_row_per_log_row(spark):
    logs = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "ipaddr string")
    geo = spark.createDataFrame(
        [("x", "Peru"), ("x", "Chile"), ("y", "Cuba"), (None, "Nowhere")],
        "ip string, country_name string",
    )
    out = enrich_country(logs, unique_geo(geo))
    got = sorted((r["ipaddr"] or "", r["country_name"]) for r in out.collect())
    assert got == [("", None), ("x", "Chile"), ("x", "Chile"), ("y", "Cuba")]


def test_assigned_country_follows_the_ip(spark):
    logs = spark.range(500).select(
        F.concat(F.lit("10.0.0."), (F.col("id") % 100).cast("string")).alias("ipaddr")
    )
    names = spark.createDataFrame([("A",), ("B, the second",), ("C",)], "value string")
    a = assign_country(logs, names)
    assert a.count() == 500
    assert a.groupBy("ipaddr").agg(F.countDistinct("country_name").alias("n")).filter(
        "n > 1"
    ).count() == 0
    assert {r[0] for r in a.select("country_name").distinct().collect()} == {
        "A",
        "B, the second",
        "C",
    }
    nobody = spark.createDataFrame([(None,)], "ipaddr string")
    assert assign_country(nobody, names).first()["country_name"] is None
    b = assign_country(logs.repartition(7), names.repartition(2))
    assert a.exceptAll(b).count() == 0
