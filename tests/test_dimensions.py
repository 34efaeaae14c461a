"""Versioned and insert-only dimensions: states, NULL rules, keys."""

import pytest
from pyspark.sql import functions as F

from starmart.operators.dimensions import (
    add_members,
    current,
    fresh_rows,
    scd2_changes,
    scd2_merge,
)
from starmart.operators.keys import assign_keys, next_key
from starmart.schemas import PRODUCT, empty_frame

T1, T2, T3, T4 = (f"2024-0{i}-01 00:00:00" for i in range(1, 5))


def staged(spark, *rows):
    return spark.createDataFrame(list(rows), "product_id bigint, product_name string")


def load(dim, rows, ts, **options):
    return scd2_merge(dim, rows, PRODUCT.key, PRODUCT.attrs, PRODUCT.sk, ts, **options)


def versions(dim):
    """(key, attribute, start month, end month or None) ordered by surrogate key."""
    return [
        (
            r["product_id"],
            r["product_name"],
            r["start_date"].month,
            r["end_date"].month if r["end_date"] else None,
        )
        for r in dim.orderBy("sk_product").collect()
    ]


@pytest.fixture
def empty(spark):
    return empty_frame(spark, PRODUCT.schema)


def test_first_load_opens_one_version_per_row(spark, empty):
    dim = load(empty, staged(spark, (2, "b"), (1, "a"), (1, "a")), T1)
    assert versions(dim) == [(1, "a", 1, None), (2, "b", 1, None)]


def test_unchanged_rows_change_nothing(spark, empty):
    dim = load(empty, staged(spark, (1, "a")), T1)
    again = load(dim, staged(spark, (1, "a")), T2)
    assert versions(again) == [(1, "a", 1, None)]


def test_empty_batch_changes_nothing(spark, empty):
    dim = load(empty, staged(spark, (1, "a")), T1)
    assert versions(load(dim, staged(spark), T2)) == [(1, "a", 1, None)]


def test_a_change_closes_the_old_version_when_the_new_one_starts(spark, empty):
    dim = load(empty, staged(spark, (1, "a"), (2, "b")), T1)
    dim = load(dim, staged(spark, (1, "x")), T2)
    assert versions(dim) == [(1, "a", 1, 2), (2, "b", 1, None), (1, "x", 2, None)]


def test_going_back_to_an_earlier_value(spark, empty):
    states = {}
    for compare in ("history", "current"):
        dim = empty
        for ts, name in ((T1, "A"), (T2, "A"), (T3, "B"), (T4, "A")):
            dim = load(dim, staged(spark, (7, name)), ts, compare=compare)
        states[compare] = versions(dim)
    assert states["history"] == [(7, "A", 1, 3), (7, "B", 3, None)]
    assert states["current"] == [(7, "A", 1, 3), (7, "B", 3, 4), (7, "A", 4, None)]


def test_two_variants_of_a_key_in_one_batch(spark, empty):
    rows = spark.createDataFrame(
        [(1, "A", T1), (1, "B", T2), (1, "A", None)],
        "product_id bigint, product_name string, order_date string",
    )
    assert len(versions(load(empty, rows, T1))) == 2
    assert versions(load(empty, rows, T1, variants="latest")) == [(1, "B", 1, None)]


def test_a_null_key_is_never_closed(spark, empty):
    dim = load(empty, staged(spark, (None, "a")), T1)
    dim = load(dim, staged(spark, (None, "a"), (None, "b")), T2)
    assert versions(dim) == [(None, "a", 1, None), (None, "b", 2, None)]


def test_a_null_attribute_is_a_value(spark, empty):
    dim = load(empty, staged(spark, (1, None)), T1)
    dim = load(dim, staged(spark, (1, None)), T2)
    dim = load(dim, staged(spark, (1, "a")), T3)
    assert versions(dim) == [(1, None, 1, 3), (1, "a", 3, None)]


def test_keys_are_never_reused_and_one_version_is_open(spark, empty):
    dim = empty
    for month, ts in enumerate((T1, T2, T3), 1):
        rows = spark.range(200).select(
            F.col("id").alias("product_id"),
            F.concat(F.lit("n"), (F.col("id") % month).cast("string")).alias("product_name"),
        )
        dim = load(dim, rows, ts)
    assert dim.count() == dim.select("sk_product").distinct().count()
    assert current(dim).groupBy("product_id").count().filter("count > 1").count() == 0


def test_changes_leave_out_closed_history(spark, empty):
    dim = load(load(empty, staged(spark, (1, "a")), T1), staged(spark, (1, "b")), T2)
    third = staged(spark, (1, "c"))
    changes = scd2_changes(dim, third, PRODUCT.key, PRODUCT.attrs, PRODUCT.sk, T3)
    assert versions(changes) == [(1, "b", 2, 3), (1, "c", 3, None)]


def test_null_matrix(spark):
    """staged {a, b, b, NULL} against dimensions {}, {a}, {a, NULL}."""
    batch = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "m string")
    dims = [[], ["a"], ["a", None]]
    want = {
        "not_in": [{"a", "b", None}, {"b"}, set()],
        "except": [{"a", "b", None}, {"b", None}, {"b"}],
        "antijoin": [{"a", "b", None}, {"b", None}, {"b", None}],
    }
    for mode, answers in want.items():
        for members, answer in zip(dims, answers):
            known = spark.createDataFrame([(m,) for m in members], "m string")
            fresh = {r["m"]: r["_n"] for r in fresh_rows(batch, known, ["m"], mode).collect()}
            assert set(fresh) == answer, (mode, members)
            assert fresh.get("b", 2) == 2


def test_repeats_are_kept_on_request(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "ipaddr string")
    dim = spark.createDataFrame(
        [(5, "a", None, None)],
        "sk bigint, ipaddr string, start_date timestamp_ntz, end_date timestamp_ntz",
    )
    out = add_members(dim, batch, ["ipaddr"], "sk", T1, "antijoin", distinct=False)
    got = [(r["sk"], r["ipaddr"]) for r in out.orderBy("sk").collect()]
    assert got == [(5, "a"), (6, None), (7, "b"), (8, "b")]


def test_repeats_of_a_large_group_are_numbered_without_gaps(spark):
    batch = spark.range(45_000).select(
        F.when(F.col("id") < 30_000, "hot").otherwise(F.col("id").cast("string")).alias("m")
    )
    dim = empty_frame(spark, add_schema("m"))
    out = add_members(dim, batch, ["m"], "sk", T1, "antijoin", distinct=False)
    n, low, high, kinds, hot = out.agg(
        F.count("*"), F.min("sk"), F.max("sk"), F.countDistinct("sk"),
        F.count_if(F.col("m") == "hot"),
    ).first()
    assert (n, low, high, kinds, hot) == (45_000, 1, 45_000, 45_000, 30_000)


def add_schema(col):
    from starmart.schemas import Dimension

    return Dimension("d", "sk", (col,), (), f"{col} string").schema


def test_not_in_takes_one_column(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    with pytest.raises(ValueError):
        fresh_rows(df, df, ["x", "y"], "not_in")


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_keys_equal_a_global_row_number(spark, parts):
    # Without coalescing there are several ranges even for few rows.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(1000).select(
            F.pmod(F.col("id") * 7919, F.lit(1009)).alias("k"), F.col("id").alias("v")
        ).repartition(parts)
        keyed = assign_keys(rows, "sk", ["k"], start=50)
        assert keyed.columns == ["sk", "k", "v"]
        got = [(r["sk"], r["k"]) for r in keyed.orderBy("sk").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ks = sorted((i * 7919) % 1009 for i in range(1000))
    assert got == list(zip(range(50, 1050), ks))


def test_next_key(spark, empty):
    assert next_key(empty, "sk_product") == 1
    assert next_key(load(empty, staged(spark, (1, "a"), (2, "b")), T1), "sk_product") == 3
