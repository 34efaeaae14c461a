"""Loads that touch the slices of their keys only, and as-of lookups by merge."""

import pytest
from pyspark.sql import functions as F
from test_plans import no_broadcast, plan

from starmart import schemas as S
from starmart.operators import dimensions as D
from starmart.operators.asof import valid_at
from starmart.operators.facts import Balance, Lookup, fact_rejects, load_fact, same
from starmart.operators.joins import hot_keys
from starmart.plans import pipelines as P
from starmart.session import scratch_path
from starmart.sources.store import Warehouse

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


@pytest.fixture
def wh(spark):
    return Warehouse(spark, scratch_path(spark, "wh"), key_slots=32)


def products(spark, *rows):
    return spark.createDataFrame(list(rows), "product_id long, product_name string")


def many(spark, n):
    return spark.range(n).select(
        F.col("id").alias("product_id"), F.concat(F.lit("p"), F.col("id")).alias("product_name")
    )


def files(wh, name, slices=None):
    return set(wh.table(name, slices).inputFiles())


def content(dim):
    return sorted((tuple(r) for r in dim.collect()), key=repr)


def test_ten_keys_write_their_slices_only(spark, wh):
    P.merge_versions(wh, S.PRODUCT, many(spark, 5000), T1)
    before = files(wh, "dim_product")
    batch = products(spark, *[(i * 37, "new") for i in range(10)])
    slots = wh.key_counts("dim_product", batch)
    touched = set(wh.slot_slices("dim_product", slots))
    untouched = set(wh.slices("dim_product")) - touched
    assert 1 <= len(touched) <= 10 and len(untouched) >= 22
    P.merge_versions(wh, S.PRODUCT, batch, T2)
    after = files(wh, "dim_product")
    assert files(wh, "dim_product", untouched) == before & after
    written = {f.split("key_slice=")[1].split("/")[0] for f in after - before}
    assert {s.split("-")[1] for s in written} == {str(s) for s in slots}


def test_equal_to_the_whole_merge(spark, wh):
    """The same rows and keys as the dimension merged as a whole, NULL keys and variants too."""
    loads = [
        products(spark, *[(i, f"a{i % 7}") for i in range(60)], (None, "none")),
        products(spark, (3, "b"), (3, "c"), (None, "none"), (None, "other"), (61, None), (4, "a4")),
        products(spark, (3, "a3"), (61, None), (62, "z")),
    ]
    dim = S.empty_frame(spark, S.PRODUCT.schema)
    for staged, at in zip(loads, (T1, T2, T3)):
        P.merge_versions(wh, S.PRODUCT, staged, at)
        dim = D.scd2_merge(dim, staged, ["product_id"], ["product_name"], "sk_product", at)
        assert content(wh.table("dim_product")) == content(dim)


@pytest.mark.parametrize("options", [{"variants": "latest"}, {"compare": "current"}])
def test_options_by_slices(spark, wh, options):
    kind = "product_id long, product_name string, order_date timestamp_ntz"

    def staged(*rows):
        df = spark.createDataFrame(list(rows), "product_id long, product_name string, at string")
        return df.select("product_id", "product_name", F.col("at").cast("timestamp_ntz").alias("order_date"))

    first = staged((1, "a", "2020-01-01"), (1, "b", "2020-01-02"), (2, "x", "2020-01-01"))
    again = staged((1, "a", "2020-02-01"), (2, "y", "2020-02-01"), (2, "x", "2020-02-02"))
    assert first.schema.simpleString() == spark.createDataFrame([], kind).schema.simpleString()
    dim = S.empty_frame(spark, S.PRODUCT.schema)
    for rows, at in ((first, T1), (again, T2)):
        P.merge_versions(wh, S.PRODUCT, rows, at, options)
        dim = D.scd2_merge(
            dim, rows, ["product_id"], ["product_name"], "sk_product", at, **options
        )
        assert content(wh.table("dim_product")) == content(dim)


def test_nothing_new_writes_nothing(spark, wh):
    P.merge_versions(wh, S.PRODUCT, many(spark, 50), T1)
    version = wh.version("dim_product")
    P.merge_versions(wh, S.PRODUCT, many(spark, 20), T2)
    assert wh.version("dim_product") == version
    P.merge_versions(wh, S.PRODUCT, many(spark, 0), T2)
    assert wh.version("dim_product") == version


def test_the_highest_key_is_noted(spark, wh):
    P.merge_versions(wh, S.PRODUCT, many(spark, 50), T1)
    assert wh.next_key("dim_product", "sk_product") == 51
    P.merge_versions(wh, S.PRODUCT, products(spark, (7, "x"), (100, "y")), T2)
    assert wh.next_key("dim_product", "sk_product") == 53
    # rows written by hand have no note, so the keys are read
    wh.overwrite("dim_product", wh.table("dim_product").filter("sk_product < 20"))
    assert wh.next_key("dim_product", "sk_product") == 20


def test_slots_stay_as_the_table_was_written(spark, wh):
    P.merge_versions(wh, S.PRODUCT, many(spark, 50), T1)
    other = Warehouse(spark, wh.root, key_slots=5)
    P.merge_versions(other, S.PRODUCT, products(spark, (7, "new")), T2)
    rows = other.table("dim_product").filter("product_id = 7").collect()
    assert sorted(r["end_date"] is None for r in rows) == [False, True]


def test_key_types_share_slots(spark, wh):
    """Staged keys of another numeric type find the slices of the dimension's."""
    P.merge_versions(wh, S.PRODUCT, many(spark, 50), T1)
    narrow = products(spark, (7, "p7")).withColumn("product_id", F.col("product_id").cast("int"))
    version = wh.version("dim_product")
    P.merge_versions(wh, S.PRODUCT, narrow, T2)
    assert wh.version("dim_product") == version


def test_few_values_leave_the_dimension_where_it_is(spark, wh):
    """Without other broadcasts: what is exchanged comes after the reduction to the batch."""
    P.merge_versions(wh, S.PRODUCT, many(spark, 3000), T1)
    dim, batch = wh.table("dim_product"), products(spark, (1, "x"), (2, "y"))
    with no_broadcast(spark):
        text = plan(D.among(dim, batch, ["product_id"], 2))
        assert "BroadcastHashJoin LeftSemi" in text
        closing = D.close_versions(
            dim, D._open_version(batch.withColumn("sk_product", F.lit(9)), "sk_product",
                                 ["product_id", "product_name"], T2),
            ["product_id"], "sk_product", T2, few=True,
        )
        assert "BroadcastHashJoin LeftOuter" in plan(closing)


@pytest.mark.parametrize(
    "first, second, want",
    [
        (["a", "b"], ["b", "c", None], ["a", "b", "c"]),
        (["a", None], ["b", None], ["a", None]),
        ([], ["a", None, "a"], ["a", None]),
        (["a"], [], ["a"]),
    ],
)
def test_members_by_slice(spark, wh, first, second, want):
    """NOT IN against the whole dimension, though only some slices are read."""
    rows = [[(v,) for v in part] for part in (first, second)]
    one, two = (spark.createDataFrame(r, "lead_source string") for r in rows)
    if first:
        dim = D.add_members(
            S.empty_frame(spark, S.LEADSOURCE.schema), one, ["lead_source"], "sk_leadsource", T1, "except"
        )
        wh.append("dim_leadsource", dim)
    P.load_members(wh, S.LEADSOURCE, two, T2)
    found = [r["lead_source"] for r in wh.table("dim_leadsource").collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


VERSIONS = "sk long, k string, j long, start_date string, end_date string"
FACTS = "id long, k string, j long, at string"


def versions(spark, *rows):
    df = spark.createDataFrame(list(rows), VERSIONS)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_date", "end_date")})


def facts(spark, *rows):
    return spark.createDataFrame(list(rows), FACTS).withColumn("at", F.col("at").cast("timestamp_ntz"))


HISTORY = [
    (1, "a", 1, "2020-01-01", "2020-02-01"),
    (2, "a", 1, "2020-02-01", None),
    (3, "a", 1, "2020-01-15", "2020-03-01"),  # overlaps both
    (4, "b", 1, "2020-01-01", "2020-01-10"),  # then a gap
    (5, "b", 1, "2020-02-01", None),
    (6, None, 1, "2020-01-01", None),
    (7, "c", None, "2020-01-01", None),
    (8, "d", 1, None, None),
    (9, "a", 2, "2020-01-01", None),
]
TIMES = ("2019-12-31", "2020-01-01", "2020-01-09 23:59:59", "2020-01-10", "2020-01-20", "2020-02-01", "2021-01-01", None)
ASKED = [
    (n, k, j, t)
    for n, (k, j, t) in enumerate((k, j, t) for k in ("a", "b", "c", "d", "e", None) for j in (1, 2, None) for t in TIMES)
]


def by_range_join(f, v):
    found = f.join(v.select("sk", F.col("k").alias("vk"), F.col("j").alias("vj"), "start_date", "end_date"),
                   (F.col("k") == F.col("vk")) & (F.col("j") == F.col("vj")) & (F.col("at") >= F.col("start_date"))
                   & (F.col("end_date").isNull() | (F.col("at") < F.col("end_date"))))
    return sorted((r["id"], r["sk"]) for r in found.collect())


@pytest.mark.parametrize("share", [None, 0.001])
def test_as_of_by_merge(spark, share):
    """Gaps, overlaps, boundaries, NULL keys and times; every key hot or none."""
    f, v = facts(spark, *ASKED, *ASKED), versions(spark, *HISTORY)
    hot = hot_keys(f, [["k", "j"]], share=share)[("k", "j")] if share else ()
    found = valid_at(f, v, [("k", "k"), ("j", "j")], "at", "sk", hot)
    assert found.count() == f.count() and found.columns == [*f.columns, "_valid"]
    pairs = sorted((r["id"], s) for r in found.collect() for s in r["_valid"] or [])
    assert pairs == by_range_join(f, v) and pairs


def test_facts_and_rejects_as_of_split_the_rows(spark):
    f, v = facts(spark, *ASKED), versions(spark, *HISTORY)
    lookup = Lookup(v, "sk", same("k", "j"), as_of="at")
    loaded = {r["id"] for r in load_fact(f, [lookup], ["id", "sk"]).collect()}
    broadcast = Balance(frozenset(["sk"]))
    assert loaded == {r["id"] for r in load_fact(f, [lookup], ["id", "sk"], broadcast).collect()}
    rejected = fact_rejects(f, [lookup])
    assert {r["missing"] for r in rejected.collect()} == {"sk"}
    rest = [r["id"] for r in rejected.collect()]
    assert sorted(rest) == sorted({a[0] for a in ASKED} - loaded)
    assert rest and sorted(r["id"] for r in fact_rejects(f, [lookup], broadcast).collect()) == sorted(rest)


def test_as_of_of_nothing(spark):
    f, v = facts(spark), versions(spark)
    assert load_fact(f, [Lookup(v, "sk", same("k"), as_of="at")], ["id", "sk"]).collect() == []
    some = facts(spark, (1, "a", 1, "2020-01-01"))
    assert fact_rejects(some, [Lookup(v, "sk", same("k"), as_of="at")]).count() == 1
