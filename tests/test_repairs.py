"""Cases that once lost, doubled or misread rows."""

import io
import os
import time
import zipfile
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart import adapters as A
from starmart.checks import queries as Q
from starmart.operators.facts import Lookup, balance, fact_rejects, load_fact, same
from starmart.operators.joins import hot_keys, lookup_join
from starmart.plans import pipelines as P
from starmart.session import scratch_path
from starmart.sources.spreadsheet import parse_workbooks
from starmart.sources.store import Warehouse
from starmart.streaming.inbox import ingest_weblogs

SF = "/root/testdata/sf0.001"
T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
TYPES = ["int", "bigint", "decimal(12,0)", "decimal(12,2)"]


def dimension(spark, n, kind):
    return spark.range(n).select(
        (F.col("id") + 1).alias("sk_c"),
        F.col("id").cast(kind).alias("k"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("start_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
    )


@pytest.mark.parametrize("size", [100_000, 100_001])
def test_facts_do_not_depend_on_the_size_of_a_dimension(spark, size):
    staged = spark.range(1000).select((F.col("id") % 3).cast("int").alias("k"))
    lookups = [Lookup(dimension(spark, size, "bigint"), "sk_c", same("k"))]
    how = balance(staged, lookups)
    assert load_fact(staged, lookups, ["sk_c"], how).count() == 1000
    assert fact_rejects(staged, lookups, how).count() == 0


@pytest.mark.parametrize("left", TYPES)
@pytest.mark.parametrize("right", TYPES)
def test_spread_keys_of_two_numeric_types(spark, left, right):
    facts = spark.range(4000).select(F.when(F.col("id") > 50, F.col("id") % 4).cast(left).alias("k"))
    lookup = dimension(spark, 6, right).withColumnRenamed("k", "d")
    hot = hot_keys(facts, [("k",)])[("k",)]
    assert len(hot) >= 4
    for how in ("inner", "left"):
        plain = lookup_join(facts, lookup, [("k", "d")], how).groupBy("k", "sk_c").count()
        spread = lookup_join(facts, lookup, [("k", "d")], how, hot).groupBy("k", "sk_c").count()
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, spread.collect()))


def test_keys_of_other_types_are_refused(spark):
    facts = spark.createDataFrame([("1",)], "k string")
    with pytest.raises(TypeError, match="k is string"):
        lookup_join(facts, dimension(spark, 3, "int").withColumnRenamed("k", "d"), [("k", "d")])


def test_extract_spreads_keys_of_other_types(spark):
    from starmart.operators.extract import extract_orders, hot_order_keys

    src = A.order_system(spark, SF)
    narrow = src["orders"].withColumn("CUIT", F.col("CUIT").cast("int"))
    src = src.replaced(orders=narrow)
    assert extract_orders(src, hot=hot_order_keys(src)).count() == extract_orders(src).count() > 0


def test_look_back_counts_no_order_twice(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    src = A.order_system(spark, SF)
    late = F.col("order_id") % 40 == 1
    P.run_orders(wh, src.replaced(orders=src["orders"].filter(~late)), T1)
    P.run_orders(wh, src, T2, lookback=timedelta(days=5000))
    P.run_orders(wh, src, T2, lookback=timedelta(days=30))
    P.run_orders(wh, src, T2)
    assert wh.table("fact_orders").count() == src["orders"].count()


def test_batches_keep_all_rejects_and_a_new_checkpoint_fails(spark, tmp_path):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    P.run_orders(wh, A.order_system(spark, SF), T1)
    lines, geo = A.weblog_lines(spark, SF), A.geo(spark, SF)
    inbox, state, archive = (str(tmp_path / n) for n in ("in", "state", "done"))
    lines.repartition(3).write.text(inbox)
    ingest_weblogs(wh, inbox, state, geo, T1, files_per_batch=1, archive=archive)
    whole = Warehouse(spark, scratch_path(spark, "wh"))
    P.run_orders(whole, A.order_system(spark, SF), T1)
    P.run_logs(whole, lines, geo, T1)
    for read in (P.quarantined_lines, P.log_rejects, lambda w: w.table("fact_logs")):
        assert read(wh).count() == read(whole).count() > 0
    files = [f for d, _, names in os.walk(archive) for f in names if f.startswith("part-")]
    assert len(files) == 3 and not [f for f in os.listdir(inbox) if f.startswith("part-")]
    lines.limit(5).write.mode("append").text(inbox)
    with pytest.raises(Exception, match="made anew"):
        ingest_weblogs(wh, inbox, _anew(state), geo, T1)


def _anew(state):
    """The checkpoint at the same path, without what it knew."""
    for folder, _, names in os.walk(state):
        for name in names:
            os.remove(os.path.join(folder, name))
    return state


def test_a_lower_batch_number_fails(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    members = dimension(spark, 1, "string").selectExpr(
        "sk_c sk_country", "k country_name", "start_date", "end_date"
    )
    for number in (0, 5, 5):
        wh.append("dim_country", members, batch=("feed", number))
    assert wh.table("dim_country").count() == 2
    with pytest.raises(ValueError, match="batch 5"):
        wh.append("dim_country", members, batch=("feed", 4))


def test_repeated_ips_do_not_multiply_logs(spark):
    geo = A.geo(spark, SF)
    lines = A.weblog_lines(spark, SF)
    twice = geo.unionByName(geo.withColumn("country_name", F.lit("zz")))
    once = P.stage_weblogs(lines, geo)
    assert P.stage_weblogs(lines, twice).exceptAll(once).count() == 0
    assert P.stage_weblogs(lines, twice).count() == once.count()


def test_members_in_three_cases_give_one_fact(spark):
    dim = spark.createDataFrame(
        [(1, "Web", T1, None), (2, "web", T1, None), (3, "WEB", T1, None)],
        "sk_s bigint, s string, start_date string, end_date string",
    )
    lookup = Lookup(dim, "sk_s", same("s"), collation="UTF8_LCASE")
    staged = spark.createDataFrame([("web",), ("Web",), ("wEB",)], "s string")
    assert [r.sk_s for r in load_fact(staged, [lookup], ["sk_s"]).collect()] == [1, 1, 1]


def workbook(cells, date1904=False):
    rows = "".join(
        "<row>" + "".join(f'<c t="{t}"><v>{v}</v></c>' if t != "s" else "<c/>" for t, v in row) + "</row>"
        for row in cells
    )
    mark = '<workbookPr date1904="1"/>' if date1904 else ""
    book = A._BOOK.replace("<sheets>", f"{mark}<sheets>")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", book)
        z.writestr("xl/_rels/workbook.xml.rels", A._LINKS)
        z.writestr("xl/worksheets/sheet1.xml", A._SHEET + rows + "</sheetData></worksheet>")
    return out.getvalue()


def read(spark, content, schema):
    files = spark.createDataFrame([("x.xlsx", bytearray(content))], "path string, content binary")
    from pyspark.sql.types import _parse_datatype_string

    return [tuple(r)[:-1] for r in parse_workbooks(files, _parse_datatype_string(schema)).collect()]


def test_workbook_dates_by_their_day_zero(spark):
    cells = [[("str", "d"), ("str", "t")], [("n", 45301), ("n", 45301.5)]]
    schema = "d date, t timestamp_ntz"
    assert read(spark, workbook(cells), schema) == [(date(2024, 1, 10), datetime(2024, 1, 10, 12))]
    later = read(spark, workbook(cells, date1904=True), schema)
    assert later == [(date(2028, 1, 11), datetime(2028, 1, 11, 12))]


def test_workbook_cells_of_every_type(spark):
    names = [("str", n) for n in "abcdef"]
    cells = [names, [("n", 1.1), ("b", 0), ("n", 0), ("str", "7"), ("b", 1), ("str", "2024-01-10")]]
    schema = "a decimal(10,2), b boolean, c boolean, d int, e string, f date"
    want = [(Decimal("1.10"), False, False, 7, "true", date(2024, 1, 10))]
    assert read(spark, workbook(cells), schema) == want
    with pytest.raises(TypeError, match="a array<int>"):
        read(spark, workbook(cells), "a array<int>")


def test_inbox_lines_and_countries_are_made_once(spark, monkeypatch):
    made = {}

    def counted(name, column):
        rows = spark.sparkContext.accumulator(0)
        real, made[name] = getattr(A, name), rows

        @F.udf("string")
        def note(value):
            rows.add(1)
            return value

        note = note.asNondeterministic()
        monkeypatch.setattr(A, name, lambda *a: real(*a).withColumn(column, note(column)))

    expected = A.geo(spark, SF).count(), A.weblog_lines(spark, SF).count()
    counted("geo", "country_name")
    counted("weblog_lines", "value")
    Q.queries()["inbox_same_name"](spark, SF).count()
    assert (made["geo"].value, made["weblog_lines"].value) == expected


def test_inbox_takes_a_file_of_the_same_name_and_length(spark, tmp_path):
    for text in ("a Windows line", "a Solaris line"):
        lines = spark.createDataFrame([(text,)], "value string").coalesce(1)
        Q._write_apart(lines.unionByName(lines.filter("false")), "Windows", f"{tmp_path}/{text}")
    inbox = f"{tmp_path}/inbox"
    times = []
    for text, found in (("a Windows line", "true"), ("a Solaris line", "false")):
        folder = f"{tmp_path}/{text}/found={found}"
        for name in os.listdir(folder):
            os.utime(f"{folder}/{name}", (1, 1))
        Q._drop_as(spark, folder, inbox, "access.log")
        times.append(os.stat(f"{inbox}/access.log.0").st_mtime_ns // 10**6)
        os.rename(f"{inbox}/access.log.0", f"{tmp_path}/{found}")
        time.sleep(0.01)
    assert times[0] != times[1]
    Q._drop_as(spark, f"{tmp_path}/none", inbox, "access.log")
    assert os.listdir(inbox) in ([], [".access.log.0.crc"])
