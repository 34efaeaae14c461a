"""Workbooks written by the sink and read back by the scan."""

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.schemas import _struct
from starmart.sources.spreadsheet import read_spreadsheets
from starmart.sources.workbooks import write_spreadsheets

KINDS = _struct("day date, at timestamp_ntz, n bigint, price money, note string")


def books(folder):
    return sorted(
        os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names
    )


def test_every_kind_of_cell_comes_back(spark, tmp_path):
    rows = [
        (date(2021, 3, 1), datetime(2021, 3, 1, 23, 59, 59, 999000), 7, Decimal("1.10"), "a<b>&c"),
        (date(1890, 1, 1), datetime(1890, 1, 1, 6), -3, Decimal("-0.01"), " spaced\r\n\ttext "),
        (None, None, None, None, None),
        (date(9999, 12, 31), None, 2**40, None, "_x0041_ \x07 ü 漢 𝄞 _x"),
    ]
    target = str(tmp_path / "out")
    write_spreadsheets(spark.createDataFrame(rows, KINDS).repartition(2), target)
    got = read_spreadsheets(spark, target, KINDS).drop("source_file").collect()
    # a row without any value is not a row of a sheet
    assert sorted(map(tuple, got), key=str) == sorted((r for r in rows if any(r)), key=str)


def test_folders_and_rows_of_a_workbook(spark, tmp_path):
    target = str(tmp_path / "out")
    rows = spark.range(1000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 10 > 2, "hot/one").when(F.col("id") % 10 > 0, "two").alias("place"),
    )
    write_spreadsheets(rows, target, "place", book_rows=150)
    found = books(target)
    assert not [b for b in found if "draft" in b]
    assert {os.path.dirname(b) for b in found} == {"hot/one", "two", ""}
    back = read_spreadsheets(spark, target, _struct("n bigint"))
    assert back.groupBy("source_file").count().filter("count > 150").count() == 0
    assert back.filter("source_file like '%/hot/one/%'").filter("n % 10 <= 2").count() == 0
    assert sorted(r.n for r in back.collect()) == list(range(1000))
    write_spreadsheets(rows.limit(0), target, "place")
    assert books(target) == found


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    target = str(tmp_path / "out")
    bad = spark.range(100).select(
        F.expr("if(id = 99, raise_error('broken'), id)").cast("bigint").alias("n")
    )
    with pytest.raises(Exception, match="broken"):
        write_spreadsheets(bad, target)
    # a task that outlives the job may leave its draft, which no scan reads
    assert [b for b in books(target) if not b.startswith("_draft-")] == []
    assert read_spreadsheets(spark, target, _struct("n bigint")).count() == 0
    with pytest.raises(Exception, match="no folder"):
        write_spreadsheets(spark.sql("select 1 as n, '../up' as place"), target, "place")
    with pytest.raises(Exception, match="no cell can hold"):
        write_spreadsheets(spark.sql("select array(1) as n"), target)
    assert read_spreadsheets(spark, target, _struct("n bigint")).count() == 0
