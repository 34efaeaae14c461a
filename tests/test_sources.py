"""Snapshot store, text, spreadsheets, JDBC options, source tables."""

import io
import zipfile
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.adapters import workbook_bytes
from starmart.schemas import SOURCE_SCHEMAS, STAGED_LEADS, empty_frame
from starmart.session import scratch_path
from starmart.sources import jdbc
from starmart.sources.spreadsheet import parse_workbooks, read_spreadsheets, sheet_rows
from starmart.sources.store import Warehouse
from starmart.sources.tables import SourceTables
from starmart.sources.text import read_lookup_list, read_weblogs, write_text


@pytest.fixture
def wh(spark):
    return Warehouse(spark, scratch_path(spark, "wh"))


def members(spark, *rows):
    return spark.createDataFrame(
        [(sk, name, None, None) for sk, name in rows],
        "sk_country bigint, country_name string, start_date timestamp_ntz,"
        " end_date timestamp_ntz",
    )


def names(df):
    return sorted(r["country_name"] for r in df.collect())


def sales(spark, *rows):
    return spark.createDataFrame(
        [(1, 1, 1, 1, price, day) for price, day in rows],
        "sk_company bigint, sk_customer bigint, sk_supplier bigint, sk_product bigint,"
        " price int, order_date string",
    ).withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


def test_a_missing_table_is_empty_with_its_schema(wh):
    df = wh.table("fact_logs")
    assert df.count() == 0
    assert df.columns == ["sk_ipaddr", "sk_country", "sk_device", "sk_customer", "time"]


def test_append_and_overwrite(spark, wh):
    wh.append("dim_country", members(spark, (1, "A")))
    wh.append("dim_country", members(spark, (2, "B")))
    assert names(wh.table("dim_country")) == ["A", "B"]
    wh.overwrite("dim_country", members(spark, (3, "C")))
    assert names(wh.table("dim_country")) == ["C"]


def test_a_table_can_be_rewritten_from_itself(spark, wh):
    wh.append("dim_country", members(spark, (1, "A"), (2, "B")))
    wh.overwrite("dim_country", wh.table("dim_country").filter("sk_country = 1"))
    assert names(wh.table("dim_country")) == ["A"]


def test_an_open_reader_keeps_its_snapshot(spark, wh):
    wh.append("dim_country", members(spark, (1, "A")))
    before = wh.table("dim_country")
    wh.overwrite("dim_country", members(spark, (2, "B")))
    assert names(before) == ["A"]


def test_expired_states_give_their_files_back(spark, wh):
    wh.expire("dim_country")
    wh.append("dim_country", members(spark, (1, "A")))
    wh.append("dim_country", members(spark, (2, "B")))
    wh.expire("dim_country")
    assert names(wh.table("dim_country")) == ["A", "B"]
    wh.overwrite("dim_country", members(spark, (3, "C")))
    before = wh.table("dim_country")
    wh.expire("dim_country", keep=2)
    assert len(wh._fs.listStatus(wh._path(f"{wh.root}/dim_country"))) == 4
    wh.expire("dim_country")
    assert len(wh._fs.listStatus(wh._path(f"{wh.root}/dim_country"))) == 2
    assert names(before) == ["C"]
    wh.append("dim_country", members(spark, (4, "D")))
    assert names(wh.table("dim_country")) == ["C", "D"]


def test_columns_are_matched_by_name(spark, wh):
    wh.append("dim_country", members(spark, (1, "A")).select(*reversed(
        ["sk_country", "country_name", "start_date", "end_date"]
    )))
    assert wh.table("dim_country").first()["country_name"] == "A"


def test_a_repeated_batch_adds_nothing(spark, wh):
    for _ in range(2):
        wh.append("dim_country", members(spark, (1, "A")), batch=("feed", 0))
    wh.append("dim_country", members(spark, (2, "B")), batch=("feed", 1))
    wh.append("dim_country", members(spark, (3, "C")), batch=("other", 0))
    assert names(wh.table("dim_country")) == ["A", "B", "C"]


def test_a_failed_load_leaves_the_table_alone(spark, wh):
    wh.append("dim_country", members(spark, (1, "A")))
    broken = members(spark, (2, "B")).withColumn(
        "country_name", F.raise_error(F.lit("broken row")).cast("string")
    )
    with pytest.raises(Exception, match="broken row"):
        wh.append("dim_country", broken)
    assert names(wh.table("dim_country")) == ["A"]


def test_a_second_writer_is_refused(spark, wh):
    wh.append("dim_country", members(spark, (1, "A")))
    stale = wh._state("dim_country")
    wh.append("dim_country", members(spark, (2, "B")))
    with pytest.raises(RuntimeError, match="another writer"):
        wh._publish("dim_country", {**stale, "version": stale["version"] + 1})
    assert names(wh.table("dim_country")) == ["A", "B"]


def test_months_are_slices(spark, wh):
    wh.append("fact_orders", sales(spark, (1, "2020-01-05"), (2, "2020-02-05"), (3, None)))
    wh.append("fact_orders", sales(spark, (4, "2020-02-07")))
    assert wh.slices("fact_orders")[:2] == ["order_month=2020-01", "order_month=2020-02"]
    february = {"order_month=2020-02"}
    assert sorted(int(r["price"]) for r in wh.table("fact_orders", february).collect()) == [2, 4]
    wh.replace_slices("fact_orders", sales(spark, (9, "2020-02-01")), february)
    assert sorted(int(r["price"]) for r in wh.table("fact_orders").collect()) == [1, 3, 9]
    wh.replace_slices("fact_orders", sales(spark), february)
    assert sorted(int(r["price"]) for r in wh.table("fact_orders").collect()) == [1, 3]


def closed_slices(wh):
    return set(wh.slices("dim_product")) - set(wh.open_slices("dim_product"))


def test_closed_history_is_not_rewritten(spark, wh):
    row = "sk_product bigint, product_id bigint, product_name string, start_date string,"
    row += " end_date string"

    def versions(*rows):
        df = spark.createDataFrame(list(rows), row)
        return df.withColumns(
            {c: F.col(c).cast("timestamp_ntz") for c in ("start_date", "end_date")}
        )

    closed, opened = (1, 1, "a", "2020-01-01", "2021-01-01"), (2, 1, "b", "2021-01-01", None)
    wh.merge_dimension("dim_product", versions(closed, opened))
    files = set(wh.table("dim_product", closed_slices(wh)).inputFiles())
    closing = (2, 1, "b", "2021-01-01", "2022-01-01")
    wh.merge_dimension("dim_product", versions(closing, (3, 1, "c", "2022-01-01", None)))
    assert files < set(wh.table("dim_product", closed_slices(wh)).inputFiles())
    assert sorted(r["sk_product"] for r in wh.table("dim_product").collect()) == [1, 2, 3]
    open_rows = wh.table("dim_product", wh.open_slices("dim_product")).collect()
    assert [r["sk_product"] for r in open_rows] == [3]


def test_text_and_lookup_list(spark, tmp_path):
    path = tmp_path / "countries.csv"
    path.write_text(
        "﻿Afghanistan\nÅland Islands\n\nBolivia, Plurinational State of\n", encoding="utf-8"
    )
    got = [r["value"] for r in read_lookup_list(spark, str(path)).collect()]
    assert got == ["Afghanistan", "Åland Islands", "Bolivia, Plurinational State of"]
    out = str(tmp_path / "logs")
    write_text(spark.createDataFrame([("one",), ("two",)], "log string"), out)
    write_text(spark.createDataFrame([("three",)], "log string"), out)
    assert [r["value"] for r in read_weblogs(spark, out, glob="*.txt").collect()] == ["three"]


LEADS = pd.DataFrame(
    {
        "contact_date": [datetime(2021, 5, 1, 13, 30), datetime(2021, 5, 2)],
        "company_name": ["A & B <co>", "Z"],
        "contact_name": ["Ann", None],
        "lead_source": [None, "web"],
        "status": ["open", "won"],
    }
)


def save_book(folder, name, table):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(workbook_bytes(table))


def test_workbooks_of_a_folder_tree(spark, tmp_path):
    save_book(tmp_path / "a", "one.xlsx", LEADS)
    # Column order and further columns do not matter.
    other = LEADS[["status", "lead_source", "contact_name", "company_name", "contact_date"]]
    save_book(tmp_path / "a" / "b", "two.xlsx", other.assign(note="x"))
    (tmp_path / "a" / "readme.txt").write_text("no workbook")
    rows = read_spreadsheets(spark, str(tmp_path), STAGED_LEADS).collect()
    assert len(rows) == 4
    assert {r["source_file"].rsplit("/", 1)[1] for r in rows} == {"one.xlsx", "two.xlsx"}
    want = [
        (datetime(2021, 5, 1, 13, 30), "A & B <co>", "Ann", None, "open"),
        (datetime(2021, 5, 2), "Z", None, "web", "won"),
    ]
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want * 2, key=str)
    last = read_spreadsheets(spark, str(tmp_path), STAGED_LEADS, files="last").collect()
    assert {r["source_file"].rsplit("/", 1)[1] for r in last} == {"one.xlsx"}


def test_a_missing_column_is_reported(spark, tmp_path):
    save_book(tmp_path, "x.xlsx", LEADS.drop(columns="status"))
    with pytest.raises(Exception, match="no column"):
        read_spreadsheets(spark, str(tmp_path), STAGED_LEADS).collect()


def test_shared_strings_gaps_and_types(spark):
    """The cell forms a spreadsheet program writes."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="S" r:id="rId3"/></sheets>'
            "</workbook>",
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships><Relationship Id="rId3" Target="/xl/worksheets/s.xml"/>'
            "</Relationships>",
        )
        book.writestr(
            "xl/sharedStrings.xml",
            f"<sst {ns}><si><t>name</t></si><si><r><t>rich </t></r><r><t>text</t></r></si></sst>",
        )
        book.writestr(
            "xl/worksheets/s.xml",
            f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="str">'
            '<v>n</v></c><c r="AA1" t="inlineStr"><is><t>far</t></is></c></row>'
            '<row><c r="A2" t="s"><v>1</v></c><c r="C2"><v>7</v></c></row><row/>'
            '<row><c r="C3"><v>2.5</v></c><c r="AA3" t="b"><v>1</v></c></row>'
            "</sheetData></worksheet>",
        )
    rows = list(sheet_rows(out.getvalue()))
    assert rows[0][0] == "name" and rows[0][1] is None and rows[0][26] == "far"
    assert rows[1] == ["rich text", None, 7.0]
    schema = T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("n", T.DoubleType())]
    )
    files = spark.createDataFrame(
        [("p.xlsx", bytearray(out.getvalue()))], "path string, content binary"
    )
    got = [tuple(r)[:2] for r in parse_workbooks(files, schema).collect()]
    assert got == [("rich text", 7.0), (None, 2.5)]


class Recorder:
    """Stands in for a DataFrame reader or writer and notes its options."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def mode(self, name):
        self.seen["mode"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **more):
        self.seen.update(more)
        return self

    def load(self):
        return self.seen

    def save(self):
        pass

    @property
    def read(self):
        return self

    write = read


def test_jdbc_options():
    """No database is started here; what reaches the JDBC source is checked."""
    cut = jdbc.Partitioning("customer_id", 1, 10_000, 32)
    seen = jdbc.read_jdbc_table(Recorder(), "jdbc:x:y", "customers", cut, {"user": "u"})
    assert seen["format"] == "jdbc" and seen["dbtable"] == "customers" and seen["user"] == "u"
    assert (seen["partitionColumn"], seen["lowerBound"], seen["upperBound"]) == (
        "customer_id",
        "1",
        "10000",
    )
    assert seen["numPartitions"] == 32
    assert "partitionColumn" not in jdbc.read_jdbc_table(Recorder(), "jdbc:x:y", "t")
    out = Recorder()
    jdbc.write_jdbc_table(out, "jdbc:x:y", "Logs", truncate=True, options={"password": "p"})
    assert out.seen["mode"] == "overwrite" and out.seen["batchsize"] == 5000
    assert out.seen["truncate"] == "true" and out.seen["password"] == "p"


def test_source_tables(spark, tmp_path):
    frames = {n: empty_frame(spark, s) for n, s in SOURCE_SCHEMAS.items()}
    src = SourceTables(frames)
    assert set(src) == set(SOURCE_SCHEMAS) and len(src) == 7
    with pytest.raises(KeyError, match="products"):
        SourceTables({n: f for n, f in frames.items() if n != "products"})
    with pytest.raises(ValueError, match="name"):
        src.replaced(products=frames["products"].drop("name"))
    for name, frame in src.items():
        frame.write.parquet(f"{tmp_path}/{name}")
    assert SourceTables.from_parquet(spark, str(tmp_path))["orders"].count() == 0
    assert SourceTables.load(lambda n: frames[n])["orders"].columns[0] == "order_id"
