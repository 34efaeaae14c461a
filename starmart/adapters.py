"""The driver tables seen as the three inputs: order system, web logs, leads."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from datetime import datetime
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.synth import log_stamp
from starmart.schemas import MONEY, STAGED_LEADS
from starmart.sources.tables import SourceTables

CUIT_BASE = 30_000_000
# Item number = part * ITEM_BASE + supplier: distinct up to 400 million suppliers and 23 billion
# parts.
ITEM_BASE = 400_000_000
# Users are told apart by ip within blocks of this size, the hosts of network 10.
HOSTS = 1 << 24

# Agent templates of the log lines, by number.
AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/96.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 Version/15.1"
    " Safari/605.1.15",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:95.0) Gecko/20100101 Firefox/95.0",
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 Chrome/96.0 Safari/537.36",
    "Mozilla/5.0 (X11; CrOS x86_64 14268.67.0) AppleWebKit/537.36 Chrome/96.0 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 15_2 like Mac OS X) AppleWebKit/605.1.15 Mobile/15E148"
    " Safari/604.1",
    "Mozilla/5.0 (iPad; CPU OS 15_2 like Mac OS X) AppleWebKit/605.1.15 Mobile/15E148"
    " Safari/604.1",
    "Mozilla/5.0 (Linux; Android 12; Pixel 6) AppleWebKit/537.36 Chrome/96.0 Mobile"
    " Safari/537.36",
    "Mozilla/5.0 (Linux; Android 11; SM-T870) AppleWebKit/537.36 Chrome/96.0 Safari/537.36",
    "Mozilla/5.0 (Windows Phone 10.0; Android 6.0.1; Microsoft; Lumia 950) AppleWebKit/537.36"
    " Mobile Safari/537.36 Edge/15",
    "curl/7.79.1",
]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_system(spark: SparkSession, sf_dir: str, lines_last: bool = False) -> SourceTables:
    """The seven order tables.

    An item is a (part, supplier) pair that was ordered; small parts (size up to 16) also have a
    company list price, one below the supplier's.

    Pairs are gathered by part: they are made distinct and priced in one exchange, which both
    catalogs share. With ``lines_last`` an order meets its customer before its lines do, once
    instead of once a line; the rows are the same in another order.
    """
    item = (F.col("l_partkey") * ITEM_BASE + F.col("l_suppkey")).alias("suppliers_catalog_id")
    cuit = (F.lit(CUIT_BASE).cast("bigint") + F.col("c_nationkey")).alias("CUIT")
    lineitem = read(spark, sf_dir, "lineitem")
    part = read(spark, sf_dir, "part")
    customer = read(spark, sf_dir, "customer")
    price = F.col("p_retailprice").cast(MONEY).alias("price")
    pairs = lineitem.select("l_partkey", "l_suppkey")
    # Bare of NULLs here, or the catalogs' joins would filter them differently and share nothing.
    pairs = pairs.filter("l_partkey is not null and l_suppkey is not null")
    pairs = pairs.repartition("l_partkey").distinct()
    priced = pairs.join(part, F.col("l_partkey") == F.col("p_partkey"))
    placed, of_customer = read(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey")
    of_order = F.col("l_orderkey") == F.col("o_orderkey")
    if lines_last:
        lines = lineitem.join(placed.join(customer, of_customer), of_order)
    else:
        lines = lineitem.join(placed, of_order).join(customer, of_customer)
    orders = lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        cuit,
        F.col("o_custkey").alias("customer_id"),
        item,
    )
    return SourceTables(
        {
            "orders": orders,
            "companies": read(spark, sf_dir, "nation").select(
                (F.lit(CUIT_BASE).cast("bigint") + F.col("n_nationkey")).alias("CUIT"),
                F.col("n_name").alias("name"),
            ),
            "customers": as_customers(customer),
            "suppliers": read(spark, sf_dir, "supplier").select(
                F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name")
            ),
            "products": part.select(
                F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name")
            ),
            "suppliers_catalog": priced.select(
                item,
                F.col("l_suppkey").alias("supplier_id"),
                F.col("l_partkey").alias("product_id"),
                price,
            ),
            "companies_catalog": priced.filter(F.col("p_size") <= 16).select(
                item,
                F.lit(CUIT_BASE).cast("bigint").alias("CUIT"),
                (price - 1).cast(MONEY).alias("catalog_price"),
            ),
        }
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_customers(read(spark, sf_dir, "customer"))


def as_customers(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("customer_id"),
        (key * 7 + 10_000_000).alias("document_number"),
        F.col("c_name").alias("full_name"),
        F.date_add(F.lit("1960-01-01").cast("date"), (key % 15000).cast("int")).alias(
            "date_of_birth"
        ),
        F.concat(F.lit("user"), key.cast("string")).alias("username"),
    )


def renamed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products after those of type ECONOMY got a new name."""
    name = F.when(F.col("p_type") == "ECONOMY", F.concat("p_name", F.lit(" v2")))
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), name.otherwise(F.col("p_name")).alias("name")
    )


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lead per order. Machinery buyers name an unknown company; small orders no source."""
    return (
        read(spark, sf_dir, "orders")
        .join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderdate").alias("contact_date"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "UNKNOWN_CO")
            .otherwise(F.col("n_name"))
            .alias("company_name"),
            F.col("c_name").alias("contact_name"),
            F.when(F.col("o_totalprice") >= 10000, F.col("o_orderpriority")).alias("lead_source"),
            F.col("o_orderstatus").alias("status"),
        )
    )


def _host() -> Column:
    return F.col("user_id") % HOSTS


def ip_of_user() -> Column:
    octets = [F.shiftright(_host(), bits).bitwiseAND(F.lit(255)) for bits in (16, 8, 0)]
    return F.concat_ws(".", F.lit("10"), *[o.cast("string") for o in octets])


def weblog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event; cheap errors have no user, dear ones an unreadable date."""
    error = F.col("event_type") == "error"
    agents = F.array(*[F.lit(a) for a in AGENTS])
    return read(spark, sf_dir, "events").select(
        F.concat(
            ip_of_user(),
            F.lit(" - "),
            F.when(error & (F.col("value") < 5), "-").otherwise(
                F.concat(F.lit("user"), F.col("user_id").cast("string"))
            ),
            F.lit(" ["),
            F.when(error & (F.col("value") > 100), "99/Foo/2024:00:00:00").otherwise(
                log_stamp(F.col("ts"))
            ),
            F.lit(' -0700] "GET /'),
            F.col("event_type"),
            F.lit(' HTTP/1.1" 200 '),
            (F.col("event_id") % 1000).cast("string"),
            F.lit(' "https://shop.example/catalog" "'),
            F.element_at(agents, ((F.col("event_id") % len(AGENTS)) + 1).cast("int")),
            F.lit('"'),
        ).alias("value")
    )


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country per ip: the nation numbered like the host, which the ip determines."""
    users = read(spark, sf_dir, "events").select(
        ip_of_user().alias("ip"), (_host() % 25).cast("int").alias("_nation")
    )
    return (
        users.distinct()
        .join(read(spark, sf_dir, "nation"), F.col("_nation") == F.col("n_nationkey"))
        .select("ip", F.col("n_name").alias("country_name"))
    )


def agent_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a,) for a in AGENTS], "value string")


_SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
_BOOK = (
    '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    ' xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
    '<sheets><sheet name="Leads" sheetId="1" r:id="rId1"/></sheets></workbook>'
)
_LINKS = (
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>'
)


def workbook_bytes(table: pd.DataFrame) -> bytes:
    """A minimal .xlsx of one sheet: header row, dates as day numbers, other cells as text."""

    def cell(value) -> str:
        if value is None or value is pd.NaT or value != value:
            return "<c/>"
        if isinstance(value, datetime):
            return f"<c><v>{(value - datetime(1899, 12, 30)).total_seconds() / 86400!r}</v></c>"
        return f'<c t="inlineStr"><is><t>{escape(str(value))}</t></is></c>'

    lines = [list(table.columns), *table.itertuples(index=False)]
    sheet = _SHEET + "".join(f"<row>{''.join(map(cell, line))}</row>" for line in lines)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", _BOOK)
        book.writestr("xl/_rels/workbook.xml.rels", _LINKS)
        book.writestr("xl/worksheets/sheet1.xml", sheet + "</sheetData></worksheet>")
    return out.getvalue()


def lead_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leads as workbooks (``path``, ``content``), one per Arrow batch of rows."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, batch in enumerate(batches):
            first = f"{batch.iloc[0, 2]}-{number}"
            yield pd.DataFrame({"path": [f"{first}.xlsx"], "content": [workbook_bytes(batch)]})

    width = 4 * spark.sparkContext.defaultParallelism
    rows = leads(spark, sf_dir).select(*STAGED_LEADS.names).repartition(width)
    return rows.mapInPandas(
        pack,
        T.StructType(
            [T.StructField("path", T.StringType()), T.StructField("content", T.BinaryType())]
        ),
    )
