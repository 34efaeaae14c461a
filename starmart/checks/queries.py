"""Every operator as a query over the driver tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import adapters as A
from starmart import schemas as S
from starmart.functions.literals import wall_clock
from starmart.functions.useragent import classify_user_agent
from starmart.functions.weblog import parse_weblogs, quarantine, readable
from starmart.operators.dimensions import add_members, fresh_rows, scd2_merge
from starmart.operators.extract import (
    extract_orders,
    extract_rejects,
    high_water,
    hot_order_keys,
    small_tables,
)
from starmart.operators.facts import (
    Balance,
    Lookup,
    balance,
    fact_rejects,
    load_fact,
    replace_period,
    same,
)
from starmart.operators.geo import assign_country, enrich_country
from starmart.operators.joins import hot_keys
from starmart.operators.keys import assign_keys
from starmart.operators.synth import synth_weblogs
from starmart.plans import pipelines as P
from starmart.plans import reports as R
from starmart.session import at_once, configure, scratch_path
from starmart.sources.spreadsheet import read_spreadsheets
from starmart.sources.store import Warehouse
from starmart.sources.text import read_lookup_list, read_weblogs, write_text
from starmart.sources.workbooks import write_spreadsheets
from starmart.streaming.inbox import ingest_weblogs

LOAD_1 = "2024-01-01 00:00:00"
LOAD_2 = "2024-02-01 00:00:00"
LOAD_3 = "2024-03-01 00:00:00"
# The initial load ends before this date.
CUTOVER = "1999-01-01 00:00:00"
PERIOD = ("2000-01-15 00:00:00", "2000-03-10 00:00:00")
REPORT_YEAR = 2000
DRIFT_MONTHS = ("1997-03", "1998-07", "2000-11")
MID_JANUARY = "2024-01-15 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; settings are applied before it runs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared steps -----------------------------------------------------------------------------


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Staging: written once to the shared folder, then read by column."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _order_system(spark, sf_dir):
    return A.order_system(spark, sf_dir, lines_last=True)


def _orders_once(src):
    """The source with its orders stored, as several extracts read them."""
    return src.replaced(orders=_stored(src["orders"], "orders"))


def _extracted(src, *args, **options) -> DataFrame:
    """Orders of the source with the names of its small tables broadcast."""
    return extract_orders(src, *args, small=small_tables(src), **options)


def _before_cutover(src):
    early = src["orders"].filter(F.col("order_date") < wall_clock(CUTOVER))
    return src.replaced(orders=early)


def _since_cutover(src):
    late = src["orders"].filter(F.col("order_date") >= wall_clock(CUTOVER))
    return src.replaced(orders=late)


def _empty(spark: SparkSession, dim: S.Dimension) -> DataFrame:
    return S.empty_frame(spark, dim.schema)


def _merged(dim: DataFrame, staged: DataFrame, d: S.Dimension, load_ts: str, **options):
    return scd2_merge(dim, staged, d.key, d.attrs, d.sk, load_ts, **options)


def _first_load(spark: SparkSession, staged: DataFrame, d: S.Dimension) -> DataFrame:
    return _merged(_empty(spark, d), staged, d, LOAD_1)


def _first_members(spark: SparkSession, staged: DataFrame, d: S.Dimension) -> DataFrame:
    return add_members(_empty(spark, d), staged, d.members, d.sk, LOAD_1, d.null_mode)


def _all_staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(_extracted(_order_system(spark, sf_dir)), "stg_orders")


def _order_dims(spark: SparkSession, staged: DataFrame) -> dict[str, DataFrame]:
    names = [d.name for d in S.ORDER_DIMENSIONS]
    loads = at_once(lambda d=d: _first_load(spark, staged, d) for d in S.ORDER_DIMENSIONS)
    return dict(zip(names, loads))


def _members_at_once(spark, staged: DataFrame, dims) -> dict[str, DataFrame]:
    loads = at_once(lambda d=d: _first_members(spark, staged, d) for d in dims)
    return dict(zip([d.name for d in dims], loads))


def _log_dims(spark: SparkSession, sf_dir: str, staged: DataFrame) -> dict[str, DataFrame]:
    dims = _members_at_once(spark, staged, S.LOG_DIMENSIONS)
    dims["dim_customer"] = _first_load(spark, A.customers(spark, sf_dir), S.CUSTOMER)
    return dims


def _lead_dims(spark: SparkSession, sf_dir: str, staged: DataFrame) -> dict[str, DataFrame]:
    dims = _members_at_once(spark, staged, S.LEAD_DIMENSIONS)
    companies = A.read(spark, sf_dir, "nation").select(
        (F.lit(A.CUIT_BASE).cast("bigint") + F.col("n_nationkey")).alias("CUIT"),
        F.col("n_name").alias("company_name"),
    )
    dims["dim_company"] = _first_load(spark, companies, S.COMPANY)
    return dims


def _staged_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = A.weblog_lines(spark, sf_dir)
    return P.stage_weblogs(lines, A.geo(spark, sf_dir))


def _country_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation names, written as a text file and read as a lookup list."""
    path = scratch_path(spark, "countries")
    write_text(A.read(spark, sf_dir, "nation").select("n_name"), path)
    return read_lookup_list(spark, path)


def _stored_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(_staged_logs(spark, sf_dir), "stg_logs")


def _order_facts(spark: SparkSession, sf_dir: str, company_on: str = "company_name"):
    staged = _all_staged_orders(spark, sf_dir)
    lookups = P.order_lookups(_order_dims(spark, staged), company_on)
    return load_fact(staged, lookups, P.ORDER_FACT_COLUMNS, balance(staged, lookups))


def _log_facts(spark: SparkSession, staged: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    lookups = P.log_lookups(dims)
    return load_fact(staged, lookups, P.LOG_FACT_COLUMNS, balance(staged, lookups))


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price and date of every order line: all a sales report needs of the fact."""
    return _extracted(_order_system(spark, sf_dir)).select(
        F.col("order_price").alias("price"), "order_date"
    )


# --- extraction -------------------------------------------------------------------------------


@query
def extract_orders_full(spark, sf_dir):
    return _extracted(_order_system(spark, sf_dir))


@query
def extract_orders_incremental(spark, sf_dir):
    src = _order_system(spark, sf_dir)
    loaded = _before_cutover(src)["orders"].select("order_date")
    return _extracted(src, high_water(loaded))


@query
def extract_orders_lookback(spark, sf_dir):
    src = _order_system(spark, sf_dir)
    loaded = _before_cutover(src)["orders"].select("order_date")
    return _extracted(src, high_water(loaded, lookback=timedelta(days=30)))


@query
def extract_orders_range(spark, sf_dir):
    return _extracted(_order_system(spark, sf_dir), start=PERIOD[0], end=PERIOD[1])


@query
def extract_orders_match_company(spark, sf_dir):
    return _extracted(_order_system(spark, sf_dir), match_company=True)


@query
def extract_orders_spread(spark, sf_dir):
    """The full extract with the hot keys of the orders spread over slices."""
    src = _order_system(spark, sf_dir)
    src = src.replaced(orders=_stored(src["orders"], "orders"))
    return _extracted(src, hot=hot_order_keys(src))


@query
def extract_orders_rejects(spark, sf_dir):
    """Orders whose rows some table of the order system lacks."""
    src = _order_system(spark, sf_dir)
    lacking = {
        "companies": F.col("CUIT") % 5 != 0,
        "customers": F.col("customer_id") % 7 != 0,
        "suppliers_catalog": F.col("suppliers_catalog_id") % 11 != 0,
        "suppliers": F.col("supplier_id") % 3 != 0,
        "products": F.col("product_id") % 4 != 0,
    }
    return extract_rejects(src.replaced(**{n: src[n].filter(c) for n, c in lacking.items()}))


# --- dimensions -------------------------------------------------------------------------------


@query
def assign_customer_keys(spark, sf_dir):
    rows = A.read(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey")
    return assign_keys(rows, "sk", ["c_mktsegment", "c_custkey"], start=101)


@query
def scd2_company_initial(spark, sf_dir):
    staged = _extracted(_order_system(spark, sf_dir))
    return _first_load(spark, staged, S.COMPANY)


@query
def scd2_customer_initial(spark, sf_dir):
    staged = _extracted(_order_system(spark, sf_dir))
    return _first_load(spark, staged, S.CUSTOMER)


@query
def scd2_supplier_initial(spark, sf_dir):
    staged = _extracted(_order_system(spark, sf_dir))
    return _first_load(spark, staged, S.SUPPLIER)


@query
def scd2_product_initial(spark, sf_dir):
    staged = _extracted(_order_system(spark, sf_dir))
    return _first_load(spark, staged, S.PRODUCT)


def _product_changed(spark, sf_dir, src):
    dim = _first_load(spark, _extracted(_before_cutover(src)), S.PRODUCT)
    renamed = src.replaced(products=A.renamed_products(spark, sf_dir))
    return _merged(dim, _extracted(_since_cutover(renamed)), S.PRODUCT, LOAD_2)


@query
def scd2_product_changed(spark, sf_dir):
    return _product_changed(spark, sf_dir, _orders_once(_order_system(spark, sf_dir)))


def _product_reverted(spark, sf_dir, compare):
    src = _orders_once(_order_system(spark, sf_dir))
    dim = _product_changed(spark, sf_dir, src)
    staged = _extracted(_since_cutover(src))
    return _merged(dim, staged, S.PRODUCT, LOAD_3, compare=compare)


@query
def scd2_product_reverted(spark, sf_dir):
    return _product_reverted(spark, sf_dir, "history")


@query
def scd2_product_reverted_current(spark, sf_dir):
    return _product_reverted(spark, sf_dir, "current")


def _keyless(products: DataFrame) -> DataFrame:
    """Products as staged rows; those of type PROMO come without a key."""
    return products.select(
        F.when(F.col("p_type") != "PROMO", F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
    )


@query
def scd2_null_key(spark, sf_dir):
    part = A.read(spark, sf_dir, "part")
    dim = _first_load(spark, _keyless(part), S.PRODUCT)
    again = part.withColumn("p_name", F.concat("p_name", F.lit(" v2")))
    return _merged(dim, _keyless(again), S.PRODUCT, LOAD_2)


def _two_names(spark, sf_dir):
    """Every line of an order with its product, whose name changed at the cutover."""
    staged = _extracted(_order_system(spark, sf_dir))
    late = F.col("order_date") >= wall_clock(CUTOVER)
    name = F.when(late, F.concat("product_name", F.lit(" v2"))).otherwise(F.col("product_name"))
    return staged.select("product_id", name.alias("product_name"), "order_date")


@query
def scd2_two_variants(spark, sf_dir):
    return _first_load(spark, _two_names(spark, sf_dir), S.PRODUCT)


@query
def scd2_latest_variant(spark, sf_dir):
    staged = _two_names(spark, sf_dir)
    return _merged(_empty(spark, S.PRODUCT), staged, S.PRODUCT, LOAD_1, variants="latest")


def _members_second_load(spark, sf_dir, d, **options):
    """Members of the first half of January, then of all log rows."""
    staged = _stored_logs(spark, sf_dir)
    first = staged.filter(F.col("time") < wall_clock(MID_JANUARY))
    dim = _first_members(spark, first, d)
    return add_members(dim, staged, d.members, d.sk, LOAD_2, d.null_mode, **options)


@query
def members_ipaddr(spark, sf_dir):
    return _members_second_load(spark, sf_dir, S.IPADDR)


@query
def members_ipaddr_repeats(spark, sf_dir):
    """One member per log row whose ip is new, repeats included."""
    staged = _stored_logs(spark, sf_dir)
    dim = _empty(spark, S.IPADDR)
    return add_members(dim, staged, ["ipaddr"], "sk_ipaddr", LOAD_1, "antijoin", distinct=False)


@query
def members_country(spark, sf_dir):
    return _members_second_load(spark, sf_dir, S.COUNTRY)


@query
def members_device(spark, sf_dir):
    return _members_second_load(spark, sf_dir, S.DEVICE)


@query
def members_contact(spark, sf_dir):
    return _first_members(spark, A.leads(spark, sf_dir), S.CONTACT)


@query
def members_status(spark, sf_dir):
    return _first_members(spark, A.leads(spark, sf_dir), S.STATUS)


def _sources_on_top_of(spark, sf_dir, known: Column, null_mode: str) -> DataFrame:
    staged = A.leads(spark, sf_dir)
    dim = add_members(
        _empty(spark, S.LEADSOURCE),
        staged.filter(known),
        ["lead_source"],
        "sk_leadsource",
        LOAD_1,
        "except",
    )
    return add_members(dim, staged, ["lead_source"], "sk_leadsource", LOAD_2, null_mode)


@query
def members_leadsource(spark, sf_dir):
    return _sources_on_top_of(spark, sf_dir, F.col("lead_source") < "3", "not_in")


@query
def members_leadsource_except(spark, sf_dir):
    return _sources_on_top_of(spark, sf_dir, F.col("lead_source") < "3", "except")


@query
def members_leadsource_antijoin(spark, sf_dir):
    return _sources_on_top_of(spark, sf_dir, F.col("lead_source").isNull(), "antijoin")


@query
def members_not_in_null_dim(spark, sf_dir):
    known = F.col("lead_source").isNull() | (F.col("lead_source") < "3")
    return _sources_on_top_of(spark, sf_dir, known, "not_in")


@query
def members_not_in_empty_dim(spark, sf_dir):
    return _first_members(spark, A.leads(spark, sf_dir), S.LEADSOURCE)


@query
def fresh_lead_copies(spark, sf_dir):
    """How often each new source was staged."""
    staged = A.leads(spark, sf_dir)
    known = staged.filter(F.col("status") == "F").select("lead_source").filter(
        F.col("lead_source") < "3"
    )
    return fresh_rows(staged, known, ["lead_source"], "except").select(
        "lead_source", F.col("_n").alias("copies")
    )


# --- facts ------------------------------------------------------------------------------------


@query
def fact_orders(spark, sf_dir):
    return _order_facts(spark, sf_dir)


@query
def fact_orders_spread(spark, sf_dir):
    """Staged keys of other numeric types than the dimensions', the hot ones spread."""
    staged = _all_staged_orders(spark, sf_dir)
    dims = _order_dims(spark, staged)
    kinds = {"supplier_id": "int", "product_id": "decimal(20,2)", "customer_id": "int"}
    staged = staged.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})
    lookups = P.order_lookups(dims)
    hot = hot_keys(staged, [lk.staged_cols for lk in lookups], share=0.002)
    return load_fact(staged, lookups, P.ORDER_FACT_COLUMNS, Balance(hot=hot))


def _lacking(dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Dimensions without some suppliers and products."""
    suppliers = dims["dim_supplier"].filter("supplier_id % 10 <> 3")
    products = dims["dim_product"].filter("product_id % 9 <> 4")
    return {**dims, "dim_supplier": suppliers, "dim_product": products}


@query
def fact_orders_rejects(spark, sf_dir):
    staged = _all_staged_orders(spark, sf_dir)
    lookups = P.order_lookups(_lacking(_order_dims(spark, staged)))
    return fact_rejects(staged, lookups, balance(staged, lookups))


@query
def fact_orders_on_cuit(spark, sf_dir):
    return _order_facts(spark, sf_dir, "CUIT")


def _product_versions(spark, sf_dir, staged) -> DataFrame:
    """Products as staged since 1950, the renamed ones since the cutover."""
    products = staged.select("product_id", "product_name")
    dim = _merged(_empty(spark, S.PRODUCT), products, S.PRODUCT, "1950-01-01 00:00:00")
    renamed = A.renamed_products(spark, sf_dir).withColumnRenamed("name", "product_name")
    return _merged(dim, renamed, S.PRODUCT, CUTOVER)


@query
def fact_orders_as_of(spark, sf_dir):
    """Product versions valid on the order date: renamed products at the cutover."""
    staged = _all_staged_orders(spark, sf_dir)
    dim = _product_versions(spark, sf_dir, staged)
    lookup = Lookup(dim, "sk_product", same("product_id"), as_of="order_date")
    return load_fact(staged, [lookup], ["sk_product", "order_price as price", "order_date"])


@query
def fact_orders_as_of_spread(spark, sf_dir):
    """The same by merge with the most ordered products spread over slices."""
    staged = _all_staged_orders(spark, sf_dir)
    hot = hot_keys(staged, [["product_id"]], share=0.0005)
    lookup = Lookup(_product_versions(spark, sf_dir, staged), "sk_product", same("product_id"), "order_date")
    columns = ["sk_product", "order_price as price", "order_date"]
    return load_fact(staged, [lookup], columns, Balance(hot=hot))


@query
def fact_orders_as_of_rejects(spark, sf_dir):
    """Orders of a time when their product had no version yet, or its company no longer one."""
    staged = _all_staged_orders(spark, sf_dir)
    products = staged.select("product_id", "product_name").filter("product_id % 3 = 0")
    dim = _merged(_empty(spark, S.PRODUCT), products, S.PRODUCT, CUTOVER)
    firms = _first_load(spark, staged, S.COMPANY).select(
        "sk_company", "CUIT", "company_name",
        wall_clock("1950-01-01 00:00:00").alias("start_date"),
        F.when(F.col("CUIT") % 2 == 0, wall_clock(PERIOD[0])).alias("end_date"),
    )
    lookups = [
        Lookup(firms, "sk_company", same("company_name"), "order_date"),
        Lookup(dim, "sk_product", same("product_id"), "order_date"),
    ]
    return fact_rejects(staged, lookups, balance(staged, lookups))


@query
def fact_logs(spark, sf_dir):
    staged = _stored_logs(spark, sf_dir)
    return _log_facts(spark, staged, _log_dims(spark, sf_dir, staged))


@query
def fact_logs_rejects(spark, sf_dir):
    staged = _stored_logs(spark, sf_dir)
    lookups = P.log_lookups(_log_dims(spark, sf_dir, staged))
    return fact_rejects(staged, lookups, balance(staged, lookups))


@query
def fact_leads(spark, sf_dir):
    staged = _stored(A.leads(spark, sf_dir), "stg_leads")
    lookups = P.lead_lookups(_lead_dims(spark, sf_dir, staged))
    return load_fact(staged, lookups, P.LEAD_FACT_COLUMNS, balance(staged, lookups))


@query
def fact_leads_ignoring_case(spark, sf_dir):
    """Staged names in lower case, dimension members as they were written."""
    leads = A.leads(spark, sf_dir)
    dims = _lead_dims(spark, sf_dir, leads)
    names = ["company_name", "contact_name", "lead_source", "status"]
    lower = leads.withColumns({c: F.lower(c) for c in names})
    lookups = P.lead_lookups(dims, collation="UTF8_LCASE")
    return load_fact(lower, lookups, P.LEAD_FACT_COLUMNS)


@query
def fact_leads_many_cases(spark, sf_dir):
    """Members in two cases, looked up ignoring case: one fact per lead all the same."""
    leads = A.leads(spark, sf_dir)
    names = ["company_name", "contact_name", "lead_source", "status"]
    lower = leads.withColumns({c: F.lower(c) for c in names})
    dims = _lead_dims(spark, sf_dir, leads.unionByName(lower))
    rows = load_fact(leads, P.lead_lookups(dims, "UTF8_LCASE"), P.LEAD_FACT_COLUMNS)
    return rows.groupBy("contact_date").agg(F.count("*").alias("n"))


@query
def fact_leads_rejects(spark, sf_dir):
    staged = _stored(A.leads(spark, sf_dir), "stg_leads")
    lookups = P.lead_lookups(_lead_dims(spark, sf_dir, staged))
    return fact_rejects(staged, lookups, balance(staged, lookups))


@query
def reprocess_orders_period(spark, sf_dir):
    """The fact of all orders, the period loaded again with company-matched prices."""
    src = _orders_once(_order_system(spark, sf_dir))
    staged = _stored(_extracted(src), "stg_orders")
    lookups = P.order_lookups(_order_dims(spark, staged))
    how = balance(staged, lookups)
    fact = load_fact(staged, lookups, P.ORDER_FACT_COLUMNS, how)
    again = _extracted(src, start=PERIOD[0], end=PERIOD[1], match_company=True)
    reloaded = load_fact(again, lookups, P.ORDER_FACT_COLUMNS, how)
    return replace_period(fact, reloaded, "order_date", *PERIOD)


# --- web logs ---------------------------------------------------------------------------------


@query
def weblog_lines(spark, sf_dir):
    return A.weblog_lines(spark, sf_dir)


@query
def parse_weblogs_wall(spark, sf_dir):
    return parse_weblogs(A.weblog_lines(spark, sf_dir))


@query
def parse_weblogs_utc(spark, sf_dir):
    parsed = parse_weblogs(A.weblog_lines(spark, sf_dir), tz="utc")
    return readable(parsed).select("ipaddr", "username", "time", "request")


@query
def parse_weblogs_quarantine(spark, sf_dir):
    return quarantine(parse_weblogs(A.weblog_lines(spark, sf_dir)))


@query
def parse_weblogs_sentinel(spark, sf_dir):
    parsed = parse_weblogs(A.weblog_lines(spark, sf_dir))
    return readable(parsed, keep_unparsable=True).select("ipaddr", "username", "time")


@query
def classify_user_agents(spark, sf_dir):
    parsed = parse_weblogs(A.weblog_lines(spark, sf_dir)).select("useragent")
    return classify_user_agent(parsed)


@query
def enrich_country_of_ip(spark, sf_dir):
    parsed = parse_weblogs(A.weblog_lines(spark, sf_dir)).select("ipaddr", "username", "time")
    return enrich_country(parsed, A.geo(spark, sf_dir))


@query
def assign_country_of_ip(spark, sf_dir):
    """A made-up country for each log row."""
    parsed = parse_weblogs(A.weblog_lines(spark, sf_dir)).select("ipaddr", "time")
    return assign_country(parsed, _country_list(spark, sf_dir), seed=7)


@query
def stage_weblogs_assigned(spark, sf_dir):
    lines = A.weblog_lines(spark, sf_dir)
    return P.stage_weblogs(lines, countries=_country_list(spark, sf_dir))


@query
def stage_weblogs(spark, sf_dir):
    return _staged_logs(spark, sf_dir)


@query
def stage_weblogs_repeated_geo(spark, sf_dir):
    """Two countries for every ip; the first by name is taken."""
    geo = A.geo(spark, sf_dir)
    again = geo.select("ip", F.concat("country_name", F.lit(" too")).alias("country_name"))
    return P.stage_weblogs(A.weblog_lines(spark, sf_dir), geo.unionByName(again))


@query
def text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "lines")
    write_text(A.weblog_lines(spark, sf_dir), path)
    return read_weblogs(spark, path)


@query
def synth_weblog_lines(spark, sf_dir):
    """One generated line per customer and event row, drawn from all customers."""
    n = A.read(spark, sf_dir, "events").count()
    return synth_weblogs(spark, A.customers(spark, sf_dir), A.agent_list(spark), n, seed=11)


@query
def spreadsheet_ingest(spark, sf_dir):
    """The leads, written as workbooks into a folder a month and read back by a scan of the tree."""
    tree = scratch_path(spark, "workbooks")
    rows = A.leads(spark, sf_dir).select(*S.STAGED_LEADS.names)
    month = F.date_format("contact_date", "yyyy/MM")
    write_spreadsheets(rows.withColumn("month", month), tree, "month", book_rows=20_000)
    read = read_spreadsheets(spark, tree, S.STAGED_LEADS)
    folder = F.regexp_extract("source_file", r"/(\d{4}/\d{2})/[^/]+\.xlsx$", 1)
    return read.select(*S.STAGED_LEADS.names, folder.alias("folder"))


# --- reports ----------------------------------------------------------------------------------


@query
def sales_by_month(spark, sf_dir):
    return R.sales_by_month(_sales(spark, sf_dir), REPORT_YEAR)


@query
def sales_by_month_window(spark, sf_dir):
    return R.sales_by_month_window(_sales(spark, sf_dir), REPORT_YEAR)


@query
def top_devices(spark, sf_dir):
    staged = _stored_logs(spark, sf_dir)
    dims = _log_dims(spark, sf_dir, staged)
    return R.top_devices(_log_facts(spark, staged, dims), dims["dim_device"])


def _orders_and_logs(spark, sf_dir):
    orders = _all_staged_orders(spark, sf_dir)
    order_dims = _order_dims(spark, orders)
    lookups = P.order_lookups(order_dims)
    sold = load_fact(orders, lookups, P.ORDER_FACT_COLUMNS, balance(orders, lookups))
    logs = _stored_logs(spark, sf_dir)
    log_dims = _members_at_once(spark, logs, S.LOG_DIMENSIONS)
    log_dims["dim_customer"] = order_dims["dim_customer"]
    seen = _stored(_log_facts(spark, logs, log_dims), "fact_logs")
    return sold, seen, {**order_dims, **log_dims}


@query
def top_products_of_top_country(spark, sf_dir):
    sold, seen, dims = _orders_and_logs(spark, sf_dir)
    return R.top_products_of_top_country(sold, seen, dims["dim_product"], dims["dim_country"])


@query
def top_products_by_customer(spark, sf_dir):
    """The same, orders and logs joined on the customer instead of its version."""
    sold, seen, dims = _orders_and_logs(spark, sf_dir)
    return R.top_products_of_top_country(
        sold,
        seen,
        dims["dim_product"],
        dims["dim_country"],
        dim_customer=dims["dim_customer"],
    )


# --- pipelines on the snapshot store ----------------------------------------------------------


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def _loaded_orders(spark, sf_dir) -> Warehouse:
    """Initial load, then the rest with renamed products."""
    wh = _warehouse(spark)
    src = _orders_once(_order_system(spark, sf_dir))
    P.run_orders(wh, _before_cutover(src), LOAD_1)
    renamed = src.replaced(products=A.renamed_products(spark, sf_dir))
    P.run_orders(wh, renamed, LOAD_2, find_hot=True)
    return wh


@query
def pipeline_orders(spark, sf_dir):
    return _loaded_orders(spark, sf_dir).table("fact_orders")


@query
def pipeline_orders_lookback(spark, sf_dir):
    """Loaded without the late rows of the last days, then again with a look-back."""
    wh = _warehouse(spark)
    src = _orders_once(_order_system(spark, sf_dir))
    early = _before_cutover(src)
    late = (F.col("order_date") > wall_clock("1998-12-12 00:00:00")) & (F.col("order_id") % 20 == 1)
    P.run_orders(wh, early.replaced(orders=early["orders"].filter(~late)), LOAD_1)
    P.run_orders(wh, src, LOAD_2, lookback=timedelta(days=30))
    P.run_orders(wh, src, LOAD_3, lookback=timedelta(days=30))
    return wh.table("fact_orders").groupBy(
        F.date_format("order_date", "yyyy-MM").alias("month")
    ).agg(F.count("*").alias("n"), F.sum("price").cast("decimal(28,2)").alias("amount"))


def _drifted(src):
    """The orders as they once were: some still to come, some dated otherwise, some since gone."""
    orders, month = src["orders"], F.date_format("order_date", "yyyy-MM")
    some = F.col("order_id") % 3 == 0
    late, moved, gone = (some & (month == m) for m in DRIFT_MONTHS)
    moment = F.when(moved, F.expr("order_date + interval 1 hour")).otherwise(F.col("order_date"))
    once = orders.filter(~late).withColumn("order_date", moment)
    extra = orders.filter(gone).withColumn("order_id", -F.col("order_id"))
    return src.replaced(orders=once.unionByName(extra))


@query
def pipeline_reconcile(spark, sf_dir):
    """Months whose orders came late, changed or went: found by their sums and loaded again."""
    wh = _warehouse(spark)
    src = _orders_once(_order_system(spark, sf_dir))
    P.run_orders(wh, _drifted(src), LOAD_1)
    found = _stored(P.months_to_reload(wh, src), "months")
    P.reconcile_orders(wh, src, LOAD_2)
    loaded = wh.table("fact_orders").groupBy(
        F.date_format("order_date", "yyyy-MM").alias("month")
    )
    totals = loaded.agg(
        F.count("*").alias("n"),
        F.count_if(F.hour("order_date") != 0).alias("n_moved"),
        F.sum("price").cast("decimal(28,2)").alias("amount"),
    )
    still = P.months_to_reload(wh, src).select("month", F.lit(True).alias("_still"))
    return (
        totals.join(found, "month", "left")
        .join(still, "month", "left")
        .select("*", F.coalesce("_still", F.lit(False)).alias("differs"))
        .drop("_still")
    )


@query
def pipeline_orders_rejects(spark, sf_dir):
    wh = _warehouse(spark)
    P.run_orders(wh, _order_system(spark, sf_dir), LOAD_1)
    names = ("dim_supplier", "dim_product")
    for name, dim in _lacking({n: wh.table(n) for n in names}).items():
        wh.overwrite(name, dim)
    return P.order_rejects(wh)


@query
def pipeline_orders_dim(spark, sf_dir):
    return _loaded_orders(spark, sf_dir).table("dim_product")


@query
def pipeline_orders_as_of(spark, sf_dir):
    """Two loads; orders find the versions of their own date, the newer ones those of the cutover."""
    wh = _warehouse(spark)
    src = _orders_once(_order_system(spark, sf_dir))
    P.run_orders(wh, _before_cutover(src), "1950-01-01 00:00:00", as_of="order_date")
    renamed = src.replaced(products=A.renamed_products(spark, sf_dir))
    P.run_orders(wh, renamed, CUTOVER, as_of="order_date")
    return wh.table("fact_orders")


@query
def dimension_small_batch(spark, sf_dir):
    """A few products renamed and a few new ones: only the slices of their keys are written."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), key_slots=64)
    part = A.read(spark, sf_dir, "part")
    products = part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )
    P.merge_versions(wh, S.PRODUCT, products.filter("product_id % 5 <> 3"), LOAD_1)
    renamed = products.filter("product_id % 150 = 8").withColumn(
        "product_name", F.concat("product_name", F.lit(" v2"))
    )
    P.merge_versions(wh, S.PRODUCT, renamed, LOAD_2)
    P.merge_versions(wh, S.PRODUCT, renamed, LOAD_3)
    return wh.table("dim_product")


@query
def members_by_slice_ipaddr(spark, sf_dir):
    """Members added to a stored dimension, of which only the staged values' slices are read."""
    wh = _warehouse(spark)
    staged = _stored_logs(spark, sf_dir)
    P.load_members(wh, S.IPADDR, staged.filter(F.col("time") < wall_clock(MID_JANUARY)), LOAD_1)
    P.load_members(wh, S.IPADDR, staged, LOAD_2)
    return wh.table("dim_ipaddr")


def _sources_by_slice(spark, sf_dir, known: Column) -> DataFrame:
    wh = _warehouse(spark)
    staged = A.leads(spark, sf_dir)
    first = add_members(
        _empty(spark, S.LEADSOURCE), staged.filter(known), ["lead_source"], "sk_leadsource",
        LOAD_1, "except",
    )
    wh.append("dim_leadsource", first)
    P.load_members(wh, S.LEADSOURCE, staged, LOAD_2)
    return wh.table("dim_leadsource")


@query
def members_by_slice_leadsource(spark, sf_dir):
    return _sources_by_slice(spark, sf_dir, F.col("lead_source") < "3")


@query
def members_by_slice_null_dim(spark, sf_dir):
    known = F.col("lead_source").isNull() | (F.col("lead_source") < "3")
    return _sources_by_slice(spark, sf_dir, known)


@query
def pipeline_reprocess(spark, sf_dir):
    wh = _warehouse(spark)
    src = _orders_once(_order_system(spark, sf_dir))
    P.run_orders(wh, src, LOAD_1)
    P.reprocess_orders(wh, src, *PERIOD, LOAD_2, match_company=True, find_hot=True)
    return wh.table("fact_orders")


def _with_customers_and_companies(spark, sf_dir) -> Warehouse:
    wh = _warehouse(spark)
    staged = _stored(_extracted(_order_system(spark, sf_dir)), "stg_orders")
    at_once(
        lambda d=d: wh.overwrite(d.name, _first_load(spark, staged, d)) for d in (S.CUSTOMER, S.COMPANY)
    )
    return wh


@query
def pipeline_logs(spark, sf_dir):
    wh = _with_customers_and_companies(spark, sf_dir)
    P.run_logs(wh, A.weblog_lines(spark, sf_dir), A.geo(spark, sf_dir), LOAD_1)
    return wh.table("fact_logs")


@query
def pipeline_logs_quarantine(spark, sf_dir):
    wh = _with_customers_and_companies(spark, sf_dir)
    P.run_logs(wh, A.weblog_lines(spark, sf_dir), A.geo(spark, sf_dir), LOAD_1)
    return P.quarantined_lines(wh)


@query
def pipeline_logs_rejects(spark, sf_dir):
    wh = _with_customers_and_companies(spark, sf_dir)
    P.run_logs(wh, A.weblog_lines(spark, sf_dir), A.geo(spark, sf_dir), LOAD_1)
    return P.log_rejects(wh)


@query
def pipeline_leads(spark, sf_dir):
    wh = _with_customers_and_companies(spark, sf_dir)
    P.run_leads(wh, A.leads(spark, sf_dir), LOAD_1)
    return wh.table("fact_leads")


@query
def pipeline_leads_rejects(spark, sf_dir):
    wh = _with_customers_and_companies(spark, sf_dir)
    P.run_leads(wh, A.leads(spark, sf_dir), LOAD_1)
    return P.lead_rejects(wh)


@query
def inbox_ingest(spark, sf_dir):
    """Log files dropped into an inbox and loaded by the file stream."""
    wh = _with_customers_and_companies(spark, sf_dir)
    inbox = scratch_path(spark, "inbox")
    write_text(A.weblog_lines(spark, sf_dir), inbox)
    ingest_weblogs(wh, inbox, scratch_path(spark, "stream"), A.geo(spark, sf_dir), LOAD_1)
    return wh.table("fact_logs")


@query
def inbox_ingest_batches(spark, sf_dir):
    """Several log files, one a batch, with archive: facts, rejects and unreadable lines of all."""
    wh = _with_customers_and_companies(spark, sf_dir)
    inbox = scratch_path(spark, "inbox")
    write_text(A.weblog_lines(spark, sf_dir).repartition(3), inbox)
    state, archive = scratch_path(spark, "stream"), scratch_path(spark, "archive")
    geo = _stored(A.geo(spark, sf_dir), "geo")
    ingest_weblogs(wh, inbox, state, geo, LOAD_1, files_per_batch=1, archive=archive)
    day = F.col("time").cast("date").cast("string").alias("day")
    rejects = P.log_rejects(wh)
    kinds = [
        wh.table("fact_logs").select(F.lit("fact").alias("kind"), day),
        rejects.select(F.concat(F.lit("reject "), "missing").alias("kind"), day),
        P.quarantined_lines(wh).select(F.lit("unreadable").alias("kind"), F.col("value").alias("day")),
    ]
    rows = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    return rows.groupBy("kind", "day").agg(F.count("*").alias("n"))


@query
def inbox_same_name(spark, sf_dir):
    """Log files dropped again under the names of archived ones: both loads count."""
    inbox, drops = scratch_path(spark, "inbox"), scratch_path(spark, "drops")
    state, archive = scratch_path(spark, "state"), scratch_path(spark, "archive")
    # Lines and countries are made once, beside the orders; both loads read the countries.
    wh, geo, _ = at_once(
        [
            lambda: _with_customers_and_companies(spark, sf_dir),
            lambda: _stored(A.geo(spark, sf_dir), "geo"),
            lambda: _write_apart(A.weblog_lines(spark, sf_dir), "Windows", drops),
        ]
    )
    _drop_as(spark, f"{drops}/found=true", inbox, "access.log")
    ingest_weblogs(wh, inbox, state, geo, LOAD_1, archive=archive)
    _drop_as(spark, f"{drops}/found=false", inbox, "access.log")
    ingest_weblogs(wh, inbox, state, geo, LOAD_2, archive=archive)
    ingest_weblogs(wh, inbox, state, geo, LOAD_2, archive=archive)
    found = wh.table("fact_logs").join(wh.table("dim_ipaddr"), "sk_ipaddr")
    found = found.join(wh.table("dim_country"), "sk_country")
    return found.groupBy("ipaddr", "country_name").agg(F.count("*").alias("n"))


def _write_apart(lines: DataFrame, mark: str, path: str) -> None:
    """Text files of the lines with ``mark`` (``found=true``) and of those without, in one pass."""
    found = F.col("value").contains(mark).alias("found")
    lines.select("value", found).write.partitionBy("found").text(path)


def _drop_as(spark, written: str, inbox: str, name: str) -> None:
    """Move the files of a text folder into the inbox, numbered behind a name.

    They get the time of the drop: files written at once would else differ by their lengths alone.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(written).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(inbox))
    files = [f.getPath() for f in fs.listStatus(path(written))] if fs.exists(path(written)) else []
    parts = sorted(f.toString() for f in files if f.getName().startswith("part-"))
    now = int(time.time() * 1000)
    for i, part in enumerate(parts):
        there = path(f"{inbox}/{name}.{i}")
        fs.rename(path(part), there)
        fs.setTimes(there, now, -1)


@query
def report_views(spark, sf_dir):
    """The report views, registered before most loads and read by name after all, and `expire`."""
    wh = _warehouse(spark)
    src = _orders_once(_order_system(spark, sf_dir))
    P.run_orders(wh, _before_cutover(src), LOAD_1)
    R.register_reports(spark, wh, REPORT_YEAR)
    P.run_orders(wh, src.replaced(products=A.renamed_products(spark, sf_dir)), LOAD_2)
    P.run_logs(wh, A.weblog_lines(spark, sf_dir), A.geo(spark, sf_dir), LOAD_2)
    for table in S.TABLES:
        wh.expire(table)
    return spark.sql(
        f"""
        select 'sales' as report, cast(month as string) as item,
               cast(sum_of_sales as string) as amount from all_sales_by_month_{REPORT_YEAR}
        union all
        select 'device', device, cast(log_count as string) from top_5_devices
        union all
        select 'product', product_name, cast(amount_sold as string)
        from top_100_products_country_most_access
        """
    )
