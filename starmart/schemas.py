"""Declared schemas, natural keys and attribute lists of every table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "money": MONEY,
    "checksum": T.DecimalType(38, 0),
}


def _struct(text: str) -> T.StructType:
    """``name type, name type, ...``; needs no session, unlike ``StructType.fromDDL``."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SOURCE_SCHEMAS = {
    "orders": _struct(
        "order_id bigint, order_date timestamp_ntz, CUIT bigint, customer_id bigint,"
        " suppliers_catalog_id bigint"
    ),
    "companies": _struct("CUIT bigint, name string"),
    "customers": _struct(
        "customer_id bigint, document_number bigint, full_name string, date_of_birth date,"
        " username string"
    ),
    "suppliers_catalog": _struct(
        "suppliers_catalog_id bigint, supplier_id bigint, product_id bigint, price money"
    ),
    "companies_catalog": _struct(
        "suppliers_catalog_id bigint, CUIT bigint, catalog_price money"
    ),
    "suppliers": _struct("supplier_id bigint, name string"),
    "products": _struct("product_id bigint, name string"),
}

STAGED_ORDERS = _struct(
    "order_id bigint, order_date timestamp_ntz, CUIT bigint, company_name string,"
    " customer_id bigint, document_number bigint, full_name string, date_of_birth date,"
    " username string, supplier_id bigint, supplier_name string, product_id bigint,"
    " product_name string, order_price money"
)
STAGED_LOGS = _struct(
    "ipaddr string, username string, time timestamp_ntz, country_name string, device string,"
    " is_mobile int, is_pc int, is_tablet int"
)
# The store also keeps the raw text of lines whose time could not be read.
STORED_LOGS = _struct(
    "ipaddr string, username string, time timestamp_ntz, country_name string, device string,"
    " is_mobile int, is_pc int, is_tablet int, value string"
)
STAGED_LEADS = _struct(
    "contact_date timestamp_ntz, company_name string, contact_name string, lead_source string,"
    " status string"
)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form the optimizer knows to be empty: joins with it fold away."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*nulls).filter(F.lit(False))


@dataclass(frozen=True)
class Dimension:
    """A dimension table: its surrogate key, natural key and descriptive attributes.

    ``null_mode`` says how new members of an insert-only dimension are found; it is ``None``
    for a dimension that keeps versions.
    """

    name: str
    sk: str
    key: tuple[str, ...]
    attrs: tuple[str, ...]
    types: str
    null_mode: str | None = None

    @property
    def members(self) -> tuple[str, ...]:
        return self.key + self.attrs

    @property
    def schema(self) -> T.StructType:
        return _struct(
            f"{self.sk} bigint, {self.types}, start_date timestamp_ntz, end_date timestamp_ntz"
        )


COMPANY = Dimension(
    "dim_company", "sk_company", ("CUIT",), ("company_name",), "CUIT bigint, company_name string"
)
CUSTOMER = Dimension(
    "dim_customer",
    "sk_customer",
    ("customer_id",),
    ("document_number", "full_name", "date_of_birth", "username"),
    "customer_id bigint, document_number bigint, full_name string, date_of_birth date,"
    " username string",
)
SUPPLIER = Dimension(
    "dim_supplier",
    "sk_supplier",
    ("supplier_id",),
    ("supplier_name",),
    "supplier_id bigint, supplier_name string",
)
PRODUCT = Dimension(
    "dim_product",
    "sk_product",
    ("product_id",),
    ("product_name",),
    "product_id bigint, product_name string",
)
IPADDR = Dimension("dim_ipaddr", "sk_ipaddr", ("ipaddr",), (), "ipaddr string", "antijoin")
COUNTRY = Dimension(
    "dim_country", "sk_country", ("country_name",), (), "country_name string", "except"
)
DEVICE = Dimension(
    "dim_device",
    "sk_device",
    ("device", "is_mobile", "is_pc", "is_tablet"),
    (),
    "device string, is_mobile int, is_pc int, is_tablet int",
    "except",
)
CONTACT = Dimension(
    "dim_contact", "sk_contact", ("contact_name",), (), "contact_name string", "not_in"
)
LEADSOURCE = Dimension(
    "dim_leadsource", "sk_leadsource", ("lead_source",), (), "lead_source string", "not_in"
)
STATUS = Dimension("dim_status", "sk_status", ("status",), (), "status string", "not_in")

ORDER_DIMENSIONS = (COMPANY, CUSTOMER, SUPPLIER, PRODUCT)
LOG_DIMENSIONS = (IPADDR, COUNTRY, DEVICE)
LEAD_DIMENSIONS = (CONTACT, LEADSOURCE, STATUS)

FACT_ORDERS = _struct(
    "sk_company bigint, sk_customer bigint, sk_supplier bigint, sk_product bigint,"
    " price money, order_date timestamp_ntz"
)
FACT_LOGS = _struct(
    "sk_ipaddr bigint, sk_country bigint, sk_device bigint, sk_customer bigint,"
    " time timestamp_ntz"
)
FACT_LEADS = _struct(
    "contact_date timestamp_ntz, sk_company bigint, sk_contact bigint, sk_leadsource bigint,"
    " sk_status bigint"
)
# What is loaded, by month: compared with the source to find months to load again.
ORDER_SUMS = _struct("month string, orders bigint, checksum checksum")

# Every table of the warehouse: schema and, where it is stored in slices, the slice column.
TABLES = {
    "stg_source_orders": (SOURCE_SCHEMAS["orders"], None),
    "stg_orders": (STAGED_ORDERS, None),
    "stg_orders_reprocess": (STAGED_ORDERS, None),
    "stg_logs": (STORED_LOGS, "is_readable"),
    "stg_leads": (STAGED_LEADS, None),
    "fact_orders": (FACT_ORDERS, "order_month"),
    "sums_orders": (ORDER_SUMS, None),
    "fact_logs": (FACT_LOGS, None),
    "fact_leads": (FACT_LEADS, None),
    **{
        d.name: (d.schema, "key_slice")
        for d in ORDER_DIMENSIONS + LOG_DIMENSIONS + LEAD_DIMENSIONS
    },
}
# The columns whose hash tells the slice of a dimension's row.
SLICE_KEYS = {
    **{d.name: d.key for d in ORDER_DIMENSIONS},
    **{d.name: d.members for d in LOG_DIMENSIONS + LEAD_DIMENSIONS},
}
