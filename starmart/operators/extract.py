"""Order extraction: incremental by a high-water mark, or a closed date range."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.literals import wall_clock
from starmart.operators.joins import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    hot_keys,
    lookup_join,
    measured,
)
from starmart.schemas import MONEY
from starmart.session import at_once

# Lower bound used while the fact is empty.
BEGINNING = "1950-01-01 00:00:00"


def high_water(
    fact: DataFrame, date_col: str = "order_date", lookback: timedelta | None = None
) -> datetime | None:
    """The newest loaded date, None for an empty fact.

    It is fetched so that the extract carries it as a literal, which the scan can push down.
    ``lookback`` moves the mark back to pick up rows that arrived late.
    """
    newest = fact.agg(F.max(date_col)).first()[0]
    return newest - lookback if newest is not None and lookback else newest


def orders_in_scope(
    orders: DataFrame,
    high_water: datetime | str | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
) -> DataFrame:
    """The orders an extract takes, with the columns it reads."""
    date = F.col("order_date")
    if start is not None and end is not None:
        wanted = date.between(wall_clock(start), wall_clock(end))
    elif start is None and end is None:
        wanted = date > wall_clock(high_water or BEGINNING)
    else:
        raise ValueError("give both start and end, or neither")
    return orders.filter(wanted).select(
        "order_id", "order_date", "CUIT", "customer_id", "suppliers_catalog_id"
    )


def hot_order_keys(
    src: Mapping[str, DataFrame],
    high_water: datetime | str | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
) -> dict[tuple[str, ...], list[int]]:
    """The hot keys of the orders an extract takes, for its ``hot``; reads the orders once more."""
    keys = [("CUIT",), ("customer_id",), ("suppliers_catalog_id",)]
    keys.append(("suppliers_catalog_id", "CUIT"))
    return hot_keys(orders_in_scope(src["orders"], high_water, start, end), keys)


def small_tables(src: Mapping[str, DataFrame]) -> frozenset[str]:
    """Which of the companies and suppliers have few enough names to broadcast, for ``small``."""
    keys = {"companies": "CUIT", "suppliers": "supplier_id"}
    sizes = at_once(lambda t=t, k=k: measured(src[t].select(k, "name")) for t, k in keys.items())
    return frozenset(
        t for t, (n, size) in zip(keys, sizes) if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES
    )


def extract_rejects(
    src: Mapping[str, DataFrame],
    high_water: datetime | str | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    hot: Mapping[tuple[str, ...], Sequence[int]] | None = None,
) -> DataFrame:
    """The orders that ``extract_orders`` leaves out, with ``missing`` = the first table that
    lacks their row: company, customer, item, supplier or product.

    An item listed with several suppliers or products is found if one of them is.
    """
    hot = hot or {}
    flag = F.lit(True)

    def known(table: str, key: str, name: str, mark: str) -> DataFrame:
        return src[table].select(F.col(key).alias(name)).distinct().withColumn(mark, flag)

    items = src["suppliers_catalog"].select("suppliers_catalog_id", "supplier_id", "product_id")
    items = lookup_join(
        items, known("suppliers", "supplier_id", "_s", "_supplier"), [("supplier_id", "_s")], "left"
    )
    items = lookup_join(
        items, known("products", "product_id", "_p", "_product"), [("product_id", "_p")], "left"
    )
    items = items.groupBy(F.col("suppliers_catalog_id").alias("_i")).agg(
        flag.alias("_item"),
        F.max("_supplier").alias("_supplier"),
        # of the entries whose supplier is known, as the extract needs both
        F.max(F.col("_supplier") & F.col("_product")).alias("_product"),
    )
    rows = orders_in_scope(src["orders"], high_water, start, end)
    columns = rows.columns
    sides = [
        (known("companies", "CUIT", "_c", "_company"), "CUIT", "_c"),
        (known("customers", "customer_id", "_u", "_customer"), "customer_id", "_u"),
        (items, "suppliers_catalog_id", "_i"),
    ]
    for side, key, name in sides:
        rows = lookup_join(rows, side, [(key, name)], "left", hot.get((key,), ()))
    marks = ["company", "customer", "item", "supplier", "product"]
    missing = F.coalesce(*[F.when(F.col(f"_{m}").isNull(), m) for m in marks])
    return rows.select(*columns, missing.alias("missing")).filter(F.col("missing").isNotNull())


def extract_orders(
    src: Mapping[str, DataFrame],
    high_water: datetime | str | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    match_company: bool = False,
    hot: Mapping[tuple[str, ...], Sequence[int]] | None = None,
    small: Collection[str] = (),
) -> DataFrame:
    """Flatten the seven order tables into one staged row per order line.

    With ``start`` and ``end``: orders of that closed range. Otherwise: orders strictly newer
    than ``high_water`` (all, when there is none). The price is the company list price if there
    is one, else the supplier's. The list is matched by item only unless ``match_company``.

    The fact side is shuffled twice: by catalog item, and then by customer, so that a customer's
    rows are stored together and their attributes are told apart where they are. The item's product
    and supplier are joined on the catalog side first, and both price lists share the item's
    partitioning. With a bound on the date the catalog meets the orders without names, so that an
    increment doesn't move it through the joins with suppliers and products; the order lines go
    there instead. Of the tables named in ``small`` (``small_tables``) the names are broadcast to
    the rows at the end, so that no shuffle carries them. Hot keys are left to AQE, or spread if
    ``hot`` names them (``hot_order_keys``).
    """
    hot = hot or {}
    orders = orders_in_scope(src["orders"], high_water, start, end)
    bounded = high_water is not None or start is not None
    companies = src["companies"].select(
        F.col("CUIT").alias("_cuit"), F.col("name").alias("company_name")
    )
    customers = src["customers"].select(
        F.col("customer_id").alias("_customer"),
        "document_number",
        "full_name",
        "date_of_birth",
        "username",
    )
    suppliers = src["suppliers"].select(
        F.col("supplier_id").alias("_supplier"), F.col("name").alias("supplier_name")
    )
    products = src["products"].select(
        F.col("product_id").alias("_product"), F.col("name").alias("product_name")
    )

    def with_names(rows: DataFrame) -> DataFrame:
        rows = lookup_join(rows, products, [("product_id", "_product")])
        return rows if "suppliers" in small else lookup_join(rows, suppliers, by_supplier)

    by_supplier, by_company = [("supplier_id", "_supplier")], [("CUIT", "_cuit")]
    items = src["suppliers_catalog"].select(
        F.col("suppliers_catalog_id").alias("_item"), "supplier_id", "product_id", "price"
    )
    if not bounded:
        items = with_names(items)
    list_prices = src["companies_catalog"].select(
        F.col("suppliers_catalog_id").alias("_list_item"),
        F.col("CUIT").alias("_list_cuit"),
        "catalog_price",
    )
    by_list = [("suppliers_catalog_id", "_list_item")]
    if match_company:
        by_list.append(("CUIT", "_list_cuit"))

    rows = lookup_join(
        orders,
        items,
        [("suppliers_catalog_id", "_item")],
        hot=hot.get(("suppliers_catalog_id",), ()),
    )
    rows = lookup_join(
        rows, list_prices, by_list, "left", hot.get(tuple(f for f, _ in by_list), ())
    )
    price = F.coalesce("catalog_price", "price").cast(MONEY).alias("order_price")
    rows = rows.select(*[c for c in rows.columns if c not in ("catalog_price", "price")], price)
    if bounded:
        rows = with_names(rows)
    if "companies" not in small:
        rows = lookup_join(rows, companies, by_company, hot=hot.get(("CUIT",), ()))
    rows = lookup_join(
        rows, customers, [("customer_id", "_customer")], hot=hot.get(("customer_id",), ())
    )
    if "companies" in small:
        rows = lookup_join(rows, F.broadcast(companies), by_company)
    if "suppliers" in small:
        rows = lookup_join(rows, F.broadcast(suppliers), by_supplier)
    return rows.select(
        "order_id",
        "order_date",
        "CUIT",
        "company_name",
        "customer_id",
        "document_number",
        "full_name",
        "date_of_birth",
        "username",
        "supplier_id",
        "supplier_name",
        "product_id",
        "product_name",
        "order_price",
    )
