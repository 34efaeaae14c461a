"""The loads: orders, orders of a period again, web logs, leads.

Each load writes its staging table once and reads it for every dimension and the fact. The
surrogate keys of a dimension are committed before the fact looks them up.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starmart import schemas as S
from starmart.functions.useragent import classify_user_agent
from starmart.functions.weblog import parse_weblogs, readable
from starmart.operators.dimensions import (
    among,
    close_versions,
    new_members,
    new_versions,
    staged_values,
)
from starmart.functions.literals import wall_clock
from starmart.operators.extract import (
    extract_orders,
    high_water,
    hot_order_keys,
    orders_in_scope,
    small_tables,
)
from starmart.operators.facts import (
    Lookup,
    balance,
    fact_rejects,
    load_fact,
    outside_period,
    same,
)
from starmart.operators.geo import assign_country, enrich_country, unique_geo
from starmart.operators.joins import FEW_VALUES
from starmart.operators.sums import added, differing, month_sums
from starmart.session import at_once
from starmart.sources.store import Warehouse

_MONTH = "order_month="


def order_lookups(
    dims: Mapping[str, DataFrame],
    company_on: str = "company_name",
    as_of: str | None = None,
    collation: str | None = None,
) -> list[Lookup]:
    """Lookups of the order fact. The company is found by name unless ``company_on="CUIT"``.

    With ``as_of="order_date"`` the versions valid on the order date are found, not the open ones.
    A ``collation`` applies to the company's name.
    """
    by_name = collation if company_on == "company_name" else None
    return [
        Lookup(dims["dim_company"], "sk_company", same(company_on), as_of, by_name),
        Lookup(dims["dim_supplier"], "sk_supplier", same("supplier_id"), as_of),
        Lookup(dims["dim_product"], "sk_product", same("product_id"), as_of),
        Lookup(dims["dim_customer"], "sk_customer", same("customer_id"), as_of),
    ]


def log_lookups(dims: Mapping[str, DataFrame], collation: str | None = None) -> list[Lookup]:
    """Lookups of the log fact; a ``collation`` lets the user names differ in case."""
    return [
        Lookup(dims["dim_country"], "sk_country", same("country_name")),
        Lookup(
            dims["dim_device"], "sk_device", same("device", "is_mobile", "is_pc", "is_tablet")
        ),
        Lookup(dims["dim_customer"], "sk_customer", same("username"), collation=collation),
        Lookup(dims["dim_ipaddr"], "sk_ipaddr", same("ipaddr")),
    ]


def lead_lookups(dims: Mapping[str, DataFrame], collation: str | None = None) -> list[Lookup]:
    """Lookups of the lead fact, all by name; a ``collation`` lets the names differ in case."""
    by_name = [
        ("dim_company", "sk_company", "company_name"),
        ("dim_leadsource", "sk_leadsource", "lead_source"),
        ("dim_status", "sk_status", "status"),
        ("dim_contact", "sk_contact", "contact_name"),
    ]
    return [Lookup(dims[d], sk, same(c), collation=collation) for d, sk, c in by_name]


ORDER_FACT_COLUMNS = [
    "sk_company",
    "sk_customer",
    "sk_supplier",
    "sk_product",
    "order_price as price",
    "order_date",
]
LOG_FACT_COLUMNS = S.FACT_LOGS.names
LEAD_FACT_COLUMNS = S.FACT_LEADS.names


def stage_weblogs(
    lines: DataFrame,
    geo: DataFrame | None = None,
    countries: DataFrame | None = None,
    tz: str = "wall",
    keep_unparsable: bool = False,
    hot_ips: Sequence[int] = (),
) -> DataFrame:
    """Log lines -> staged log rows: parse, drop unreadable times, add country and device.

    The country comes from ``geo`` (``ip, country_name``; of an ip's countries the first by name),
    or is made up from the list ``countries``.
    """
    parsed = readable(parse_weblogs(lines, tz=tz), keep_unparsable)
    return _described(parsed, geo, countries, hot_ips).select(*S.STAGED_LOGS.names)


def _described(
    parsed: DataFrame,
    geo: DataFrame | None,
    countries: DataFrame | None,
    hot_ips: Sequence[int] = (),
) -> DataFrame:
    if (geo is None) == (countries is None):
        raise ValueError("give either geo or countries")
    narrow = parsed.select("ipaddr", "username", "time", "useragent", "value")
    # Before the join, so that the agent text is not shuffled with the row.
    rows = classify_user_agent(narrow).drop("useragent")
    if geo is None:
        return assign_country(rows, countries)
    return enrich_country(rows, unique_geo(geo), hot_ips)


def _open_dims(wh: Warehouse, names: Iterable[str]) -> dict[str, DataFrame]:
    return {n: wh.table(n, wh.open_slices(n)) for n in names}


def merge_versions(
    wh: Warehouse, d: S.Dimension, staged: DataFrame, load_ts, scd2: Mapping | None = None
) -> None:
    """Load a versioned dimension from staged rows, slice by slice.

    The slices of the staged keys are read, and those of the keys that got a new version are
    written again; the dimension itself isn't moved where the load has few keys.
    """
    options = dict(scd2 or {})
    extra = [options.get("order_col", "order_date")] if options.get("variants") == "latest" else []
    values = staged_values(staged, [*d.key, *d.attrs, *extra])
    counts = wh.key_counts(d.name, values)
    dim = wh.table(d.name, wh.slot_slices(d.name, counts))
    known = among(dim, values, d.key, sum(counts.values()))
    start = wh.next_key(d.name, d.sk)
    added = new_versions(known, values, d.key, d.attrs, d.sk, load_ts, start=start, **options)
    counts = wh.key_counts(d.name, added)
    total = sum(counts.values())
    if not total:
        return
    touched = set(wh.slot_slices(d.name, counts)) & set(wh.open_slices(d.name))
    few = total <= FEW_VALUES
    changes = close_versions(wh.table(d.name, touched), added, d.key, d.sk, load_ts, few)
    wh.replace_slices(d.name, changes, touched, top_key=start + total - 1)


def _merge_order_dims(wh: Warehouse, staged: DataFrame, load_ts, scd2: Mapping) -> None:
    at_once(lambda d=d: merge_versions(wh, d, staged, load_ts, scd2) for d in S.ORDER_DIMENSIONS)


def load_members(wh: Warehouse, d: S.Dimension, staged: DataFrame, load_ts) -> None:
    """Add new members to an insert-only dimension; reads the slices of the staged values only."""
    values = staged_values(staged, d.members)
    counts = wh.key_counts(d.name, values)
    known = wh.table(d.name, wh.slot_slices(d.name, counts))
    known, holds = among(known, values, d.members, sum(counts.values())), None
    if d.null_mode == "not_in":
        null = wh.spark.range(1).select(F.lit(None).cast("string").alias(*d.members))
        of_null = wh.table(d.name, wh.slot_slices(d.name, wh.key_counts(d.name, null)))
        missing = of_null.filter(F.col(*d.members).isNull())
        holds = bool(wh.slices(d.name)), bool(missing.head(1))
    start = wh.next_key(d.name, d.sk)
    rows = new_members(
        known, values, d.members, d.sk, load_ts, d.null_mode, start=start, holds=holds
    )
    total = rows.count()
    if total:
        wh.append(d.name, rows, top_key=start + total - 1)


def _add_members(wh: Warehouse, staged: DataFrame, dims, load_ts) -> None:
    at_once(lambda d=d: load_members(wh, d, staged, load_ts) for d in dims)


def _order_lookups(
    wh: Warehouse, company_on: str, as_of: str | None, collation: str | None
) -> list[Lookup]:
    names = [d.name for d in S.ORDER_DIMENSIONS]
    dims = _open_dims(wh, names) if as_of is None else {n: wh.table(n) for n in names}
    return order_lookups(dims, company_on, as_of, collation)


def _order_fact_rows(wh: Warehouse, staged: DataFrame, *options) -> DataFrame:
    lookups = _order_lookups(wh, *options)
    return load_fact(staged, lookups, ORDER_FACT_COLUMNS, balance(staged, lookups))


def _months(wh: Warehouse) -> list[str]:
    """The fact's slices by month; not that of orders without a date."""
    return [s for s in wh.slices("fact_orders") if s[len(_MONTH):][:1].isdigit()]


def loaded_up_to(wh: Warehouse, lookback: timedelta | None = None) -> datetime | None:
    """Newest order date in the fact, read from its newest month only."""
    months = _months(wh)
    if not months:
        return None
    return high_water(wh.table("fact_orders", {months[-1]}), lookback=lookback)


def _note_sums(
    wh: Warehouse, staged: DataFrame, exchanged: Sequence[str] = (), unknown: Sequence[str] = ()
) -> None:
    """Note the sums of what was loaded, after the fact: a load that fails between leaves months
    that differ from the source and are loaded again, never months wrongly taken for the same.

    ``exchanged`` names months whose orders were all loaded anew, ``unknown`` those of which a
    part was: their sum is not known, so they have none. A table of one row a month.
    """
    gone = [*exchanged, *unknown]
    fresh = month_sums(staged)
    if unknown:
        fresh = fresh.filter(~F.col("month").isin(*unknown))
    known = wh.table("sums_orders")
    if gone:
        known = known.filter(~F.col("month").isin(*gone))
    wh.overwrite("sums_orders", added(known, fresh).coalesce(1))


def _taken_once(
    wh: Warehouse,
    src: Mapping[str, DataFrame],
    mark=None,
    periods: Sequence[tuple] = (),
    stored: bool = True,
) -> Mapping[str, DataFrame]:
    """The source with the orders of a bounded extract, those after ``mark`` or of ``periods``.

    An extract that looks for hot keys reads its orders twice, so they are ``stored`` then: a
    source that joins or ships them does so once.
    """
    if periods:
        taken = orders_in_scope(src["orders"], None, periods[0][0], periods[-1][1])
        date = F.col("order_date")
        within = [date.between(wall_clock(start), wall_clock(end)) for start, end in periods]
        taken = taken.filter(reduce(lambda a, b: a | b, within))
    else:
        taken = orders_in_scope(src["orders"], mark)
    return {**src, "orders": wh.overwrite("stg_source_orders", taken) if stored else taken}


def run_orders(
    wh: Warehouse,
    src: Mapping[str, DataFrame],
    load_ts: datetime | str,
    company_on: str = "company_name",
    match_company: bool = False,
    lookback: timedelta | None = None,
    find_hot: bool = False,
    scd2: Mapping | None = None,
    as_of: str | None = None,
    collation: str | None = None,
) -> None:
    """Load the orders that are newer than the fact: staging, four dimensions, fact.

    With a ``lookback`` the orders of that time before the newest one are loaded again and
    exchanged in the fact, so that late ones come in and none counts twice. ``find_hot`` reads the
    keys of the new orders beforehand and spreads the hot ones; without it the extract leaves them
    to AQE. ``as_of`` and ``collation`` are those of ``order_lookups``.
    """
    mark = loaded_up_to(wh, lookback)
    if mark is not None:
        src = _taken_once(wh, src, mark, stored=find_hot)
    hot = hot_order_keys(src, mark) if find_hot else None
    small = small_tables(src)
    rows = extract_orders(src, mark, match_company=match_company, hot=hot, small=small)
    staged = wh.overwrite("stg_orders", rows)
    _merge_order_dims(wh, staged, load_ts, scd2 or {})
    rows = _order_fact_rows(wh, staged, company_on, as_of, collation)
    if lookback is None or mark is None:
        wh.append("fact_orders", rows)
        _note_sums(wh, staged)
        return
    month = str(mark)[:7]
    touched = [s for s in _months(wh) if s[len(_MONTH):] >= month]
    kept = wh.table("fact_orders", touched).filter(F.col("order_date") <= wall_clock(mark))
    wh.replace_slices("fact_orders", kept.unionByName(rows), touched)
    later = [r["month"] for r in wh.table("sums_orders").select("month").collect()]
    _note_sums(wh, staged, [m for m in later if m > month], [month])


def order_rejects(
    wh: Warehouse,
    company_on: str = "company_name",
    table: str = "stg_orders",
    as_of: str | None = None,
    collation: str | None = None,
) -> DataFrame:
    """Orders of the last load that found no place in the fact, and why."""
    lookups = _order_lookups(wh, company_on, as_of, collation)
    staged = wh.table(table)
    return fact_rejects(staged, lookups, balance(staged, lookups))


def reprocess_orders(
    wh: Warehouse,
    src: Mapping[str, DataFrame],
    start: datetime | str,
    end: datetime | str,
    load_ts: datetime | str,
    company_on: str = "company_name",
    match_company: bool = False,
    dim_rows: DataFrame | None = None,
    scd2: Mapping | None = None,
    find_hot: bool = False,
    as_of: str | None = None,
    collation: str | None = None,
) -> None:
    """Load the orders of a closed date range again and exchange them in the fact.

    The dimensions take their members from the reloaded rows, or from ``dim_rows`` if given.
    ``find_hot`` reads the keys of the orders beforehand and spreads the hot ones.

    Only the months the range touches are rewritten, and in one step: readers see the old or the
    new period, never a gap.
    """
    _reprocess(
        wh, src, [(start, end)], load_ts, company_on, match_company, dim_rows, scd2, find_hot, as_of,
        collation,
    )


def _reprocess(
    wh, src, periods, load_ts, company_on="company_name", match_company=False, dim_rows=None,
    scd2=None, find_hot=False, as_of=None, collation=None,
) -> None:
    """``reprocess_orders`` of closed ranges that share no moment, in rising order, in one load."""
    start, end = periods[0][0], periods[-1][1]
    src = _taken_once(wh, src, periods=periods, stored=find_hot)
    hot = hot_order_keys(src, start=start, end=end) if find_hot else None
    small = small_tables(src)
    rows = extract_orders(
        src, start=start, end=end, match_company=match_company, hot=hot, small=small
    )
    staged = wh.overwrite("stg_orders_reprocess", rows)
    members = staged if dim_rows is None else dim_rows
    _merge_order_dims(wh, members, load_ts, scd2 or {})
    within, cut = [(str(a)[:7], str(b)[:7]) for a, b in periods], set()
    touched = [
        s for s in wh.slices("fact_orders")
        if any(first <= s[len(_MONTH):] <= last for first, last in within)
    ]
    kept = wh.table("fact_orders", touched)
    for (start, end), (first, last) in zip(periods, within):
        kept = outside_period(kept, "order_date", start, end)
        if _moment(start) > _first(first):
            cut.add(first)
        if _moment(end) < _last(last):
            cut.add(last)
    reloaded = _order_fact_rows(wh, staged, company_on, as_of, collation)
    wh.replace_slices("fact_orders", kept.unionByName(reloaded), touched)
    # of one row a month
    noted = [r["month"] for r in wh.table("sums_orders").select("month").collect()]
    exchanged = [m for m in noted if any(first <= m <= last for first, last in within)]
    _note_sums(wh, staged, exchanged, sorted(cut))


def _moment(value: datetime | str) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def _first(month: str) -> datetime:
    return datetime.fromisoformat(f"{month}-01")


def _next(month: str) -> str:
    return str(_first(month) + timedelta(days=31))[:7]


def _last(month: str) -> datetime:
    """The last moment of a month that a timestamp can tell."""
    return _first(_next(month)) - timedelta(microseconds=1)


def months_to_reload(
    wh: Warehouse, src: Mapping[str, DataFrame], match_company: bool = False
) -> DataFrame:
    """Months in which the source no longer has the orders that were loaded.

    ``month, n_source, n_loaded``: orders came late, changed (also by their item's price or
    supplier) or went. The source is extracted and summed up by month; of what was loaded only the
    noted sums are read, no fact and no staged row. Newer orders, not loaded yet, count as
    differences too; so do months of which a look-back or a period exchanged a part, whose sum isn't
    known. Names aren't compared: that they change is the dimensions' matter.
    """
    rows = extract_orders(src, match_company=match_company, small=small_tables(src))
    return differing(month_sums(rows), wh.table("sums_orders"))


def reconcile_orders(
    wh: Warehouse,
    src: Mapping[str, DataFrame],
    load_ts: datetime | str,
    match_company: bool = False,
    **options,
) -> list[str]:
    """Load again the months that differ from the source, and name them.

    They are loaded in one go, neighbouring months as one period, as ``reprocess_orders`` does with
    the other ``options``. The driver holds names of months only.
    """
    found = months_to_reload(wh, src, match_company).select("month").collect()
    months = sorted(r["month"] for r in found)
    periods, start = [], None
    for month, following in zip(months, [*months[1:], None]):
        start = start or month
        if following != _next(month):
            periods.append((str(_first(start)), str(_last(month))))
            start = None
    if periods:
        _reprocess(wh, src, periods, load_ts, match_company=match_company, **options)
    return months


def _stage(wh: Warehouse, name: str, rows: DataFrame, batch) -> bool:
    """Stage the rows; False if the batch was staged before."""
    if batch is None:
        wh.overwrite(name, rows)
        return True
    before = wh.version(name)
    wh.append(name, rows, batch)
    return wh.version(name) > before


def _staged_rows(wh: Warehouse, name: str, batch, slices=None) -> DataFrame:
    return wh.table(name, slices) if batch is None else wh.batch(name, batch[0], slices)


def run_logs(
    wh: Warehouse,
    lines: DataFrame,
    geo: DataFrame | None,
    load_ts: datetime | str,
    countries: DataFrame | None = None,
    tz: str = "wall",
    keep_unparsable: bool = False,
    batch: tuple[str, int] | None = None,
    hot_ips: Sequence[int] = (),
    collation: str | None = None,
) -> dict[str, int]:
    """Load log lines: staging, three dimensions, fact. Returns the line counts of the parse.

    One pass stages readable rows and, apart from them, the unreadable lines (see
    ``quarantined_lines``). Customers come from the orders load. With a ``batch`` the rows are
    added to those staged before (``ingest_weblogs`` clears them once at its start), so that the
    unreadable lines and rejects of all batches can be read afterwards. The counts are empty for
    a batch that was staged already. A ``collation`` lets the user names differ in case.
    """
    counts = Observation()
    parsed = parse_weblogs(lines, tz=tz).observe(
        counts,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("time").isNull()).alias("unreadable"),
    )
    if keep_unparsable:
        parsed = readable(parsed, keep_unparsable=True)
    raw = F.when(F.col("time").isNull(), F.col("value")).alias("value")
    rows = _described(parsed.withColumn("value", raw), geo, countries, hot_ips)
    fresh = _stage(wh, "stg_logs", rows, batch)
    staged = _staged_rows(wh, "stg_logs", batch, {"is_readable=1"})
    _add_members(wh, staged, S.LOG_DIMENSIONS, load_ts)
    dims = _open_dims(wh, ["dim_ipaddr", "dim_country", "dim_device", "dim_customer"])
    lookups = log_lookups(dims, collation)
    rows = load_fact(staged, lookups, LOG_FACT_COLUMNS, balance(staged, lookups))
    wh.append("fact_logs", rows, batch)
    return counts.get if fresh else {}


def quarantined_lines(wh: Warehouse) -> DataFrame:
    """Raw lines of the last log load, all its batches, whose time could not be read."""
    return wh.table("stg_logs", {"is_readable=0"}).select("value")


def log_rejects(wh: Warehouse, collation: str | None = None) -> DataFrame:
    """Readable log rows of the last load that found no place in the fact, and why."""
    staged = wh.table("stg_logs", {"is_readable=1"}).drop("value")
    dims = _open_dims(wh, ["dim_ipaddr", "dim_country", "dim_device", "dim_customer"])
    lookups = log_lookups(dims, collation)
    return fact_rejects(staged, lookups, balance(staged, lookups))


def run_leads(
    wh: Warehouse,
    leads: DataFrame,
    load_ts: datetime | str,
    batch: tuple[str, int] | None = None,
    collation: str | None = None,
) -> None:
    """Load leads: staging, three dimensions, fact. Companies come from the orders load.

    A ``collation`` lets the names differ in case.
    """
    _stage(wh, "stg_leads", leads, batch)
    staged = _staged_rows(wh, "stg_leads", batch)
    _add_members(wh, staged, S.LEAD_DIMENSIONS, load_ts)
    lookups = lead_lookups(
        _open_dims(wh, ["dim_company", "dim_contact", "dim_leadsource", "dim_status"]), collation
    )
    rows = load_fact(staged, lookups, LEAD_FACT_COLUMNS, balance(staged, lookups))
    wh.append("fact_leads", rows, batch)


def lead_rejects(wh: Warehouse, collation: str | None = None) -> DataFrame:
    """Leads of the last load that found no place in the fact, and why."""
    staged = wh.table("stg_leads")
    lookups = lead_lookups(
        _open_dims(wh, ["dim_company", "dim_contact", "dim_leadsource", "dim_status"]), collation
    )
    return fact_rejects(staged, lookups, balance(staged, lookups))
