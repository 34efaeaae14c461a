"""The queries as plain SQL over the driver's views, written independently of the operators."""

from __future__ import annotations

import re

from starmart import schemas as S
from starmart.adapters import AGENTS, HOSTS, ITEM_BASE
from starmart.checks.queries import CUTOVER, DRIFT_MONTHS, LOAD_1, LOAD_2, LOAD_3, MID_JANUARY, PERIOD
from starmart.checks.queries import REPORT_YEAR as YEAR

# The line format without possessive quantifiers, which RE2 lacks.
LINE = (
    r"^(\S+) (\S+) (\S+) \[([^\]]+)\] "
    r'"((?:[^"\\]|\\.)*)" (\d{3}|-) (\d+|-)'
    r'(?: "((?:[^"\\]|\\.)*)" "((?:[^"\\]|\\.)*)")?\s*$'
)
_CTES: dict[str, str] = {}
_SQL: dict[str, str] = {}


def _cte(name: str, sql: str) -> None:
    _CTES[name] = sql


def _with(select: str) -> str:
    """Prefix ``select`` with the named steps it needs, in definition order."""
    wanted: set[str] = set()
    todo = [select]
    while todo:
        text = todo.pop()
        for name in _CTES:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                todo.append(_CTES[name])
    steps = [f"{n} as ({_CTES[n]})" for n in _CTES if n in wanted]
    return f"with {', '.join(steps)} {select}" if steps else select


def _oracle(name: str, select: str) -> None:
    _SQL[name] = _with(select)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- inputs -----------------------------------------------------------------------------------

_cte(
    "b2b_companies",
    "select cast(30000000 + n_nationkey as bigint) as CUIT, n_name as name from nation",
)
_cte(
    "b2b_customers",
    """select c_custkey as customer_id, 10000000 + 7 * c_custkey as document_number,
       c_name as full_name, DATE '1960-01-01' + cast(c_custkey % 15000 as int) as date_of_birth,
       concat('user', cast(c_custkey as varchar)) as username from customer""",
)
_cte("b2b_suppliers", "select s_suppkey as supplier_id, s_name as name from supplier")
_cte("b2b_products", "select p_partkey as product_id, p_name as name from part")
_cte(
    "b2b_renamed",
    """select p_partkey as product_id,
       case when p_type = 'ECONOMY' then p_name || ' v2' else p_name end as name from part""",
)
_cte(
    "b2b_items",
    f"""select distinct l_partkey * {ITEM_BASE} + l_suppkey as suppliers_catalog_id,
       l_suppkey as supplier_id, l_partkey as product_id,
       cast(p_retailprice as decimal(18,2)) as price, p_size
       from lineitem join part on l_partkey = p_partkey""",
)
_cte(
    "b2b_list_prices",
    """select suppliers_catalog_id, cast(30000000 as bigint) as CUIT,
       cast(price - 1 as decimal(18,2)) as catalog_price from b2b_items where p_size <= 16""",
)
_cte(
    "b2b_orders",
    f"""select l_orderkey * 10 + l_linenumber as order_id, o_orderdate as order_date,
       cast(30000000 + c_nationkey as bigint) as CUIT, o_custkey as customer_id,
       l_partkey * {ITEM_BASE} + l_suppkey as suppliers_catalog_id
       from lineitem join orders on l_orderkey = o_orderkey
       join customer on o_custkey = c_custkey""",
)


def _extract(where: str = "true", products: str = "b2b_products", match: bool = False) -> str:
    """Order lines in three steps: the catalog described, its list price, then who bought."""
    listed = "suppliers_catalog_id, CUIT" if match else "suppliers_catalog_id"
    catalog = f"""select suppliers_catalog_id, supplier_id, product_id, price,
        (select max(name) from b2b_suppliers x where x.supplier_id = i.supplier_id)
         as supplier_name,
        (select max(name) from {products} y where y.product_id = i.product_id) as product_name
        from b2b_items i"""
    return f"""select order_id, order_date, CUIT, company_name, customer_id, document_number,
        full_name, date_of_birth, username, supplier_id, supplier_name, product_id, product_name,
        coalesce(catalog_price, price) as order_price
        from (select * from b2b_orders where {where})
        join ({catalog}) using (suppliers_catalog_id)
        left join (select {listed}, catalog_price from b2b_list_prices) using ({listed})
        join b2b_customers using (customer_id)
        join (select CUIT, name as company_name from b2b_companies) using (CUIT)"""


_EARLY = f"order_date < TIMESTAMP '{CUTOVER}'"
_LATE = f"order_date >= TIMESTAMP '{CUTOVER}'"
_IN_PERIOD = f"between TIMESTAMP '{PERIOD[0]}' and TIMESTAMP '{PERIOD[1]}'"
_cte("staged_all", _extract())
_cte("staged_early", _extract(_EARLY))
_cte("staged_late", _extract(_LATE))
_cte("staged_late_renamed", _extract(_LATE, "b2b_renamed"))
_cte("staged_period", _extract(f"order_date {_IN_PERIOD}", match=True))

_HOST = f"(user_id % {HOSTS})"
_IP = f"concat('10.', ({_HOST} >> 16) & 255, '.', ({_HOST} >> 8) & 255, '.', {_HOST} & 255)"
_AGENT_ARRAY = "[" + ", ".join(f"'{a}'" for a in AGENTS) + "]"
_cte(
    "log_lines",
    f"""select concat({_IP}, ' - ',
        case when event_type = 'error' and value < 5 then '-' else concat('user', user_id) end,
        ' [', case when event_type = 'error' and value > 100 then '99/Foo/2024:00:00:00'
                   else strftime(ts, '%d/%b/%Y:%H:%M:%S') end,
        ' -0700] "GET /', event_type, ' HTTP/1.1" 200 ', event_id % 1000,
        ' "https://shop.example/catalog" "',
        ({_AGENT_ARRAY})[event_id % {len(AGENTS)} + 1], '"') as value from events""",
)


def _group(i: int) -> str:
    return f"regexp_extract(value, '{LINE}', {i})"


_cte(
    "parsed",
    f"""select {_group(1)} as ipaddr, {_group(2)} as identity, {_group(3)} as username,
        try_strptime(substr({_group(4)}, 1, 20), '%d/%b/%Y:%H:%M:%S') as time,
        {_group(5)} as request, try_cast({_group(6)} as int) as status,
        try_cast({_group(7)} as bigint) as bytes, nullif({_group(8)}, '') as referer,
        nullif({_group(9)}, '') as useragent, value from log_lines""",
)
_TABLET = """(regexp_matches(a, 'iPad|Kindle|PlayBook|Silk/') or (a like '%Android%'
    and a not like '%Mobile%' and a not like '%Windows Phone%'))"""
_MOBILE = f"""(not {_TABLET} and (regexp_matches(a,
    'iPhone|iPod|Windows Phone|BlackBerry|IEMobile|Opera Mini|Opera Mobi')
    or (a like '%Android%' and a like '%Mobile%')))"""
_PC = f"""(not {_TABLET} and not {_MOBILE} and (regexp_matches(a, 'Windows NT|Macintosh|CrOS')
    or (a like '%X11%' and a like '%Linux%')))"""
_cte(
    "described",
    f"""select *, case when a like '%Windows Phone%' then 'Windows Phone'
        when a like '%Windows%' then 'Windows'
        when regexp_matches(a, 'iPhone|iPad|iPod') then 'iOS'
        when a like '%Android%' then 'Android' when a like '%CrOS%' then 'Chrome OS'
        when regexp_matches(a, 'Mac OS X|Macintosh') then 'Mac OS X'
        when a like '%Ubuntu%' then 'Ubuntu' when regexp_matches(a, 'Linux|X11') then 'Linux'
        else 'Other' end as device,
        cast({_MOBILE} as int) as is_mobile, cast({_PC} as int) as is_pc,
        cast({_TABLET} as int) as is_tablet
        from (select *, coalesce(useragent, '') as a from parsed)""",
)
_cte(
    "geo",
    f"""select distinct {_IP} as ip, n_name as country_name from events
        join nation on n_nationkey = {_HOST} % 25""",
)
_cte(
    "staged_logs",
    """select ipaddr, username, time, country_name, device, is_mobile, is_pc, is_tablet
       from described left join geo on ip = ipaddr where time is not null""",
)
_cte(
    "staged_leads",
    """select o_orderdate as contact_date,
       case when c_mktsegment = 'MACHINERY' then 'UNKNOWN_CO' else n_name end as company_name,
       c_name as contact_name,
       case when o_totalprice >= 10000 then o_orderpriority end as lead_source,
       o_orderstatus as status
       from orders join customer on o_custkey = c_custkey
       join nation on c_nationkey = n_nationkey""",
)

# --- dimensions -------------------------------------------------------------------------------


def _numbered(d: S.Dimension, rows: str, load_ts: str, after: str = "0") -> str:
    """New versions or members with keys after the highest one in use."""
    cols = ", ".join(d.members)
    order = ", ".join(f"{c} nulls first" for c in d.members)
    return f"""select {after} + row_number() over (order by {order}) as {d.sk}, {cols},
        TIMESTAMP '{load_ts}' as start_date, cast(null as timestamp) as end_date from ({rows})"""


def _first(d: S.Dimension, staged: str, load_ts: str = LOAD_1) -> str:
    return _numbered(d, f"select distinct {', '.join(d.members)} from {staged}", load_ts)


def _next_key(d: S.Dimension, dim: str) -> str:
    return f"(select coalesce(max({d.sk}), 0) from {dim})"


def _version_load(
    name: str, dim: str, d: S.Dimension, staged: str, load_ts: str, known="true"
) -> None:
    """One load of a versioned dimension: what is new, then close and insert."""
    cols, key = ", ".join(d.members), d.key[0]
    _cte(
        f"{name}_delta",
        f"select {cols} from {staged} except select {cols} from {dim} where {known}",
    )
    added = _numbered(d, f"select * from {name}_delta", load_ts, _next_key(d, dim))
    _cte(
        name,
        f"""select {d.sk}, {cols}, start_date, case when end_date is null
            and {key} in (select {key} from {name}_delta where {key} is not null)
            then TIMESTAMP '{load_ts}' else end_date end as end_date from {dim}
            union all {added}""",
    )


def _member_load(name: str, dim: str, d: S.Dimension, new: str, load_ts: str) -> None:
    _cte(
        name, f"select * from {dim} union all {_numbered(d, new, load_ts, _next_key(d, dim))}"
    )


for _d in S.ORDER_DIMENSIONS:
    _cte(f"{_d.name}_early", _first(_d, "staged_early"))
    _cte(f"{_d.name}_all", _first(_d, "staged_all"))
    _version_load(f"{_d.name}_two", f"{_d.name}_early", _d, "staged_late_renamed", LOAD_2)
for _d in S.LOG_DIMENSIONS:
    _cte(f"{_d.name}_all", _first(_d, "staged_logs"))
for _d in S.LEAD_DIMENSIONS:
    _cte(f"{_d.name}_all", _first(_d, "staged_leads"))
_cte("dim_customer_list", _first(S.CUSTOMER, "b2b_customers"))
_cte("company_list", "select CUIT, name as company_name from b2b_companies")
_cte("dim_company_list", _first(S.COMPANY, "company_list"))

for _d in S.ORDER_DIMENSIONS:
    _oracle(
        f"scd2_{_d.name.removeprefix('dim_')}_initial", f"select * from {_d.name}_all"
    )
_oracle("scd2_product_changed", "select * from dim_product_two")
_version_load("product_back", "dim_product_two", S.PRODUCT, "staged_late", LOAD_3)
_oracle("scd2_product_reverted", "select * from product_back")
_version_load(
    "product_back_open", "dim_product_two", S.PRODUCT, "staged_late", LOAD_3, "end_date is null"
)
_oracle("scd2_product_reverted_current", "select * from product_back_open")

_cte(
    "keyless",
    """select case when p_type <> 'PROMO' then p_partkey end as product_id,
       p_name as product_name from part""",
)
_cte("keyless_again", "select product_id, product_name || ' v2' as product_name from keyless")
_cte("product_keyless", _first(S.PRODUCT, "keyless"))
_version_load("product_keyless_two", "product_keyless", S.PRODUCT, "keyless_again", LOAD_2)
_oracle("scd2_null_key", "select * from product_keyless_two")

_cte(
    "two_names",
    f"""select product_id, order_date, case when order_date >= TIMESTAMP '{CUTOVER}'
        then product_name || ' v2' else product_name end as product_name from staged_all""",
)
_oracle("scd2_two_variants", f"select * from ({_first(S.PRODUCT, 'two_names')})")
_cte(
    "newest_name",
    """select product_id, product_name from (select *, row_number() over (
       partition by product_id order by order_date desc, product_name desc) as rn from two_names)
       where rn = 1""",
)
_oracle("scd2_latest_variant", f"select * from ({_first(S.PRODUCT, 'newest_name')})")

_cte("first_logs", f"select * from staged_logs where time < TIMESTAMP '{MID_JANUARY}'")
for _d in S.LOG_DIMENSIONS:
    _n = _d.name.removeprefix("dim_")
    _cols = ", ".join(_d.members)
    _cte(f"{_n}_first", _first(_d, "first_logs"))
    if _d.null_mode == "except":
        _new = f"select {_cols} from staged_logs except select {_cols} from {_n}_first"
    else:
        _new = f"""select distinct s.{_cols} from staged_logs s
            left join {_n}_first d on d.{_cols} = s.{_cols} where d.{_cols} is null"""
    _member_load(f"{_n}_second", f"{_n}_first", _d, _new, LOAD_2)
    _oracle(f"members_{_n}", f"select * from {_n}_second")
_oracle(
    "members_ipaddr_repeats", _numbered(S.IPADDR, "select ipaddr from staged_logs", LOAD_1)
)
_oracle("members_contact", "select * from dim_contact_all")
_oracle("members_status", "select * from dim_status_all")
_oracle("members_not_in_empty_dim", "select * from dim_leadsource_all")

_NOT_IN = """select distinct lead_source from staged_leads
    where lead_source not in (select lead_source from {dim})"""
_EXCEPT = "select lead_source from staged_leads except select lead_source from {dim}"
_ANTIJOIN = """select distinct s.lead_source from staged_leads s
    left join {dim} d on d.lead_source = s.lead_source where d.lead_source is null"""
for _name, _known, _rule in [
    ("members_leadsource", "lead_source < '3'", _NOT_IN),
    ("members_leadsource_except", "lead_source < '3'", _EXCEPT),
    ("members_leadsource_antijoin", "lead_source is null", _ANTIJOIN),
    ("members_not_in_null_dim", "lead_source is null or lead_source < '3'", _NOT_IN),
]:
    _cte(f"{_name}_known", f"select * from staged_leads where {_known}")
    _cte(f"{_name}_dim", _first(S.LEADSOURCE, f"{_name}_known"))
    _member_load(
        f"{_name}_next", f"{_name}_dim", S.LEADSOURCE, _rule.format(dim=f"{_name}_dim"), LOAD_2
    )
    _oracle(_name, f"select * from {_name}_next")
_oracle(
    "fresh_lead_copies",
    """select lead_source, count(*) as copies from staged_leads s where not exists (
       select 1 from staged_leads k where k.status = 'F' and k.lead_source < '3'
       and k.lead_source is not distinct from s.lead_source) group by lead_source""",
)
_oracle(
    "assign_customer_keys",
    """select 100 + row_number() over (order by c_mktsegment, c_custkey) as sk, c_mktsegment,
       c_custkey from customer""",
)

# --- extraction -------------------------------------------------------------------------------

_oracle("extract_orders_full", "select * from staged_all")
_oracle("extract_orders_spread", "select * from staged_all")
_HIGH = f"(select max(o_orderdate) from orders where o_orderdate < TIMESTAMP '{CUTOVER}')"
_oracle("extract_orders_incremental", _extract(f"order_date > {_HIGH}"))
_oracle("extract_orders_lookback", _extract(f"order_date > {_HIGH} - interval 30 day"))
_oracle("extract_orders_range", _extract(f"order_date {_IN_PERIOD}"))
_oracle("extract_orders_match_company", _extract(match=True))

_oracle(
    "extract_orders_rejects",
    """select * from (select order_id, order_date, CUIT, customer_id, suppliers_catalog_id,
       case when CUIT % 5 = 0 then 'company' when customer_id % 7 = 0 then 'customer'
       when suppliers_catalog_id % 11 = 0 then 'item'
       when (select max(supplier_id) from b2b_items i
        where i.suppliers_catalog_id = o.suppliers_catalog_id) % 3 = 0 then 'supplier'
       when (select max(product_id) from b2b_items i
        where i.suppliers_catalog_id = o.suppliers_catalog_id) % 4 = 0 then 'product' end as missing
       from b2b_orders o) where missing is not null""",
)

# --- facts ------------------------------------------------------------------------------------


def _order_fact(staged: str, suffix: str, company: str = "company_name") -> str:
    return f"""select c.sk_company, k.sk_customer, s.sk_supplier, p.sk_product,
        o.order_price as price, o.order_date from {staged} o
        join dim_company_{suffix} c on c.{company} = o.{company} and c.end_date is null
        join dim_customer_{suffix} k on k.customer_id = o.customer_id and k.end_date is null
        join dim_supplier_{suffix} s on s.supplier_id = o.supplier_id and s.end_date is null
        join dim_product_{suffix} p on p.product_id = o.product_id and p.end_date is null"""


def _log_fact(customers: str) -> str:
    return f"""select i.sk_ipaddr, c.sk_country, d.sk_device, k.sk_customer, l.time
        from staged_logs l
        join dim_ipaddr_all i on i.ipaddr = l.ipaddr
        join {customers} k on k.username = l.username and k.end_date is null
        join dim_country_all c on c.country_name = l.country_name
        join dim_device_all d on d.device = l.device and d.is_mobile = l.is_mobile
         and d.is_pc = l.is_pc and d.is_tablet = l.is_tablet"""


def _lead_fact(companies: str) -> str:
    return f"""select l.contact_date, co.sk_company, c.sk_contact, s.sk_leadsource, t.sk_status
        from staged_leads l
        join {companies} co on co.company_name = l.company_name and co.end_date is null
        join dim_contact_all c on c.contact_name = l.contact_name
        join dim_leadsource_all s on s.lead_source = l.lead_source
        join dim_status_all t on t.status = l.status"""


def _lead_rejects(companies: str) -> str:
    return f"""select * from (select l.*, case
        when company_name is null or company_name not in
         (select company_name from {companies} where end_date is null) then 'company'
        when lead_source is null then 'leadsource' when status is null then 'status'
        when contact_name is null then 'contact' end as missing from staged_leads l)
        where missing is not null"""


_cte("fact_all", _order_fact("staged_all", "all"))
_oracle("fact_orders", "select * from fact_all")
_oracle("fact_orders_spread", "select * from fact_all")
_NO_PLACE = """select *, case when supplier_id % 10 = 3 then 'supplier' else 'product' end as missing
    from staged_all where supplier_id % 10 = 3 or product_id % 9 = 4"""
_oracle("fact_orders_rejects", _NO_PLACE)
_oracle("fact_orders_on_cuit", _order_fact("staged_all", "all", "CUIT"))
_cte("product_since_1950", _first(S.PRODUCT, "staged_all", "1950-01-01 00:00:00"))
_cte("renamed_list", "select product_id, name as product_name from b2b_renamed")
_version_load("product_at_cutover", "product_since_1950", S.PRODUCT, "renamed_list", CUTOVER)
_oracle(
    "fact_orders_as_of",
    """select p.sk_product, o.order_price as price, o.order_date from staged_all o
       join product_at_cutover p on p.product_id = o.product_id and o.order_date >= p.start_date
       and (p.end_date is null or o.order_date < p.end_date)""",
)
_cte("logs_fact", _log_fact("dim_customer_list"))
_cte("logs_fact_of_buyers", _log_fact("dim_customer_all"))
_oracle("fact_logs", "select * from logs_fact")
_oracle(
    "fact_logs_rejects",
    """select l.*, 'customer' as missing from staged_logs l
       where username not in (select username from dim_customer_list)""",
)
_oracle("fact_leads", _lead_fact("dim_company_list"))
_SQL["fact_leads_ignoring_case"] = _SQL["fact_leads"]
_oracle(
    "fact_leads_many_cases",
    f"select contact_date, count(*) as n from ({_lead_fact('dim_company_list')}) group by 1",
)
_oracle("fact_leads_rejects", _lead_rejects("dim_company_list"))
_oracle(
    "reprocess_orders_period",
    f"""select * from fact_all where not (order_date {_IN_PERIOD})
        union all {_order_fact("staged_period", "all")}""",
)

# --- web logs ---------------------------------------------------------------------------------

_oracle("weblog_lines", "select value from log_lines")
_oracle("text_roundtrip", "select value from log_lines")
_oracle("parse_weblogs_wall", "select * from parsed")
_oracle(
    "parse_weblogs_utc",
    """select ipaddr, username, time + interval 7 hour as time, request from parsed
       where time is not null""",
)
_oracle("parse_weblogs_quarantine", "select value from parsed where time is null")
_oracle(
    "parse_weblogs_sentinel",
    """select ipaddr, username, coalesce(time, TIMESTAMP '1950-01-01 00:00:00') as time
       from parsed""",
)
_oracle(
    "classify_user_agents", "select useragent, device, is_mobile, is_pc, is_tablet from described"
)
_oracle(
    "enrich_country_of_ip",
    "select ipaddr, username, time, country_name from parsed left join geo on ip = ipaddr",
)
_oracle("stage_weblogs", "select * from staged_logs")


def _pick(n: str, *parts: str) -> str:
    return f"cast('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 15) as bigint) % {n}"


_cte(
    "country_numbers",
    "select n_name as country_name, row_number() over (order by n_name) - 1 as idx from nation",
)


def _country_no(seed: str) -> str:
    return _pick("(select count(distinct n_name) from nation)", seed, "ipaddr")


_oracle(
    "assign_country_of_ip",
    f"""select ipaddr, time, country_name from parsed
        join country_numbers on idx = {_country_no("7")}""",
)
_oracle(
    "stage_weblogs_assigned",
    f"""select ipaddr, username, time, country_name, device, is_mobile, is_pc, is_tablet
        from described join country_numbers on idx = {_country_no("0")}
        where time is not null""",
)
_cte(
    "drawn",
    f"""select {_pick(str(223 << 24), "11", "'ip'", "id")} as ip,
        {_pick("(select count(*) from customer)", "11", "'user'", "id")} as user_no,
        {_pick("31535999", "11", "'second'", "id")} as sec,
        {_pick(str(len(AGENTS)), "11", "'agent'", "id")} as agent_no
        from (select unnest(range((select count(*) from events))) as id)""",
)
_cte(
    "agent_numbers",
    f"""select agent, row_number() over (order by agent) - 1 as no
        from (select unnest({_AGENT_ARRAY}) as agent)""",
)
_cte(
    "user_numbers",
    """select username, row_number() over (order by customer_id) - 1 as no
       from b2b_customers""",
)
_oracle(
    "synth_weblog_lines",
    """select concat((ip >> 24) + 1, '.', (ip >> 16) & 255, '.', (ip >> 8) & 255, '.', ip & 255,
       ' - ', username, ' [',
       strftime(TIMESTAMP '2021-01-01' + to_seconds(sec), '%d/%b/%Y:%H:%M:%S'),
       ' -0700] "GET /favicon.ico HTTP/1.1" 404 209 "http://www.example.com/start.html" "',
       agent, '"') as value
       from drawn join user_numbers u on u.no = user_no join agent_numbers a on a.no = agent_no""",
)
_oracle(
    "spreadsheet_ingest",
    "select *, strftime(contact_date, '%Y/%m') as folder from staged_leads",
)

# --- reports ----------------------------------------------------------------------------------

_MONTHLY = f"""select cast(month(order_date) as int) as month, cast(year(order_date) as int)
    as year, cast(sum(price) as decimal(28,2)) as sum_of_sales from {{fact}}
    where year(order_date) = {YEAR} group by 1, 2 order by 1 limit 12"""
_oracle(
    "sales_by_month",
    f"select * from ({_MONTHLY.format(fact='(select order_price as price, * from staged_all)')})",
)
_oracle(
    "sales_by_month_window",
    f"""select cast(m as int) as month, cast({YEAR} as int) as year,
        cast(sum(order_price) as decimal(28,2)) as sum_of_sales
        from (select extract(month from order_date) as m, order_price from staged_all
        where order_date >= DATE '{YEAR}-01-01' and order_date < DATE '{YEAR + 1}-01-01')
        group by m""",
)


def _top_devices(fact: str) -> str:
    return f"""select device, is_mobile, is_pc, is_tablet, count(*) as log_count
        from {fact} f join dim_device_all d on d.sk_device = f.sk_device and d.end_date is null
        group by device, is_mobile, is_pc, is_tablet
        order by log_count desc, device, is_mobile, is_pc, is_tablet limit 5"""


def _top_products(sold: str, seen: str, products: str, buyer: str = "sk_customer") -> str:
    """What buyers seen in the most seen country bought, counted per product."""
    top = f"""(select sk_country from {seen} group by sk_country
        order by count(*) desc, sk_country limit 1)"""
    counts = f"""select sk_product, count(*) as amount_sold from {sold}
        where {buyer} in (select {buyer} from {seen} where sk_country = {top})
        group by sk_product"""
    names = f"select sk_product, product_name from {products} where end_date is null"
    return f"""select product_name,
        (select country_name from dim_country_all where sk_country = {top}) as country_name,
        amount_sold from ({counts}) join ({names}) using (sk_product)
        order by amount_sold desc, product_name, sk_product limit 100"""


_oracle("top_devices", _top_devices("logs_fact"))
_oracle(
    "top_products_of_top_country",
    _top_products("fact_all", "logs_fact_of_buyers", "dim_product_all"),
)
_cte(
    "sold_by_buyer",
    "select customer_id, f.* from fact_all f join dim_customer_all using (sk_customer)",
)
_cte(
    "seen_by_buyer",
    "select customer_id, f.* from logs_fact_of_buyers f join dim_customer_all using (sk_customer)",
)
_oracle(
    "top_products_by_customer",
    _top_products("sold_by_buyer", "seen_by_buyer", "dim_product_all", "customer_id"),
)

# --- pipelines --------------------------------------------------------------------------------

_cte(
    "fact_two",
    f"{_order_fact('staged_early', 'early')} union all "
    f"{_order_fact('staged_late_renamed', 'two')}",
)
_oracle("pipeline_orders", "select * from fact_two")
_oracle("pipeline_orders_rejects", _NO_PLACE)
_oracle(
    "pipeline_orders_lookback",
    """select strftime(order_date, '%Y-%m') as month, count(*) as n,
       cast(sum(order_price) as decimal(28,2)) as amount from staged_all group by 1""",
)
_COMES, _MOVED, _GOES = (f"month = '{m}'" for m in DRIFT_MONTHS)
_oracle(
    "pipeline_reconcile",
    f"""select month, n, n_moved, amount, case when drifted then n end as n_source,
        case when drifted then
         case when {_COMES} then n - hits when {_GOES} then n + hits else n end end as n_loaded,
        false as differs
        from (select *, hits > 0 and ({_COMES} or {_MOVED} or {_GOES}) as drifted from
         (select strftime(order_date, '%Y-%m') as month, count(*) as n,
          count(*) filter (hour(order_date) <> 0) as n_moved,
          cast(sum(order_price) as decimal(28,2)) as amount,
          count(*) filter (order_id % 3 = 0) as hits from staged_all group by 1))""",
)
_oracle("pipeline_orders_dim", "select * from dim_product_two")
_SQL["fact_orders_as_of_spread"] = _SQL["fact_orders_as_of"]
_oracle(
    "fact_orders_as_of_rejects",
    f"""select *, case when CUIT % 2 = 0 and order_date >= TIMESTAMP '{PERIOD[0]}' then 'company'
            else 'product' end as missing from staged_all
        where (CUIT % 2 = 0 and order_date >= TIMESTAMP '{PERIOD[0]}') or product_id % 3 <> 0
           or order_date < TIMESTAMP '{CUTOVER}'""",
)
_BIRTH = "1950-01-01 00:00:00"
for _d in S.ORDER_DIMENSIONS:
    _cte(f"{_d.name}_born", _first(_d, "staged_early", _BIRTH))
    _version_load(f"{_d.name}_cut", f"{_d.name}_born", _d, "staged_late_renamed", CUTOVER)


def _fact_as_of(staged: str) -> str:
    joins = " ".join(
        f"""join {d.name}_cut {d.name} on {d.name}.{col} = o.{col} and o.order_date >= {d.name}.start_date
            and ({d.name}.end_date is null or o.order_date < {d.name}.end_date)"""
        for d, col in zip(S.ORDER_DIMENSIONS, ("company_name", "customer_id", "supplier_id", "product_id"))
    )
    return f"""select sk_company, sk_customer, sk_supplier, sk_product, order_price as price, order_date
        from {staged} o {joins}"""


_oracle(
    "pipeline_orders_as_of",
    f"{_fact_as_of('staged_early')} union all {_fact_as_of('staged_late_renamed')}",
)
_cte(
    "part_list",
    "select p_partkey as product_id, p_name as product_name from part where p_partkey % 5 <> 3",
)
_cte(
    "part_batch",
    "select p_partkey as product_id, p_name || ' v2' as product_name from part where p_partkey % 150 = 8",
)
_cte("part_first", _first(S.PRODUCT, "part_list"))
_version_load("part_second", "part_first", S.PRODUCT, "part_batch", LOAD_2)
_oracle("dimension_small_batch", "select * from part_second")
_SQL["members_by_slice_ipaddr"] = _SQL["members_ipaddr"]
_SQL["members_by_slice_leadsource"] = _SQL["members_leadsource"]
_SQL["members_by_slice_null_dim"] = _SQL["members_not_in_null_dim"]
_SQL["pipeline_reprocess"] = _SQL["reprocess_orders_period"]
_oracle("pipeline_logs", "select * from logs_fact_of_buyers")
_SQL["inbox_ingest"] = _SQL["pipeline_logs"]
_oracle(
    "pipeline_logs_rejects",
    """select l.*, 'customer' as missing from staged_logs l
       where username not in (select username from dim_customer_all)""",
)
_SQL["pipeline_logs_quarantine"] = _SQL["parse_weblogs_quarantine"]
_oracle(
    "inbox_ingest_batches",
    """select 'fact' as kind, cast(cast(time as date) as varchar) as day, count(*) as n
       from logs_fact_of_buyers group by 2
       union all select 'reject ' || 'customer', cast(cast(time as date) as varchar), count(*)
       from staged_logs where username not in (select username from dim_customer_all) group by 2
       union all select 'unreadable', value, count(*) from parsed where time is null group by 2""",
)
_oracle(
    "inbox_same_name",
    """select ipaddr, country_name, count(*) as n from logs_fact_of_buyers
       join dim_ipaddr_all using (sk_ipaddr) join dim_country_all using (sk_country) group by 1, 2""",
)
_oracle("pipeline_leads", _lead_fact("dim_company_all"))
_oracle("pipeline_leads_rejects", _lead_rejects("dim_company_all"))
_cte("logs_fact_two", _log_fact("dim_customer_two"))
_oracle(
    "report_views",
    f"""select 'sales' as report, cast(month as varchar) as item,
        cast(sum_of_sales as varchar) as amount from ({_MONTHLY.format(fact="fact_two")})
        union all select 'device', device, cast(log_count as varchar)
        from ({_top_devices("logs_fact_two")})
        union all select 'product', product_name, cast(amount_sold as varchar)
        from ({_top_products("fact_two", "logs_fact_two", "dim_product_two")})""",
)
_SQL["stage_weblogs_repeated_geo"] = _SQL["stage_weblogs"]
