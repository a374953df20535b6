"""SQL counterparts of the registered queries, on the same tables.

Quotients are rounded half up in integer arithmetic, which is exact where a double is not.
"""

from __future__ import annotations

import re

from lakestead.registry.frames import MIN_ORDERS, MIN_YEAR, SEGMENTS
from lakestead.sources.adapters import CUSTOMER_DOCUMENT

ORACLE: dict[str, str] = {}

# ---- building blocks ------------------------------------------------------------------------
VIEWS: dict[str, str] = {}


def sql(final: str) -> str:
    """Prefix a statement with the views it uses, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                needed.append(name)

    visit(final)
    # A view's own text is visited before it is appended, so definitions come first.
    parts = ",\n".join(f"{n} as ({VIEWS[n]})" for n in needed)
    return f"with {parts}\n{final}" if parts else final


def quotient(num: str, den: str, scale: int, precision: int = 18) -> str:
    """Non-negative integers num / den, rounded half up to ``scale`` digits."""
    unit = f"cast(1{'.' if scale else ''}{'0' * scale} as decimal({scale + 1},{scale}))"
    if scale:
        unit = f"cast(0.{'0' * (scale - 1)}1 as decimal({scale + 1},{scale}))"
    n, d = f"cast({num} as hugeint)", f"nullif(cast({den} as hugeint), 0)"
    whole = f"(2 * {n} * {10**scale} + {d}) // (2 * {d})"
    return f"cast(cast({whole} as decimal(30,0)) * {unit} as decimal({precision},{scale}))"


def cents(e: str) -> str:
    return f"cast({e} * 100 as hugeint)"


def average(e: str, scale: int = 2, precision: int = 12) -> str:
    """Mean of a money column with two digits."""
    return quotient(f"sum({cents(e)})", f"count({e}) * 100", scale, precision)


def percentage(num: str, den: str, scale: int = 2, precision: int = 12) -> str:
    return quotient(f"100 * cast({num} as hugeint)", den, scale, precision)


def segment(value: str) -> str:
    cases = " ".join(f"when {value} < {bound} then '{name}'" for name, bound in SEGMENTS)
    return f"case {cases} else 'Platinum' end"


PLACES = "join nation on {k} = n_nationkey join region on n_regionkey = r_regionkey"

VIEWS["src_customers"] = f"""
select c_custkey as raw_id,
 case when c_custkey % 19 = 0 then '' else 'C' || repeat('0', 8 - length(c_custkey::varchar)) || c_custkey::varchar end as customer_id,
 case when c_custkey % 23 = 0 then '' else c_name end as customer_unique_id,
 case when c_custkey % 13 = 0 then '123' else lpad((c_custkey % 100000)::varchar, 5, '0') end as customer_zip_code_prefix,
 case when c_custkey % 11 = 0 then '' when c_custkey % 7 = 0 then '  ' || n_name || ' ' else n_name end as customer_city,
 case when c_custkey % 17 = 0 then '' else lower(substr(r_name, 1, 2)) end as customer_state
from customer {PLACES.format(k="c_nationkey")}"""

VIEWS["src_sellers"] = f"""
select s_suppkey as raw_id, 'S' || repeat('0', 8 - length(s_suppkey::varchar)) || s_suppkey::varchar as seller_id,
 case when s_suppkey % 13 = 0 then '123' else lpad((s_suppkey % 100000)::varchar, 5, '0') end as seller_zip_code_prefix,
 case when s_suppkey % 11 = 0 then '' else n_name end as seller_city,
 case when s_suppkey % 11 = 0 or s_suppkey % 17 = 0 then '' else lower(substr(r_name, 1, 2)) end as seller_state
from supplier {PLACES.format(k="s_nationkey")}"""

VIEWS["src_orders"] = """
select o_orderkey as raw_id, 'O' || repeat('0', 9 - length(o_orderkey::varchar)) || o_orderkey::varchar as order_id,
 case when o_orderkey % 29 = 0 then '' else 'C' || repeat('0', 8 - length(o_custkey::varchar)) || o_custkey::varchar end as customer_id,
 case when o_orderkey % 31 = 0 then 'Invoiced' when o_orderstatus = 'F' then 'Delivered'
      when o_orderstatus = 'O' then 'shipped' else 'pending' end as order_status,
 case when o_orderkey % 37 <> 0 then o_orderdate end as order_purchase_timestamp,
 case when o_orderstatus = 'F' then s.last_ship end as order_delivered_customer_date,
 o_orderdate + interval '1' day * (700 + cast(o_orderkey % 61 as int)) as order_estimated_delivery_date
from orders left join (select l_orderkey, max(l_shipdate) as last_ship from lineitem group by l_orderkey) s
  on s.l_orderkey = o_orderkey"""

VIEWS["src_items"] = """
select l_orderkey * 8 + l_linenumber as raw_id, 'O' || repeat('0', 9 - length(l_orderkey::varchar)) || l_orderkey::varchar as order_id,
 'P' || repeat('0', 8 - length(l_partkey::varchar)) || l_partkey::varchar as product_id, 'S' || repeat('0', 8 - length(l_suppkey::varchar)) || l_suppkey::varchar as seller_id,
 l_shipdate as shipping_limit_date, l_extendedprice::decimal(12,2) as price,
 cast(l_extendedprice::decimal(12,2) * l_tax::decimal(4,2) as decimal(12,2)) as freight_value
from lineitem"""

VIEWS["src_products"] = """
select p_partkey as raw_id, 'P' || repeat('0', 8 - length(p_partkey::varchar)) || p_partkey::varchar as product_id,
 case when p_partkey % 9 = 0 then '' else lower(p_type) end as product_category_name,
 length(p_name) as name_length, length(p_name) + length(p_brand) as description_length, p_size % 5 as photos
from part"""

VIEWS["src_geo"] = f"""
select c_custkey as raw_id,
 case when c_custkey % 13 = 0 then '123' else lpad((c_custkey % 100000)::varchar, 5, '0') end as zip,
 case when c_custkey % 21 <> 0 then cast(c_nationkey * 3.25 - 40.5 as decimal(10,6)) end as lat,
 case when c_custkey % 22 <> 0 then cast(c_nationkey * -2.5 + 10.125 as decimal(10,6)) end as lng,
 n_name as city, upper(substr(r_name, 1, 2)) as state
from customer {PLACES.format(k="c_nationkey")}"""


def scored(select: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    """Clean with ``select``, then subtract the penalty of every failed rule."""
    total = " + ".join(f"case when {bad} then {cost} else 0.00 end" for bad, cost, _ in rules)
    notes = ", ".join(f"case when {bad} then {note} end" for bad, _, note in rules)
    return f"""
select *, cast(greatest(0.00, 1.00 - penalty) as decimal(3,2)) as data_quality_score,
 1.00 - penalty > 0.50 as is_valid, nullif(concat_ws('; ', {notes}), '') as validation_notes
from (select *, cast({total} as decimal(5,2)) as penalty from (select raw_id as source_raw_id, {select} from {source}) c) p"""


def customer_rules(select: str, source: str) -> str:
    return scored(
        select,
        source,
        [
            ("customer_id = ''", "0.30", "'Missing customer_id'"),
            ("customer_unique_id = ''", "0.20", "'Missing customer_unique_id'"),
            ("length(customer_zip_code_prefix) < 5", "0.15", "'Invalid zip code'"),
            ("customer_city = ''", "0.20", "'Missing city'"),
            ("length(customer_state) <> 2", "0.15", "'Invalid state code'"),
        ],
    )


def seller_rules(select: str, source: str) -> str:
    return scored(
        select,
        source,
        [
            ("seller_id = ''", "0.30", "'Missing seller_id'"),
            ("length(seller_zip_code_prefix) < 5", "0.20", "'Invalid zip code'"),
            ("seller_city = ''", "0.20", "'Missing city'"),
            ("length(seller_state) <> 2", "0.15", "'Invalid state code'"),
        ],
    )


VIEWS["prc_customers"] = customer_rules(
    "customer_id, customer_unique_id, customer_zip_code_prefix, trim(customer_city) as customer_city,"
    " upper(customer_state) as customer_state",
    "src_customers",
)
VIEWS["prc_sellers"] = seller_rules(
    "seller_id, seller_zip_code_prefix, seller_city, upper(seller_state) as seller_state", "src_sellers"
)


def none(c: str) -> str:
    return f"coalesce(nullif({c}, ''), 'None')"


VIEWS["prc_customers_none"] = customer_rules(
    ", ".join(
        [f"{none(c)} as {c}" for c in ("customer_id", "customer_unique_id", "customer_zip_code_prefix")]
        + [
            f"trim({none('customer_city')}) as customer_city",
            f"upper({none('customer_state')}) as customer_state",
        ]
    ),
    "src_customers",
)
VIEWS["prc_customers_zip_int"] = customer_rules(
    "customer_id, customer_unique_id, cast(cast(customer_zip_code_prefix as int) as varchar) as customer_zip_code_prefix,"
    " trim(customer_city) as customer_city, upper(customer_state) as customer_state",
    "src_customers",
)
VIEWS["prc_sellers_none"] = seller_rules(
    "seller_id, seller_zip_code_prefix,"
    f" {none('seller_city')} as seller_city, upper({none('seller_state')}) as seller_state",
    "src_sellers",
)
VIEWS["prc_orders"] = scored(
    "order_id, customer_id, lower(order_status) as order_status, order_purchase_timestamp,"
    " null::timestamp as order_approved_at, null::timestamp as order_delivered_carrier_date,"
    " order_delivered_customer_date, order_estimated_delivery_date",
    "src_orders",
    [
        ("order_id = ''", "0.30", "'Missing order_id'"),
        ("customer_id = ''", "0.30", "'Missing customer_id'"),
        (
            "order_status not in ('pending', 'processing', 'shipped', 'delivered', 'canceled')",
            "0.20",
            "'Invalid order_status: ' || order_status",
        ),
        ("order_purchase_timestamp is null", "0.20", "'Missing purchase timestamp'"),
    ],
)
PRODUCT_RULES = [
    ("product_id = ''", "0.30", "'Missing product_id'"),
    ("product_category_name = ''", "0.20", "'Missing category name'"),
]
VIEWS["prc_products"] = scored(
    "product_id, product_category_name, name_length::int as product_name_length,"
    " description_length::int as product_description_length, photos::int as product_photos_qty",
    "src_products",
    PRODUCT_RULES,
)
VIEWS["prc_products_digits"] = scored(
    "product_id, product_category_name, length(name_length::varchar)::int as product_name_length,"
    " length(description_length::varchar)::int as product_description_length, photos::int as product_photos_qty",
    "src_products",
    PRODUCT_RULES,
)
VIEWS["prc_geolocations"] = scored(
    "zip as geolocation_zip_code_prefix, lat as geolocation_latitude, lng as geolocation_longitude,"
    " city as geolocation_city, state as geolocation_state",
    "src_geo",
    [
        ("length(geolocation_zip_code_prefix) < 5", "0.30", "'Invalid zip code'"),
        (
            "geolocation_latitude is null or geolocation_longitude is null",
            "0.30",
            "'Missing latitude or longitude'",
        ),
    ],
)
VIEWS["prc_order_items"] = """
select raw_id as source_raw_id, order_id, product_id, seller_id, shipping_limit_date,
 nullif(price, 0)::decimal(10,2) as price, nullif(freight_value, 0)::decimal(10,2) as freight_value,
 1.00::decimal(3,2) as data_quality_score, true as is_valid, null::varchar as validation_notes
from src_items"""

VIEWS["cur_orders"] = """
select order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
 order_delivered_customer_date, order_estimated_delivery_date,
 cast(date_diff('day', order_purchase_timestamp::date, order_delivered_customer_date::date) as int) as days_to_delivery,
 coalesce(order_status = 'delivered' and order_delivered_customer_date <= order_estimated_delivery_date, false) as is_on_time,
 date_trunc('month', order_purchase_timestamp)::date as purchase_month, data_quality_score, is_valid
from prc_orders where is_valid"""
VIEWS["cur_items"] = """
select source_raw_id as order_item_id, order_id, product_id, seller_id, price, freight_value,
 cast(coalesce(price, 0) + coalesce(freight_value, 0) as decimal(12,2)) as total_item_value,
 shipping_limit_date, data_quality_score
from prc_order_items where order_id is not null"""
VIEWS["cur_customers"] = """
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
 data_quality_score, is_valid
from (select *, row_number() over (partition by customer_id order by data_quality_score desc, source_raw_id) as nth
      from prc_customers where is_valid) r where nth = 1"""
VIEWS["cur_sellers"] = """
select seller_id, seller_zip_code_prefix, seller_city, seller_state, data_quality_score, is_valid
from (select *, row_number() over (partition by seller_id order by data_quality_score desc, source_raw_id) as nth
      from prc_sellers where is_valid) r where nth = 1"""

VIEWS["loc"] = """
select distinct state_code || '-' || city_name as location_key, state_code, city_name
from (select customer_state as state_code, customer_city as city_name from cur_customers
      union all select seller_state, seller_city from cur_sellers) u"""
VIEWS["prod"] = f"""
select product_id, {average("price")} as avg_price from cur_items where product_id is not null group by product_id"""
VIEWS["cal"] = """
select cast(strftime(d, '%Y%m%d') as int) as date_id, d::date as date_value, year(d)::int as year, month(d)::int as month,
 day(d)::int as day, quarter(d)::int as quarter, weekofyear(d)::int as week, strftime(d, '%a') as day_of_week,
 dayofweek(d) in (0, 6) as is_weekend, false as is_holiday
from (select unnest(generate_series(date_trunc('year', a), date_trunc('year', b) + interval 1 year - interval 1 day,
                                    interval 1 day)) as d
      from (select min(order_purchase_timestamp)::timestamp as a, max(order_purchase_timestamp)::timestamp as b
            from cur_orders) r) s"""
VIEWS["fact"] = """
select o.order_id, c.customer_id as customer_id, i.product_id, l.location_key,
 cast(strftime(o.order_purchase_timestamp, '%Y%m%d') as int) as dim_date_id,
 count(i.order_item_id)::int as quantity,
 coalesce(sum(i.price), 0)::decimal(18,2) as price_amount,
 coalesce(sum(i.freight_value), 0)::decimal(18,2) as freight_value,
 (coalesce(sum(i.price), 0) + coalesce(sum(i.freight_value), 0))::decimal(18,2) as total_order_value,
 o.order_status, o.days_to_delivery, o.is_on_time, o.order_purchase_timestamp::date as order_date,
 o.order_delivered_customer_date::date as delivery_date,
 o.order_estimated_delivery_date::date as estimated_delivery_date, o.data_quality_score,
 date_trunc('month', o.order_purchase_timestamp)::date as order_month
from cur_orders o
 left join cur_items i on i.order_id = o.order_id
 left join cur_customers c on c.customer_id = o.customer_id
 left join loc l on l.location_key = coalesce(c.customer_state, '') || '-' || coalesce(c.customer_city, '')
group by all"""

# ---- raw zone -------------------------------------------------------------------------------
CUSTOMER_JSON = """to_json({'customer_id': customer_id, 'customer_unique_id': customer_unique_id,
 'customer_zip_code_prefix': customer_zip_code_prefix, 'customer_city': customer_city,
 'customer_state': customer_state})::varchar"""

ORACLE["raw_json_ingest"] = sql(f"""
select raw_id, data, 'customers' as source_table, timestamp '2024-01-01' as loaded_at, sha256(data) as file_hash,
 'system' as created_by
from (select raw_id, {CUSTOMER_JSON} as data from src_customers) d""")
ORACLE["raw_json_null_normalise"] = """
select event_id as raw_id,
 case when microsecond(ts) % 1000000 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end as ts_text,
 case when event_id % 7 <> 0 and event_id % 11 <> 0 then value end as value, true as has_value_key, event_type
from events"""
AUDIT_ROWS = " union all ".join(
    f"select '{t}' as table_name, count(*) as n from {source}"
    for t, source in {
        "customers": "customer",
        "sellers": "supplier",
        "orders": "orders",
        "order_items": "lineitem",
        "products": "part",
        "geolocation": "customer",
    }.items()
)
ORACLE["load_audit"] = f"""
select table_name, n as total_records, timestamp '2024-01-01' as loaded_at, 'source_data.' || table_name as source_file,
 n as record_count, case when table_name = 'geolocation' then 'failed' else 'loaded' end as status
from ({AUDIT_ROWS}) a"""
ORACLE["lineage_raw"] = f"""
select count(*) as load_events, sum(n)::bigint as records, count(distinct table_name) as source_tables,
 timestamp '2024-01-01' as latest_load, 1::bigint as load_dates
from ({AUDIT_ROWS}) a where table_name <> 'geolocation'"""
ORACLE["raw_load_stats"] = """
select lower(c_mktsegment) as source_table, count(*) as record_count,
 timestamp '2024-01-01' + to_days(min(c_custkey % 3)::int) as first_record,
 timestamp '2024-01-01' + to_days(max(c_custkey % 3)::int) as last_record
from customer group by 1"""
ORACLE["raw_dedupe_hash"] = sql(f"""
select min(raw_id) as raw_id, data, sha256(data) as file_hash
from (select raw_id, {CUSTOMER_JSON} as data from src_customers
      union all select raw_id + 1000000000000, {CUSTOMER_JSON} from src_customers
      where raw_id in (select c_custkey from customer where c_mktsegment = 'BUILDING')) d
group by data""")
# A blank cell of a CSV file is read as NULL.
ORACLE["csv_roundtrip"] = sql("""
select nullif(customer_id, '') as customer_id, nullif(customer_unique_id, '') as customer_unique_id,
 customer_zip_code_prefix, nullif(customer_city, '') as customer_city, nullif(customer_state, '') as customer_state
from src_customers""")

COLUMNS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
ORACLE["table_columns"] = " union all ".join(
    f"select '{t}' as table_name, '{c.split()[0]}' as column_name, {i}::int as ordinal_position,"
    f" '{c.split()[1]}' as data_type, count(*) as n_rows, count(*) - count({c.split()[0]}) as n_nulls from {t}"
    for t, ddl in COLUMNS.items()
    for i, c in enumerate(ddl.split(", "), 1)
)

# ---- document queries -----------------------------------------------------------------------
VIEWS["docs"] = f"""
select c_custkey as raw_id, {CUSTOMER_DOCUMENT} as data, lower(c_mktsegment) as source_table,
 timestamp '2024-01-01' + to_days((c_custkey % 3)::int) as loaded_at
from customer {PLACES.format(k="c_nationkey")}"""


def text(path: str, doc: str = "data") -> str:
    return f"json_extract_string({doc}, '$.{path}')"


def exists(path: str, doc: str = "data") -> str:
    return f"coalesce(json_exists({doc}, '$.{path}'), false)"


ORACLE["json_extract_text"] = sql(
    f"select raw_id, {text('customer_id')} as customer_id, {text('city')} as city, {text('state')} as state, loaded_at from docs"
)
ORACLE["json_extract_sub"] = sql(f"""
select raw_id, json_extract(data, '$.address.tags')::varchar as tags, {text('address.tags[0]')} as first_tag,
 {text('address.nation')} as nation
from docs where {exists('address')}""")
ORACLE["json_cast"] = sql(f"""
select raw_id, try_cast({text('zip_code')} as int) as zip_code, try_cast({text('balance')} as decimal(12,2)) as balance,
 try_cast({text('customer_id')} as int) as id_as_int, try_cast({text('active')} as boolean) as active
from docs""")
ORACLE["json_filter_eq"] = sql(f"""
select count(*) filter (where {text('state')} = 'as') as in_state,
 count(*) filter (where {text('state')} = 'as' and {text('city')} = 'NATION_2') as in_state_and_city
from docs""")
ORACLE["json_filter_in"] = sql(f"""
select raw_id, {text('customer_id')} as customer_id, {text('state')} as state from docs
where {text('state')} in ('as', 'eu', 'xx')""")
ORACLE["json_like"] = sql(f"""
select raw_id, {text('customer_id')} as customer_id, {text('city')} as city from docs
where lower({text('city')}) like '%tion_1%'""")
ORACLE["json_text_search"] = sql("select raw_id, data from docs where data ilike '%building%'")
ORACLE["json_null_or_empty"] = sql(
    "select count(*) as null_records from docs where data is null or data = '{}'"
)
ORACLE["json_key_exists"] = sql(f"""
select count(*) filter (where {exists('city')}) as with_city, count(*) filter (where {exists('state')}) as with_state,
 count(*) filter (where {exists('phone_number')}) as with_phone
from docs""")
ORACLE["json_missing_key"] = sql(
    f"select raw_id, data from docs where data is not null and not {exists('city')}"
)
ORACLE["json_contains"] = sql(f"""
select raw_id, coalesce({text('state')} = 'as', false) as state_as,
 coalesce(json_type(data, '$.state') = 'NULL', false) as state_null,
 coalesce({text('active')} = 'true' and {text('address.tags[1]')} = 'ASIA', false) as active_in_asia,
 coalesce({text('zip_code')} = '7', false) as zip_7, false as zip_7_as_text, data is not null as is_object
from docs""")
ORACLE["json_path_exists"] = sql(f"""
select raw_id, coalesce(state, false) as state, coalesce(city, false) as city,
 coalesce(second_tag, false) as second_tag, coalesce(street, false) as street
from (select raw_id, {exists('state')} as state, {exists('city')} as city, {exists('address.tags[1]')} as second_tag,
       {exists('address.street')} as street from docs) e""")
ORACLE["json_keys"] = sql("select distinct unnest(json_keys(data)) as field_name from docs")
ORACLE["json_each"] = sql("""
unpivot (select raw_id, seller_id, seller_zip_code_prefix, seller_city, seller_state from src_sellers)
on seller_id, seller_zip_code_prefix, seller_city, seller_state into name key value value""")
ORACLE["json_pretty"] = sql("""
select raw_id, case when data is null then null when data = '{}' then '{}' else
 '{' || chr(10) || '    "customer_id": ' || (data->'$.customer_id') || ',' || chr(10)
 || '    "zip_code": ' || (data->'$.zip_code') || ',' || chr(10)
 || '    "balance": ' || regexp_extract(data, '"balance":([^,]*)', 1) || ',' || chr(10)
 || '    "state": ' || (data->'$.state') || ',' || chr(10)
 || coalesce('    "city": ' || (data->'$.city') || ',' || chr(10), '')
 || '    "address": {' || chr(10) || '        "nation": ' || (data->'$.address.nation') || ',' || chr(10)
 || '        "tags": [' || chr(10) || '            ' || (data->'$.address.tags[0]') || ',' || chr(10)
 || '            ' || (data->'$.address.tags[1]') || chr(10) || '        ]' || chr(10) || '    },' || chr(10)
 || '    "active": ' || (data->'$.active') || chr(10) || '}' end as pretty
from docs""")
ORACLE["json_path_query"] = sql(f"""
select raw_id, coalesce(array_to_string(tags, '|'), '') as all_tags,
 coalesce(array_to_string(list_filter(tags, lambda t: t = '"ASIA"'), '|'), '') as asia,
 case when tags[1] <> '"BUILDING"' then (data->'$.address.nation')::varchar else '' end as not_first,
 coalesce((data->'$.address.nation')::varchar, '') as anywhere,
 case when cast({text('zip_code')} as int) < 50 and ({text('active')} = 'true' or json_type(data, '$.state') = 'NULL')
  then (data->'$.customer_id')::varchar else '' end as small,
 coalesce(array_to_string(list_filter(tags, lambda t: starts_with(t, '"A')), '|'), '') as in_a
from (select *, cast(json_extract(data, '$.address.tags[*]') as varchar[]) as tags from docs) d""")


def probe(doc: str, source: str, more: str = "") -> str:
    return sql(f"""
select raw_id, {text('state', 'd')} as state, {exists('state', 'd')} as has_state, {text('zip_code', 'd')} as zip_code,
 coalesce({text('active', 'd')} = 'true', false) as is_active, {text('address.tags[1]', 'd')} as second_tag,
 coalesce(len(json_keys(d)), -1)::int as n_keys{more}
from (select raw_id, loaded_at, {doc} as d from {source}) x""")


PROCESSED_FIELD = f", {text('processed', 'd')} as processed"
ORACLE["json_set"] = probe(
    """case when data is not null then json_merge_patch(data, '{"state":"RJ"}') end""", "docs"
)
ORACLE["json_merge"] = sql(f"""
select raw_id, null::varchar as state, data is not null as has_state,
 case when data is not null then 'none' end as zip_code, coalesce({text('active')} = 'true', false) as is_active,
 {text('address.tags[1]')} as second_tag,
 (case when data is null then -1
   else len(list_distinct(list_concat(json_keys(data), ['processed', 'state', 'zip_code']))) end)::int as n_keys,
 case when data is not null then 'true' end as processed
from docs""")
ORACLE["json_merge_recent"] = probe(
    """case when loaded_at > timestamp '2024-01-03 12:00:00' - interval 1 day and data is not null
 then json_merge_patch(data, '{"processed":true}') else data end""",
    "docs",
    PROCESSED_FIELD,
)
ORACLE["json_group_count"] = sql(
    f"select {text('state')} as state, count(*) as total_customers from docs group by 1"
)
ORACLE["json_distinct_count"] = sql(f"select count(distinct {text('state')}) as number_of_states from docs")
ORACLE["json_min_max_avg"] = sql(f"""
select min(z) as min_zip, max(z) as max_zip, {quotient("sum(z)", "count(z)", 6)} as avg_zip
from (select try_cast({text('zip_code')} as int) as z from docs) v""")
ORACLE["json_order_numeric"] = sql(f"""
select raw_id, try_cast({text('zip_code')} as int) as zip_code from docs
order by zip_code desc nulls first, raw_id limit 10""")
ORACLE["json_order_text"] = sql(f"""
select raw_id, {text('customer_id')} as customer_id, {text('city')} as city from docs
order by {text('state')} nulls last, {text('city')} nulls last, raw_id limit 20""")
ORACLE["json_join"] = sql("""
select c.raw_id, c.customer_id, c.customer_city as city, o.order_id, o.order_status as status
from src_customers c join src_orders o on o.customer_id = c.customer_id where c.customer_id <> ''""")
ORACLE["json_normalised_view"] = sql("""
select raw_id, customer_id, customer_unique_id, customer_zip_code_prefix as zip_code_prefix, customer_city as city,
 customer_state as state, timestamp '2024-01-01' as ingestion_timestamp
from src_customers""")

# ---- record rules ---------------------------------------------------------------------------
for key, view in {
    "dq_customers": "prc_customers",
    "dq_orders": "prc_orders",
    "dq_products": "prc_products",
    "dq_products_compat": "prc_products_digits",
    "dq_sellers": "prc_sellers",
    "dq_geolocations": "prc_geolocations",
    "dq_customers_compat": "prc_customers_none",
    "dq_customers_zip_int": "prc_customers_zip_int",
    "dq_sellers_compat": "prc_sellers_none",
}.items():
    ORACLE[key] = sql(f"select * exclude (penalty) from {view}")
ORACLE["dq_order_items"] = sql("select * from prc_order_items")
ORACLE["dq_summary"] = sql(
    " union all ".join(
        f"""select '{t}' as table_name, count(*) as total, count(*) filter (where is_valid) as valid,
 {quotient("sum(cast(data_quality_score * 100 as hugeint))", "100 * count(*)", 3, 6)} as avg_quality,
 min(data_quality_score) as min_quality from prc_{t}"""
        for t in ("customers", "sellers", "orders", "products", "geolocations", "order_items")
    )
)
ORACLE["status_counts"] = sql(
    'select order_status, count(*) as "count" from prc_orders group by order_status'
)
ORACLE["dq_quarantine"] = sql("""
select reject_reason, count(*) as n_rows, min(raw_id) as first_raw_id
from (select raw_id, case when raw_id % 101 = 0 then 'malformed document'
       when raw_id % 103 = 0 then 'unreadable: price'
       when raw_id % 107 = 0 then 'unreadable: shipping_limit_date'
       when raw_id % 109 = 0 then 'unreadable: price' end as reject_reason from src_items
      union all
      select source_raw_id, case when length(seller_state) > 2 then 'too long: seller_state' end
      from prc_sellers_none where is_valid) r
where reject_reason is not null group by reject_reason""")

# ---- checks ---------------------------------------------------------------------------------
ORACLE["check_not_null"] = sql(
    " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as violations from src_orders"
        for c in (
            "order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_delivered_customer_date", "order_estimated_delivery_date",
        )
    )
    + " union all ".join(
        ["", *[f"select '{c}', count(*) from orders" for c in ("order_approved_at", "order_delivered_carrier_date")]]
    )
)
ORACLE["check_unique"] = """
select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1"""
ORACLE["check_fk"] = sql("""
select customer_id as key_value, count(*) as n_rows from src_orders
where customer_id not in (select customer_id from cur_customers) group by 1""")


def reference(name: str, child: str, key: str, parent: str) -> str:
    orphan = f"{key} not in (select {key} from {parent})"
    return f"""select '{name}' as reference, count(distinct {key}) as distinct_values,
 (select count(distinct {key}) from {parent}) as distinct_parents,
 count(distinct {key}) filter (where {orphan}) as orphan_values, count(*) filter (where {orphan}) as orphan_rows
from {child}"""


ORACLE["check_fk_report"] = sql(
    " union all ".join(
        [
            reference("orders.customer_id", "prc_orders", "customer_id", "prc_customers"),
            reference("order_items.order_id", "prc_order_items", "order_id", "prc_orders"),
            reference("order_items.product_id", "prc_order_items", "product_id", "prc_products"),
            reference("order_items.seller_id", "prc_order_items", "seller_id", "prc_sellers"),
        ]
    )
)
ORACLE["key_candidates"] = " union all ".join(
    f"""select '{c}' as column_name, count(*) as n_rows, count(distinct {c}) as n_distinct,
 count(*) - count({c}) as n_nulls, count(distinct {c}) = count(*) as is_candidate from orders"""
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
)

# ---- scalar helpers -------------------------------------------------------------------------
ORACLE["scalar_strings"] = sql("""
select raw_id, trim(customer_city) as stripped, nullif(upper(customer_state), '') as upper_state,
 lower(customer_city) as lower_city, length(customer_city)::int as n_chars,
 customer_state || '-' || trim(customer_city) as location_key,
 case when trim(customer_city) = '' and customer_state = '' then 'no city; no state: ' || customer_id
  when trim(customer_city) = '' then 'no city' when customer_state = '' then 'no state: ' || customer_id end as notes
from src_customers""")
ORACLE["scalar_dates"] = """
select event_id, ts::date as date_value, cast(date_diff('day', date '2023-12-25', ts::date) as int) as days,
 date_trunc('month', ts)::date as month, cast(strftime(ts, '%Y%m%d') as int) as date_id, year(ts)::int as year,
 quarter(ts)::int as quarter, weekofyear(ts)::int as week, strftime(ts, '%a') as day_of_week,
 dayofweek(ts) in (0, 6) as is_weekend, ts as ts_again
from events"""
ORACLE["scalar_math"] = f"""
select l_orderkey, l_linenumber, round(p, 1)::decimal(12,1) as rounded, nullif(t, 0) as tax_or_null,
 coalesce(nullif(t, 0), 1)::decimal(10,2) as tax_or_one, {quotient(cents("p"), cents("q"), 2, 15)} as unit_price,
 {quotient(cents("p"), "100 * cast(t * 100 as hugeint)", 2, 15)} as per_tax_point,
 least(greatest(q, 5), 40)::decimal(10,2) as clamped,
 case when p < 10000 then 'small' when p < 50000 then 'medium' else 'large' end as size
from (select l_orderkey, l_linenumber, l_quantity::decimal(10,2) as q, l_tax::decimal(10,2) as t,
       l_extendedprice::decimal(12,2) as p from lineitem) v"""

# ---- keys and references ----
REFERENCE_COLUMNS = {
    "customers": ("src_customers", ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]),
    "sellers": ("src_sellers", ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]),
    "orders": ("src_orders", ["order_id", "customer_id", "order_status"]),
    "order_items": ("src_items", ["order_id", "product_id", "seller_id"]),
    "products": ("src_products", ["product_id", "product_category_name"]),
    "geolocation": ("src_geo_source", ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"]),
}
VIEWS["src_geo_source"] = """
select zip as geolocation_zip_code_prefix, ' ' || city as geolocation_city, lower(state) as geolocation_state from src_geo"""
VIEWS["all_values"] = " union all ".join(
    f"select '{t}' as t, '{c}' as c, {c} as v from {view} where {c} <> ''"
    for t, (view, columns) in REFERENCE_COLUMNS.items()
    for c in columns
)
VIEWS["counted_values"] = "select t, c, v, count(*) as n from all_values group by t, c, v"
VIEWS["column_facts"] = "select t, c, count(*) as n_values, max(n) = 1 as is_unique from counted_values group by t, c"
ORACLE["fk_discovery"] = sql("""
select a.t as child_table, a.c as child_column, b.t as parent_table, b.c as parent_column,
 any_value(f.n_values) as n_values, count(*) as n_found
from counted_values a join counted_values b on a.v = b.v and (a.t <> b.t or a.c <> b.c)
 join column_facts f on f.t = a.t and f.c = a.c join column_facts p on p.t = b.t and p.c = b.c
where p.is_unique group by a.t, a.c, b.t, b.c having count(*) * 100 >= 90 * any_value(f.n_values)""")


def minimal_keys(tables: dict[str, list[str]]) -> str:
    """The unique columns, and the unique pairs of the others, of tables without NULLs."""
    parts = []
    for table, columns in tables.items():
        one = [f"select '{table}' as table_name, '{c}' as key_columns, count(distinct {c}) as n from {table}" for c in columns]
        two = [
            f"select '{table}', '{a},{b}', (select count(*) from (select distinct {a}, {b} from {table}))"
            for i, a in enumerate(columns)
            for b in columns[i + 1 :]
        ]
        rows = f"(select count(*) from {table})"
        parts.append(
            f"select table_name, key_columns, (1 + length(key_columns) - length(replace(key_columns, ',', '')))::int as n_columns"
            f" from ({' union all '.join(one + two)}) where n = {rows}"
        )
    found = " union all ".join(parts)
    return f"""
with found as ({found})
select * from found f where not exists (
 select 1 from found g where g.table_name = f.table_name and g.n_columns = 1 and f.n_columns = 2
  and list_contains(string_split(f.key_columns, ','), g.key_columns))"""


KEY_TABLES = {
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "conversations": ["conv_id", "turn", "role"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
}
ORACLE["composite_keys"] = minimal_keys(KEY_TABLES)

STORED = {
    ("raw", "customers_raw"): ("src_customers", 7, "load_id"),
    ("raw", "data_metadata"): ("(values (1), (2), (3), (4), (5), (6))", 7, "load_id,table_name"),
    ("curated", "orders_refined"): ("cur_orders", 14, "purchase_month"),
    ("curated", "order_items_refined"): ("cur_items", 11, "load_id"),
    ("curated", "customers_refined"): ("cur_customers", 9, ""),
    ("curated", "sellers_refined"): ("cur_sellers", 8, ""),
    ("warehouse", "dim_date"): ("cal", 10, ""),
    ("warehouse", "dim_customer"): ("cur_customers where customer_id is not null", 10, ""),
    ("warehouse", "dim_product"): ("prod", 4, ""),
    ("warehouse", "dim_location"): ("loc", 5, ""),
    ("warehouse", "dim_seller_scd"): ("cur_sellers", 11, ""),
    ("warehouse", "fct_orders"): ("fact", 17, "order_month"),
}
ORACLE["zone_tables"] = sql(
    " union all ".join(
        f"select '{zone}' as zone, '{table}' as table_name, count(*) as n_rows, {n}::int as n_columns,"
        f" '{by}' as partitioned_by from {source}"
        for (zone, table), (source, n, by) in STORED.items()
    )
)
STAR_COLUMNS = {
    "dim_customer": (
        "cur_customers where customer_id is not null",
        "dim_customer_id bigint, customer_id string, customer_unique_id string, customer_state string,"
        " customer_city string, customer_zip_code_prefix string, data_quality_score decimal(3,2), is_active boolean,"
        " created_at timestamp_ntz, updated_at timestamp_ntz",
        ["customer_id"],
        {"is_active": "true"},
    ),
    "dim_product": (
        "prod",
        "dim_product_id bigint, product_id string, avg_price decimal(12,2), is_active boolean",
        ["product_id"],
        {"is_active": "true"},
    ),
    "dim_location": (
        "loc",
        "dim_location_id bigint, location_key string, state_code string, city_name string, is_active boolean",
        ["location_key"],
        {"is_active": "true"},
    ),
    "fct_orders": (
        "fact",
        "order_id string, dim_customer_id bigint, dim_product_id bigint, dim_date_id int, dim_location_id bigint,"
        " quantity int, price_amount decimal(18,2), freight_value decimal(18,2), total_order_value decimal(18,2),"
        " order_status string, days_to_delivery int, is_on_time boolean, order_date date, delivery_date date,"
        " estimated_delivery_date date, data_quality_score decimal(3,2), order_month date",
        ["order_id"],
        {},
    ),
}
#: Where a stored column is called differently in the SQL views; constants hold no NULL.
SAME_NULLS = {
    "dim_customer_id": "customer_id", "dim_product_id": "product_id", "dim_location_id": "location_key",
    "is_active": "1", "created_at": "1", "updated_at": "1",
}


def described(table: str) -> str:
    source, columns, must, defaults = STAR_COLUMNS[table]
    parts = []
    for n, column in enumerate(re.split(r", (?![0-9])", columns), 1):
        name, kind = column.split(" ", 1)
        kind = kind.replace("decimal(", "decimal(").strip()
        default = f"'{defaults[name]}'" if name in defaults else "null::varchar"
        parts.append(
            f"select 'warehouse' as zone, '{table}' as table_name, {n}::int as ordinal_position, '{name}' as column_name,"
            f" '{kind}' as data_type, {str(name not in must).lower()} as is_nullable, {default} as column_default,"
            f" count(*) - count({SAME_NULLS.get(name, name)}) as n_nulls from {source}"
        )
    return " union all ".join(parts)


ORACLE["zone_columns"] = sql(" union all ".join(described(t) for t in STAR_COLUMNS))

# ---- curated zone ---------------------------------------------------------------------------
ORACLE["curated_orders"] = sql("select * from cur_orders")
ORACLE["curated_items"] = sql("select * from cur_items")
ORACLE["curated_customers"] = sql("select * from cur_customers")
ORACLE["curated_sellers"] = sql("select * from cur_sellers")
ORACLE["dedupe_best"] = sql("""
select customer_city, customer_id, data_quality_score, source_raw_id
from (select *, row_number() over (partition by customer_city order by data_quality_score desc, source_raw_id) as nth
      from prc_customers where is_valid) r where nth = 1""")


def metrics(table: str, view: str, values: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{table}' as table_name, '{m}' as metric, {e} as value from {view}" for m, e in values.items()
    )


ORACLE["curated_stats"] = sql(
    " union all ".join(
        [
            metrics(
                "orders",
                "cur_orders",
                {
                    "total_orders": "count(*)",
                    "unique_customers": "count(distinct customer_id)",
                    "delivered_orders": "count(*) filter (where order_status = 'delivered')",
                    "on_time_orders": "count(*) filter (where is_on_time)",
                },
            ),
            metrics(
                "order_items",
                "cur_items",
                {
                    "total_items": "count(*)",
                    "unique_orders": "count(distinct order_id)",
                    "unique_products": "count(distinct product_id)",
                    "unique_sellers": "count(distinct seller_id)",
                },
            ),
            metrics("customers", "cur_customers", {"total_customers": "count(*)"}),
            metrics("sellers", "cur_sellers", {"total_sellers": "count(*)"}),
        ]
    )
)
ORACLE["category_translate"] = sql("""
select product_id, product_category_name,
 case when product_category_name in ('', 'promo') then product_category_name
  else 'english_' || product_category_name end as product_category_name_english
from prc_products""")

# ---- warehouse ------------------------------------------------------------------------------
ORACLE["dim_date"] = sql("select * from cal")
VIEWS["dated_orders"] = """
select *, case when source_raw_id % 97 = 0 then date '0001-01-01' when source_raw_id % 101 = 0 then date '9999-12-31'
 else order_purchase_timestamp::date end as bought
from prc_orders"""
VIEWS["dated_valid"] = """
select * from dated_orders where
 data_quality_score + case when order_purchase_timestamp is null and bought is not null then 0.20 else 0 end > 0.50"""
ORACLE["calendar_range"] = sql("""
select date_trunc('year', a)::date as first_day, (date_trunc('year', b) + interval 1 year - interval 1 day)::date as last_day,
 date_diff('day', date_trunc('year', a)::date, (date_trunc('year', b) + interval 1 year)::date) as n_days,
 n_orders, rows_without_date, n_outside, first_outside
from (select min(bought) filter (where ok) as a, max(bought) filter (where ok) as b, count(*) as n_orders,
       sum(case when not ok then greatest(coalesce(n, 0), 1) else 0 end)::bigint as rows_without_date,
       count(*) filter (where not ok) as n_outside,
       min('{"order_id":"' || order_id || '","order_date":"' || case when year(bought) = 1 then '0001-01-01' else '9999-12-31' end
           || '"}') filter (where not ok) as first_outside
      from (select *, bought between date '1900-01-01' and date '2199-12-31' as ok from dated_valid) v
      left join (select order_id, count(distinct product_id) as n from cur_items group by order_id) i using (order_id)) s""")
ORACLE["dim_customer"] = sql("""
select customer_id, customer_unique_id, customer_state, customer_city, customer_zip_code_prefix, data_quality_score,
 is_valid as is_active from cur_customers where customer_id is not null""")
ORACLE["dim_location"] = sql("select *, true as is_active from loc")
ORACLE["dim_product"] = sql("select *, true as is_active from prod")
ORACLE["fct_orders"] = sql("select * from fact")
ORACLE["fct_orders_order_grain"] = sql("""
select * exclude (product_id) replace (sum(quantity)::int as quantity, sum(price_amount)::decimal(18,2) as price_amount,
 sum(freight_value)::decimal(18,2) as freight_value, sum(total_order_value)::decimal(18,2) as total_order_value)
from fact group by all""")
ORACLE["fct_orders_strict"] = sql("""
select nullif(customer_id, '') as customer_id,
 case when nullif(customer_id, '') is not null and l.state_code <> '' and l.city_name <> '' then f.location_key end as location_key,
 count(*) as n_rows, sum(total_order_value)::decimal(18,2) as value
from fact f left join loc l using (location_key) group by 1, 2""")
ORACLE["star_join"] = sql("""
select order_id, year, month, customer_state, city_name, product_id, avg_price, quantity, total_order_value
from fact f left join cal on cal.date_id = f.dim_date_id left join cur_customers c using (customer_id)
 left join prod using (product_id) left join loc using (location_key)""")
ORACLE["surrogate_keys"] = sql("""
select 'orders' as table_name, count(*) as n_rows, count(*) as n_ids, 1::bigint as min_id, count(*) as max_id,
 count(*) as n_hash_keys from cur_orders
union all select 'products', count(*), count(*), 1, count(*), count(*) from prod""")


def snapshot(day: int) -> str:
    moved = "s_nationkey"
    if day > 1:
        moved = f"(case when s_suppkey % {5 if day == 2 else 4} = 0 then (s_nationkey + 1) % 25 else s_nationkey end)"
    code = "lpad((s_suppkey % 100000)::varchar, 5, '0')"
    if day == 2:
        code = f"case when s_suppkey % 7 = 0 then '99999' else {code} end"
    known = {1: "s_acctbal >= 0", 2: "s_acctbal <= 9000", 3: "s_suppkey % 3 <> 0"}[day]
    return f"""
select 'S' || repeat('0', 8 - length(s_suppkey::varchar)) || s_suppkey::varchar as seller_id, substr(r_name, 1, 2) as seller_state,
 case when s_suppkey % { {1: 23, 2: 19, 3: 17}[day] } <> 0 then n_name end as seller_city, {code} as seller_zip_code_prefix
from supplier {PLACES.format(k=moved)} where {known}"""


VIEWS["snap1"] = snapshot(1)
VIEWS["snap2"] = snapshot(2)
VIEWS["snap3"] = snapshot(3)
VIEWS["versions1"] = """
select *, true as is_active, true as is_current, date '2024-01-01' as valid_from, null::date as valid_to,
 'Initial load' as change_reason, 'ETL' as created_by from snap1"""
VIEWS["versions2"] = """
select v.seller_id, v.seller_state, v.seller_city, v.seller_zip_code_prefix, v.is_active, not moved as is_current,
 v.valid_from, case when moved then date '2024-02-01' end as valid_to,
 case when moved then 'Location changed' else v.change_reason end as change_reason, v.created_by
from (select v.*, s.seller_id is not null and (v.seller_state is distinct from s.seller_state
             or v.seller_city is distinct from s.seller_city) as moved
      from versions1 v left join snap2 s on s.seller_id = v.seller_id) v
union all
select s.seller_id, s.seller_state, s.seller_city, s.seller_zip_code_prefix, true, true, date '2024-02-01', null,
 case when v.seller_id is null then 'Initial load' else 'Location updated' end, 'ETL'
from snap2 s left join versions1 v on v.seller_id = s.seller_id
where v.seller_id is null or v.seller_state is distinct from s.seller_state
   or v.seller_city is distinct from s.seller_city"""
# With plain comparison: a NULL city closes a version on its first day, and a move to NULL is no move.
VIEWS["plain1"] = """
select seller_id, seller_state, seller_city, seller_zip_code_prefix, true as is_active,
 seller_city is not null as is_current, date '2024-01-01' as valid_from,
 case when seller_city is null then date '2024-01-01' end as valid_to,
 case when seller_city is null then 'Location changed' else 'Initial load' end as change_reason, 'ETL' as created_by
from snap1"""
VIEWS["plain_moves"] = """
select s.*, v.seller_id is not null as known, coalesce(v.is_current, false) as had_current,
 coalesce(v.is_current and (v.seller_state <> s.seller_state or v.seller_city <> s.seller_city), false) as moved
from snap2 s left join plain1 v on v.seller_id = s.seller_id"""
VIEWS["plain2"] = """
select v.seller_id, v.seller_state, v.seller_city, v.seller_zip_code_prefix, v.is_active,
 v.is_current and not coalesce(m.moved, false) as is_current, v.valid_from,
 case when m.moved then date '2024-02-01' else v.valid_to end as valid_to,
 case when m.moved then 'Location changed' else v.change_reason end as change_reason, v.created_by
from plain1 v left join plain_moves m on m.seller_id = v.seller_id
union all
select seller_id, seller_state, seller_city, seller_zip_code_prefix, true, known or seller_city is not null,
 date '2024-02-01', case when not known and seller_city is null then date '2024-02-01' end,
 case when known then 'Location updated' when seller_city is null then 'Location changed' else 'Initial load' end, 'ETL'
from plain_moves where not known or moved or not had_current"""
ORACLE["scd2_initial"] = sql("select * from versions1")
ORACLE["scd2_apply"] = sql("select * from versions2")
ORACLE["scd2_reapply"] = sql("select * from versions2")
ORACLE["stream_scd2"] = sql("select * from versions2")
VIEWS["sightings"] = """
select *, date '2024-01-01' as valid_from from snap1 union all select *, date '2024-01-15' from snap3
union all select *, date '2024-02-01' from snap2"""
VIEWS["moves"] = """
select *, lag(valid_from) over w is null as first,
 row(seller_state, seller_city) is distinct from lag(row(seller_state, seller_city)) over w as differs
from sightings window w as (partition by seller_id order by valid_from)"""
ORACLE["scd2_late"] = sql("""
select seller_id, seller_state, seller_city, seller_zip_code_prefix, true as is_active, valid_to is null as is_current,
 valid_from, valid_to, case when valid_to is not null then 'Location changed' when first then 'Initial load'
  else 'Location updated' end as change_reason, 'ETL' as created_by
from (select *, lead(valid_from) over (partition by seller_id order by valid_from) as valid_to
      from moves where first or differs) v""")
ORACLE["scd2_compat"] = sql("select * from plain2")
ORACLE["scd2_history"] = sql("""
select seller_id, seller_state, seller_city, valid_from, valid_to, is_current, change_reason
from versions2 where seller_id = 'S00000005'""")
ORACLE["scd2_current"] = sql(
    "select seller_id, seller_state, seller_city, valid_from from versions2 where is_current"
)
ORACLE["insert_ignore"] = sql("""
select location_key, min(added_by) as added_by, any_value(city_name) as city_name
from (select customer_state || '-' || customer_city as location_key, 'customer' as added_by, customer_city as city_name
      from cur_customers union all select seller_state || '-' || seller_city, 'seller', seller_city from cur_sellers) u
group by location_key""")
ORACLE["upsert_touch"] = sql("""
select customer_id, case when data_quality_score < 1 then customer_city else customer_city || '*' end as customer_city,
 case when data_quality_score < 1 then timestamp '2024-01-01' else timestamp '2024-02-01' end as created_at,
 timestamp '2024-02-01' as updated_at
from cur_customers""")


def labelled(rows: list[tuple[str, str, str]]) -> str:
    return sql(
        " union all ".join(
            f"select '{label}' as label, cast({e} as decimal(20,2)) as value from {view}" for label, e, view in rows
        )
    )


ORACLE["warehouse_validation"] = labelled(
    [
        ("Dates", "count(*)", "cal"),
        ("Customers", "count(*)", "cur_customers"),
        ("Products", "count(*)", "prod"),
        ("Sellers (Current SCD)", "count(*)", "cur_sellers"),
        ("Seller History Records", "count(*)", "cur_sellers"),
        ("Locations", "count(*)", "loc"),
        ("Orders (Fact)", "count(*)", "fact"),
        ("Total Order Value", "coalesce(sum(total_order_value), 0)", "fact"),
    ]
)
ORACLE["lineage_counts"] = labelled(
    [
        ("Orders Refined", "count(*)", "cur_orders"),
        ("Customers Refined", "count(*)", "cur_customers"),
        ("Order Items Refined", "count(*)", "cur_items"),
        ("Sellers Refined", "count(*)", "cur_sellers"),
        ("Fact Orders", "count(*)", "fact"),
        ("Dimension Customers", "count(*)", "cur_customers"),
        ("Dimension Products", "count(*)", "prod"),
        ("Dimension Sellers (Current)", "count(*)", "cur_sellers"),
        ("Dimension Locations", "count(*)", "loc"),
    ]
)
ORACLE["warehouse_summary"] = sql(f"""
select count(distinct customer_id) as unique_customers, count(distinct product_id) as unique_products,
 count(distinct location_key) as unique_locations, count(distinct order_date) as unique_order_dates,
 sum(total_order_value)::decimal(38,2) as total_revenue, {average("total_order_value")} as avg_order_value,
 count(*) as total_orders
from fact""")
ORACLE["zone_counts"] = sql(
    " union all ".join(
        f"select '{n.split('.')[0]}' as zone, '{n.split('.')[1]}' as table_name, count(*) as n_rows from {v}"
        for n, v in {
            "raw.orders": "orders",
            "raw.order_items": "lineitem",
            "processed.orders": "prc_orders",
            "processed.order_items": "prc_order_items",
            "curated.orders": "cur_orders",
            "curated.order_items": "cur_items",
            "warehouse.fct_orders": "fact",
        }.items()
    )
)

# ---- reports --------------------------------------------------------------------------------
ON_TIME = "count(*) filter (where is_on_time)"
ORDERS = "count(distinct order_id)"
CUSTOMERS = "count(distinct customer_id)"
VALUE = "sum(total_order_value)::decimal(38,2)"
MEAN = average("total_order_value")

VIEWS["placed"] = "select f.*, l.state_code as region from fact f left join loc l using (location_key)"
ORACLE["sales_by_region_time"] = sql(f"""
select region, year, month, {ORDERS} as order_count, {VALUE} as total_sales, {MEAN} as avg_order_value,
 {CUSTOMERS} as unique_customers, {ON_TIME} as on_time_deliveries, {percentage(ON_TIME, ORDERS)} as on_time_percentage
from placed join cal on cal.date_id = placed.dim_date_id where year >= {MIN_YEAR}
group by region, year, month
order by year desc nulls first, month desc nulls first, total_sales desc nulls first, region nulls last limit 20""")
VIEWS["by_region"] = f"""
select region, {ORDERS} as total_orders, {VALUE} as total_sales, {MEAN} as avg_order_value,
 {CUSTOMERS} as unique_customers, {ON_TIME} as on_time
from placed group by region"""
ORACLE["dashboard_regional"] = sql(f"""
select region, total_orders, total_sales, avg_order_value, unique_customers,
 {percentage("on_time", "total_orders", 1)} as on_time_pct,
 {quotient(cents("total_sales"), "100 * total_orders", 2, 15)} as revenue_per_order,
 {quotient("total_orders", "unique_customers", 2, 12)} as orders_per_customer
from by_region""")
ORACLE["dashboard_regional_totals"] = sql(f"""
select sum(total_orders)::bigint as total_orders, sum(total_sales)::decimal(38,2) as total_sales,
 sum(unique_customers)::bigint as total_unique_customers,
 {quotient(cents("sum(total_sales)"), "100 * sum(total_orders)", 2, 15)} as avg_order_value
from by_region""")
VIEWS["known_regions"] = "select * exclude (on_time) from by_region where region is not null"
ORACLE["chart_regions"] = sql("select * from known_regions")
ORACLE["chart_top_regions"] = sql("""
select * from (select 'total_sales' as metric, region, total_sales::decimal(38,2) as value from known_regions
 order by total_sales desc, region limit 10) a
union all select * from (select 'total_orders' as metric, region, total_orders::decimal(38,2) as value from known_regions
 order by total_orders desc, total_sales desc, region limit 10) b""")
ORACLE["chart_region_boxstats"] = sql("""
select metric, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
 round(least(min(x) filter (where x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), q1), 6) as whisker_low,
 round(greatest(max(x) filter (where x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), q3), 6) as whisker_high,
 count(*) filter (where x not between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as n_outliers
from (select *, quantile_cont(x, 0.25) over (partition by metric) as q1, quantile_cont(x, 0.5) over (partition by metric) as median,
       quantile_cont(x, 0.75) over (partition by metric) as q3
      from (select 'Sales ($M)' as metric, total_sales::double / 1000000 as x from known_regions
            union all select 'Orders (K)', total_orders::double / 1000 from known_regions
            union all select 'Avg Order ($100)', avg_order_value::double / 100 from known_regions) v) w
group by metric, q1, median, q3""")
VIEWS["by_product"] = f"""
select product_id, avg_price, {ORDERS} as orders, sum(quantity)::bigint as total_quantity, {VALUE} as total_revenue,
 {MEAN} as avg_order_value, {CUSTOMERS} as unique_customers
from fact join prod using (product_id) group by product_id, avg_price"""
ORACLE["product_performance"] = sql(f"""
select product_id, orders, total_quantity, total_revenue, avg_order_value, avg_price::decimal(10,2) as avg_product_price,
 unique_customers, {percentage("orders", "(select count(distinct order_id) from fact)")} as pct_of_total_orders
from by_product where orders > {MIN_ORDERS} order by total_revenue desc, product_id limit 15""")


def top_list(rows: int, having: str) -> str:
    return f"""
select product_id, orders as order_count, total_quantity as units_sold, total_revenue, unique_customers,
 cast(row_number() over (order by total_revenue desc, product_id) as int) as rank
from by_product where {having} order by rank limit {rows}"""


VIEWS["top_any"] = top_list(20, "true")
VIEWS["top_sold"] = top_list(20, f"orders > {MIN_ORDERS}")
ORACLE["dashboard_product"] = sql(f"""
select *, {percentage(cents("total_revenue"), f"(select {cents('sum(total_revenue)')} from top_any)")} as pct_of_total
from top_any""")
ORACLE["chart_products"] = sql("select * exclude (rank) from top_sold")
ORACLE["chart_product_pie"] = sql(f"""
select slice, revenue, {percentage(cents("revenue"), f"(select {cents('sum(total_revenue)')} from top_sold)", 1)} as pct
from (select case when rank <= 5 then product_id else 'Rest of Portfolio' end as slice,
       sum(total_revenue)::decimal(38,2) as revenue from top_sold group by 1) s""")
ORACLE["chart_product_normalised"] = sql(f"""
select rank, product_id,
 {percentage("order_count", "(select max(order_count) from top_sold where rank <= 10)", 4)} as orders_norm,
 {percentage("unique_customers", "(select max(unique_customers) from top_sold where rank <= 10)", 4)} as customers_norm
from top_sold where rank <= 10""")

VIEWS["by_customer"] = f"""
select customer_id, {ORDERS} as order_frequency, sum(total_order_value) as ltv,
 {quotient(f"sum({cents('total_order_value')})", "100 * count(*)", 10, 24)} as avg_order_value
from fact group by customer_id"""
SEGMENT = segment("ltv")
ORACLE["customer_segments"] = sql(f"""
select {SEGMENT} as customer_segment, count(*) as segment_size, {average("ltv", 2, 18)} as avg_lifetime_value,
 sum(ltv)::decimal(38,2) as segment_total_value, {quotient("sum(order_frequency)", "count(*)", 6)} as avg_orders_per_customer,
 {quotient("sum(cast(avg_order_value * 10000000000 as hugeint))", "10000000000 * count(*)", 6)} as segment_avg_order_value
from by_customer group by 1""")
ORACLE["customer_segments_direct"] = sql(f"""
select {SEGMENT} as customer_segment, count(*) as segment_size, {average("ltv", 2, 18)} as avg_lifetime_value,
 sum(ltv)::decimal(38,2) as segment_total_value
from (select c.customer_id, sum(i.price + i.freight_value) as ltv
      from cur_customers c left join cur_orders o on o.customer_id = c.customer_id and o.is_valid
       left join cur_items i on i.order_id = o.order_id
      where c.is_valid group by c.customer_id) m
group by 1""")
VIEWS["ranked_customers"] = f"""
select *, {SEGMENT} as segment, row_number() over (partition by {SEGMENT} order by ltv) as nth,
 count(*) over (partition by {SEGMENT}) as size
from by_customer"""
VIEWS["by_segment"] = """
select segment, count(*) as customer_count, sum(ltv) as total_value, sum(order_frequency) as orders,
 sum(case when nth in ((size + 1) // 2, (size + 2) // 2) then cast(ltv * 100 as hugeint) end) as middle_sum,
 count(case when nth in ((size + 1) // 2, (size + 2) // 2) then 1 end) as middle_count
from ranked_customers group by segment"""
SHARE_CUSTOMERS = "(select sum(customer_count) from by_segment)"
SHARE_VALUE = f"(select {cents('sum(total_value)')} from by_segment)"
ORACLE["dashboard_customer"] = sql(f"""
select segment, customer_count, {quotient(cents("total_value"), "100 * customer_count", 2)} as avg_ltv,
 total_value::decimal(38,2) as total_value, {quotient("orders", "customer_count", 2, 12)} as avg_orders,
 {quotient("middle_sum", "100 * middle_count", 2)} as median_ltv,
 {percentage("customer_count", SHARE_CUSTOMERS)} as pct_customers,
 {percentage(cents("total_value"), SHARE_VALUE)} as pct_revenue
from by_segment""")
ORACLE["chart_segments"] = sql(f"""
select segment, customer_count, {quotient(cents("total_value"), "100 * customer_count", 6)} as avg_lifetime_value,
 total_value::decimal(38,2) as segment_total_value, {quotient("orders", "customer_count", 6)} as avg_orders,
 {percentage("customer_count", SHARE_CUSTOMERS, 1)} as pct_customers,
 {percentage(cents("total_value"), SHARE_VALUE, 1)} as pct_revenue
from by_segment""")

# ---- whole flows ----------------------------------------------------------------------------
ORACLE["two_loads"] = sql(
    "select customer_id, customer_city, data_quality_score, is_valid, source_raw_id from prc_customers"
)
ORACLE["raw_ids"] = "select 2 * count(*) as n_rows, 2 * count(*) as n_ids from lineitem"
ORACLE["quarantine_zones"] = sql("""
select zone, entity, reject_reason, count(*) as n_rows, count(*) as n_documents, min(raw_id) as first_raw_id
from (select 'processed' as zone, 'order_items' as entity, raw_id,
       case when raw_id % 101 = 0 then 'malformed document'
       when raw_id % 103 = 0 then 'unreadable: price'
       when raw_id % 107 = 0 then 'unreadable: shipping_limit_date'
       when raw_id % 109 = 0 then 'unreadable: price' end as reject_reason from src_items
      union all
      select 'curated', 'sellers', source_raw_id, case when length(seller_state) > 2 then 'too long: seller_state' end
      from prc_sellers_none where is_valid) r
where reject_reason is not null group by all""")
ORACLE["pipeline_csv"] = ORACLE["fct_orders"]
ORACLE["fct_incremental"] = ORACLE["fct_orders"]
ORACLE["incremental_loads"] = sql("""
select case when source_raw_id % 4 < 2 then '20240101T000000' else '20240201T000000' end as load_id,
 source_raw_id, customer_id, data_quality_score from prc_customers""")

# ---- incremental loads ----------------------------------------------------------------------
ORACLE["stream_ingest"] = "select * replace (case when event_id % 50 <> 0 then ts end as ts) from events"
ORACLE["stream_load_stats"] = """
select date_trunc('hour', ts) as hour, event_type, count(*) as n_events,
 sum(value::decimal(18,2))::decimal(18,2) as total_value, max(ts) as last_event
from events group by 1, 2"""
