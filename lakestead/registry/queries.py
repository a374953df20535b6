"""Registered queries: every operator run over the whole driver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestead.functions import documents as docs
from lakestead.functions import paths, scalars
from lakestead.operators import checks, dedupe, discovery, quality, scd2, surrogate
from lakestead.plans import (
    analytics,
    curated,
    deliver,
    lineage,
    processed,
    refresh,
    seller_history,
    warehouse,
)
from lakestead.registry.frames import (
    BETWEEN,
    DAY_1,
    DAY_2,
    LOADED_AT,
    MIN_ORDERS,
    MIN_YEAR,
    SEGMENTS,
    Frames,
)
from lakestead.schemas import schema
from lakestead.session import scratch_dir
from lakestead.sources import adapters, catalog, files, raw
from lakestead.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Frames(spark, sf_dir))
    return build


# ---- raw zone -------------------------------------------------------------------------------
@query
def raw_json_ingest(f: Frames) -> DataFrame:
    rows = raw.to_documents(f.source("customers"), "customers", LOADED_AT, "raw_id")
    return rows.select("raw_id", "data", "source_table", "loaded_at", "file_hash", "created_by")


@query
def raw_json_null_normalise(f: Frames) -> DataFrame:
    n = F.col("event_id")
    value = (
        F.when(n % 7 == 0, float("nan")).when(n % 11 == 0, float("inf")).otherwise(F.col("value"))
    )
    events = f.table("events").select(n.alias("raw_id"), "ts", value.alias("value"), "event_type")
    d = F.col("data")
    return raw.to_documents(events, "events", LOADED_AT, "raw_id").select(
        "raw_id",
        docs.field_text(d, "ts").alias("ts_text"),
        docs.field_text(d, "value").cast("double").alias("value"),
        docs.has_key(d, "value").alias("has_value_key"),
        docs.field_text(d, "event_type").alias("event_type"),
    )


def _audit(f: Frames) -> DataFrame:
    loads = [f.raw(t) for t in adapters.ENTITIES]
    rows = raw.load_audit(loads)
    failed = F.col("table_name") == "geolocation"
    return rows.withColumn("status", F.when(failed, "failed").otherwise(F.col("status")))


@query
def load_audit(f: Frames) -> DataFrame:
    return _audit(f)


@query
def raw_load_stats(f: Frames) -> DataFrame:
    return raw.load_stats(f.documents)


@query
def raw_dedupe_hash(f: Frames) -> DataFrame:
    """One market segment is delivered a second time."""
    source = f.source("customers")
    again = f.table("customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("raw_id")
    )
    copies = source.join(again, "raw_id", "left_semi").withColumn(
        "raw_id", F.col("raw_id") + 1_000_000_000_000
    )
    both = source.unionByName(copies.select(*source.columns))
    documents = raw.to_documents(both, "customers", LOADED_AT, "raw_id")
    return raw.unique_documents(documents).select("raw_id", "data", "file_hash")


@query
def csv_roundtrip(f: Frames) -> DataFrame:
    path = scratch_dir(f.spark, "csv")
    files.write_csv(f.source("customers").drop("raw_id"), f"{path}/customers.csv")
    return files.scan_csv_folder(f.spark, path, {"customers": schema("source.customers")})["customers"]


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@query
def table_columns(f: Frames) -> DataFrame:
    return catalog.table_columns({n: f.table(n) for n in TABLES})


# ---- document queries -----------------------------------------------------------------------
DOC = "data"


@query
def json_extract_text(f: Frames) -> DataFrame:
    wide = docs.fields(f.documents, DOC, ["customer_id", "city", "state"])
    return wide.select("raw_id", "customer_id", "city", "state", "loaded_at")


@query
def json_extract_sub(f: Frames) -> DataFrame:
    d = F.col(DOC)
    return f.documents.filter(docs.has_key(d, "address")).select(
        "raw_id",
        docs.sub_document(d, "$.address.tags").alias("tags"),
        docs.path_text(d, "$.address.tags[0]").alias("first_tag"),
        docs.path_text(d, "$.address.nation").alias("nation"),
    )


@query
def json_cast(f: Frames) -> DataFrame:
    d = F.col(DOC)
    return f.documents.select(
        "raw_id",
        docs.field_as(d, "zip_code", "int").alias("zip_code"),
        docs.field_as(d, "balance", "decimal(12,2)").alias("balance"),
        docs.field_as(d, "customer_id", "int").alias("id_as_int"),
        docs.field_as(d, "active", "boolean").alias("active"),
    )


@query
def json_filter_eq(f: Frames) -> DataFrame:
    d = F.col(DOC)
    state, city = docs.field_text(d, "state"), docs.field_text(d, "city")
    return f.documents.agg(
        F.count_if(state == "as").alias("in_state"),
        F.count_if((state == "as") & (city == "NATION_2")).alias("in_state_and_city"),
    )


@query
def json_filter_in(f: Frames) -> DataFrame:
    wide = docs.fields(f.documents, DOC, ["customer_id", "state"])
    return wide.filter(F.col("state").isin("as", "eu", "xx")).select("raw_id", "customer_id", "state")


@query
def json_like(f: Frames) -> DataFrame:
    wide = docs.fields(f.documents, DOC, ["customer_id", "city"])
    return wide.filter(F.lower("city").like("%tion_1%")).select("raw_id", "customer_id", "city")


@query
def json_text_search(f: Frames) -> DataFrame:
    return f.documents.filter(docs.search(F.col(DOC), "building")).select("raw_id", DOC)


@query
def json_null_or_empty(f: Frames) -> DataFrame:
    return f.documents.filter(docs.is_null_or_empty(F.col(DOC))).agg(
        F.count("*").alias("null_records")
    )


@query
def json_key_exists(f: Frames) -> DataFrame:
    d = F.col(DOC)
    return f.documents.agg(
        F.count_if(docs.has_key(d, "city")).alias("with_city"),
        F.count_if(docs.has_key(d, "state")).alias("with_state"),
        F.count_if(docs.has_key(d, "phone_number")).alias("with_phone"),
    )


@query
def json_missing_key(f: Frames) -> DataFrame:
    d = F.col(DOC)
    return f.documents.filter(d.isNotNull() & ~docs.has_key(d, "city")).select("raw_id", DOC)


@query
def json_contains(f: Frames) -> DataFrame:
    d = F.col(DOC)
    return f.documents.select(
        "raw_id",
        docs.contains(d, {"state": "as"}).alias("state_as"),
        docs.contains(d, {"state": None}).alias("state_null"),
        docs.contains(d, {"active": True, "address": {"tags": ["ASIA"]}}).alias("active_in_asia"),
        docs.contains(d, {"zip_code": 7}).alias("zip_7"),
        docs.contains(d, {"zip_code": "7"}).alias("zip_7_as_text"),
        docs.contains(d, {}).alias("is_object"),
    )


@query
def json_path_exists(f: Frames) -> DataFrame:
    d = F.col(DOC)
    return f.documents.select(
        "raw_id",
        docs.path_exists(d, "$.state").alias("state"),
        docs.path_exists(d, "$.city").alias("city"),
        docs.path_exists(d, "$.address.tags[1]").alias("second_tag"),
        docs.path_exists(d, "$.address.street").alias("street"),
    )


@query
def json_keys(f: Frames) -> DataFrame:
    return docs.distinct_keys(f.documents, DOC)


@query
def json_each(f: Frames) -> DataFrame:
    return docs.each_text(f.raw("sellers"), DOC, ["raw_id"])


@query
def json_pretty(f: Frames) -> DataFrame:
    """The whole text of nested documents."""
    return f.documents.select("raw_id", docs.pretty(F.col(DOC)).alias("pretty"))


@query
def json_path_query(f: Frames) -> DataFrame:
    """Wildcards, descent and conditions, on nested documents."""
    d = F.col(DOC)
    wanted = {
        "all_tags": "$.address.tags[*]",
        "asia": '$.address.tags[*] ? (@ == "ASIA")',
        "not_first": '$.address ? (@.tags[0] != "BUILDING").nation',
        "anywhere": "$..nation",
        "small": '$ ? (@.zip_code < 50 && (@.active == true || @.state == null)).customer_id',
        "in_a": '$.address.tags ? (@ starts with "A")',
    }
    texts = {name: F.array_join(paths.query_text(d, path), "|").alias(name) for name, path in wanted.items()}
    return f.documents.select("raw_id", *texts.values())


@query
def json_set(f: Frames) -> DataFrame:
    changed = f.documents.withColumn(DOC, docs.set_field(F.col(DOC), "state", "RJ"))
    return _probe(changed)


@query
def json_merge(f: Frames) -> DataFrame:
    changed = f.documents.withColumn(
        DOC, docs.merge(F.col(DOC), {"processed": True, "state": None, "zip_code": "none"})
    )
    return _probe(changed, "processed")


@query
def json_merge_recent(f: Frames) -> DataFrame:
    """Mark the documents of the last day before a given time."""
    as_of = scalars.moment(dt.datetime(2024, 1, 3, 12))
    recent = F.col("loaded_at") > as_of - F.expr("INTERVAL 1 DAY")
    marked = docs.merge(F.col(DOC), {"processed": True})
    changed = f.documents.withColumn(DOC, F.when(recent, marked).otherwise(F.col(DOC)))
    return _probe(changed, "processed")


def _probe(df: DataFrame, *more: str) -> DataFrame:
    """Fields that tell whether a document was changed where it should and nowhere else."""
    d = F.col(DOC)
    return df.select(
        "raw_id",
        docs.field_text(d, "state").alias("state"),
        docs.has_key(d, "state").alias("has_state"),
        docs.field_text(d, "zip_code").alias("zip_code"),
        docs.contains(d, {"active": True}).alias("is_active"),
        docs.path_text(d, "$.address.tags[1]").alias("second_tag"),
        F.coalesce(F.size(docs.keys_of(d)), F.lit(-1)).alias("n_keys"),
        *[docs.field_text(d, k).alias(k) for k in more],
    )


@query
def json_group_count(f: Frames) -> DataFrame:
    wide = docs.fields(f.documents, DOC, ["state"])
    return wide.groupBy("state").agg(F.count("*").alias("total_customers")).orderBy(
        F.desc("total_customers"), F.asc_nulls_last("state")
    )


@query
def json_distinct_count(f: Frames) -> DataFrame:
    wide = docs.fields(f.documents, DOC, ["state"])
    return wide.agg(F.count_distinct("state").alias("number_of_states"))


@query
def json_min_max_avg(f: Frames) -> DataFrame:
    zips = f.documents.select(docs.field_as(F.col(DOC), "zip_code", "int").alias("z"))
    return zips.agg(
        F.min("z").alias("min_zip"),
        F.max("z").alias("max_zip"),
        scalars.mean(F.col("z"), "decimal(18,6)").alias("avg_zip"),
    )


@query
def json_order_numeric(f: Frames) -> DataFrame:
    zips = f.documents.select("raw_id", docs.field_as(F.col(DOC), "zip_code", "int").alias("zip_code"))
    return zips.orderBy(F.desc_nulls_first("zip_code"), F.asc("raw_id")).limit(10)


@query
def json_order_text(f: Frames) -> DataFrame:
    wide = docs.fields(f.documents, DOC, ["customer_id", "city", "state"])
    order = [F.asc_nulls_last("state"), F.asc_nulls_last("city"), F.asc("raw_id")]
    return wide.orderBy(*order).limit(20).select("raw_id", "customer_id", "city")


@query
def json_join(f: Frames) -> DataFrame:
    """Customers and orders joined on the id inside their documents. A blank id is no id: as in
    raw loads, where a blank cell is a null, it matches nothing."""
    customer = docs.fields(f.raw("customers"), DOC, ["customer_id", "customer_city"])
    order = docs.fields(f.raw("orders"), DOC, ["order_id", "customer_id", "order_status"])
    named = F.col("customer_id") != ""
    return (
        customer.filter(named)
        .select("raw_id", "customer_id", F.col("customer_city").alias("city"))
        .join(
            order.filter(named).select(
                "customer_id", "order_id", F.col("order_status").alias("status")
            ),
            "customer_id",
        )
    )


@query
def json_normalised_view(f: Frames) -> DataFrame:
    wide = docs.fields(
        f.raw("customers"),
        DOC,
        [
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        ],
    )
    wide.select(
        "raw_id",
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
        F.col("loaded_at").alias("ingestion_timestamp"),
    ).createOrReplaceTempView("vw_customers_normalized")
    return f.spark.table("vw_customers_normalized")


# ---- record rules ---------------------------------------------------------------------------
def _records(df: DataFrame) -> DataFrame:
    return df.drop("processed_at", "reject_reason", "document")


@query
def dq_customers(f: Frames) -> DataFrame:
    return _records(f.scored("customers"))


@query
def dq_orders(f: Frames) -> DataFrame:
    return _records(f.scored("orders"))


@query
def dq_products(f: Frames) -> DataFrame:
    return _records(f.scored("products"))


@query
def dq_products_compat(f: Frames) -> DataFrame:
    return _records(f.scored("products", length_mode="compat"))


@query
def dq_sellers(f: Frames) -> DataFrame:
    return _records(f.scored("sellers"))


@query
def dq_geolocations(f: Frames) -> DataFrame:
    return _records(f.scored("geolocations"))


@query
def dq_order_items(f: Frames) -> DataFrame:
    return _records(f.scored("order_items"))


@query
def dq_customers_compat(f: Frames) -> DataFrame:
    """Blank cells arrive as null values and read ``None``."""
    documents = f.raw("customers", blank_as_null=True)
    return _records(processed.customers(documents, null_mode="compat"))


@query
def dq_customers_zip_int(f: Frames) -> DataFrame:
    """Zip codes that were read as numbers are short where they began with 0."""
    return _records(f.scored("customers", zip_as_int=True))


@query
def dq_sellers_compat(f: Frames) -> DataFrame:
    documents = f.raw("sellers", blank_as_null=True)
    return _records(processed.sellers(documents, null_mode="compat"))


@query
def dq_summary(f: Frames) -> DataFrame:
    return quality.quality_summary({e: f.processed(e) for e in processed.PROCESS})


@query
def status_counts(f: Frames) -> DataFrame:
    return quality.status_counts(f.processed("orders"))


def _broken_items(f: Frames) -> DataFrame:
    """Items with broken documents, unreadable numbers or dates."""
    n = F.col("raw_id")
    broken = (
        F.when(n % 101 == 0, F.concat(F.lit('{"order_id":"'), n.cast("string")))
        .when(n % 103 == 0, F.lit('{"order_id":"O1","price":"abc"}'))
        .when(n % 107 == 0, F.lit('{"order_id":"O1","shipping_limit_date":"x"}'))
        .when(n % 109 == 0, F.lit('{"order_id":"O1","price":99999999999}'))
        .otherwise(F.col("data"))
    )
    return f.raw("order_items").withColumn("data", broken)


@query
def dq_quarantine(f: Frames) -> DataFrame:
    """Broken items next to states that are too long."""
    lengthy = f.raw("sellers", blank_as_null=True)
    states = processed.accepted(processed.sellers(lengthy, null_mode="compat"))
    broken_items = processed.rejected(processed.order_items(_broken_items(f))).drop("document")
    bad = broken_items.unionByName(curated.oversized(states))
    return bad.groupBy("reject_reason").agg(
        F.count("*").alias("n_rows"), F.min("source_raw_id").alias("first_raw_id")
    )


# ---- checks ---------------------------------------------------------------------------------
@query
def check_not_null(f: Frames) -> DataFrame:
    orders = f.source("orders").drop("raw_id")
    return checks.not_null_violations(orders, orders.columns)


@query
def check_unique(f: Frames) -> DataFrame:
    return checks.duplicate_keys(f.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_fk(f: Frames) -> DataFrame:
    return checks.orphans(f.source("orders"), f.customers, "customer_id", "customer_id")


@query
def check_fk_report(f: Frames) -> DataFrame:
    """On the written processed zone, as the flow would ask."""
    orders, items = f.stored("orders"), f.stored("order_items")
    return checks.reference_report(
        {
            "orders.customer_id": (orders, "customer_id", f.stored("customers"), "customer_id"),
            "order_items.order_id": (items, "order_id", orders, "order_id"),
            "order_items.product_id": (items, "product_id", f.stored("products"), "product_id"),
            "order_items.seller_id": (items, "seller_id", f.stored("sellers"), "seller_id"),
        }
    )


@query
def key_candidates(f: Frames) -> DataFrame:
    orders = f.table("orders")
    return checks.key_candidates(orders, orders.columns)


# ---- scalar helpers -------------------------------------------------------------------------
@query
def fk_discovery(f: Frames) -> DataFrame:
    """References among the text columns of all six entities, found in the data."""
    entities = {e: f.source(e).drop("raw_id") for e in adapters.ENTITIES}
    texts = {e: [c for c, kind in df.dtypes if kind == "string"] for e, df in entities.items()}
    return discovery.references(entities, texts, percent=90)


@query
def composite_keys(f: Frames) -> DataFrame:
    tables = {t: f.table(t) for t in ("lineitem", "conversations", "nation")}
    tables["conversations"] = tables["conversations"].drop("text")
    return discovery.key_report(tables, most=2)


def _databases(f: Frames) -> dict[str, str]:
    """The written zones in the catalog."""
    names = {zone: f"lake_{zone}" for zone in ("raw", "curated", "warehouse")}
    store = f.written.store
    catalog.register(store, "raw", names["raw"], ["customers_raw", "data_metadata"])
    for zone in ("curated", "warehouse"):
        kept = [t for t in store.tables(zone) if not t.endswith("_sightings")]
        catalog.register(store, zone, names[zone], kept)
    return names


@query
def zone_tables(f: Frames) -> DataFrame:
    return catalog.zone_tables(f.spark, _databases(f))


@query
def zone_columns(f: Frames) -> DataFrame:
    found = catalog.zone_columns(f.spark, {"warehouse": _databases(f)["warehouse"]})
    return found.filter(F.col("table_name").isin("dim_customer", "dim_product", "dim_location", "fct_orders"))


@query
def scalar_strings(f: Frames) -> DataFrame:
    c = f.source("customers")
    city, state = F.col("customer_city"), F.nullif(F.col("customer_state"), F.lit(""))
    return c.select(
        "raw_id",
        scalars.strip(city).alias("stripped"),
        F.upper(state).alias("upper_state"),
        F.lower(city).alias("lower_city"),
        F.length(city).alias("n_chars"),
        scalars.location_key(state, scalars.strip(city)).alias("location_key"),
        scalars.join_notes(
            [
                F.when(scalars.is_blank(city), F.lit("no city")),
                F.when(state.isNull(), F.concat(F.lit("no state: "), F.col("customer_id"))),
            ]
        ).alias("notes"),
    )


@query
def scalar_dates(f: Frames) -> DataFrame:
    ts, d = F.col("ts"), F.col("ts").cast("date")
    return f.table("events").select(
        "event_id",
        d.alias("date_value"),
        scalars.days_between(ts, F.lit(dt.date(2023, 12, 25))).alias("days"),
        scalars.month_start(ts).alias("month"),
        scalars.date_key(d).alias("date_id"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week"),
        F.date_format(d, "E").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        scalars.to_timestamp_or_null(scalars.iso_timestamp(ts)).alias("ts_again"),
    )


@query
def scalar_math(f: Frames) -> DataFrame:
    quantity = F.col("l_quantity").cast("decimal(10,2)")
    tax = F.col("l_tax").cast("decimal(10,2)")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    low, high = (F.lit(Decimal(v)).cast("decimal(10,2)") for v in ("5", "40"))
    return f.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(price, 1).cast("decimal(12,1)").alias("rounded"),
        scalars.zero_as_null(tax).alias("tax_or_null"),
        F.coalesce(scalars.zero_as_null(tax), F.lit(Decimal("1")).cast("decimal(10,2)")).alias(
            "tax_or_one"
        ),
        scalars.ratio(price, quantity, "decimal(15,2)").alias("unit_price"),
        scalars.ratio(price, tax * 100, "decimal(15,2)").alias("per_tax_point"),
        scalars.clamp(quantity, low, high).cast("decimal(10,2)").alias("clamped"),
        analytics.segment_of(price, (("small", 10_000), ("medium", 50_000)), "large").alias("size"),
    )


# ---- curated zone ---------------------------------------------------------------------------
@query
def curated_orders(f: Frames) -> DataFrame:
    return f.orders


@query
def curated_items(f: Frames) -> DataFrame:
    return f.items


@query
def curated_customers(f: Frames) -> DataFrame:
    return f.customers


@query
def curated_sellers(f: Frames) -> DataFrame:
    return f.sellers


@query
def dedupe_best(f: Frames) -> DataFrame:
    """The best valid customer record per city, of many with equal scores."""
    valid = f.processed("customers").filter("is_valid").select(
        "customer_city", "customer_id", "data_quality_score", "source_raw_id"
    )
    return dedupe.best_per_key(valid, ["customer_city"], F.col("data_quality_score"), "source_raw_id")


@query
def curated_stats(f: Frames) -> DataFrame:
    return curated.summary(f.orders, f.items, f.customers, f.sellers)


@query
def category_translate(f: Frames) -> DataFrame:
    translation = adapters.category_translation(f.spark, f.sf_dir)
    return curated.translate_category(f.processed("products"), translation).select(
        "product_id", "product_category_name", "product_category_name_english"
    )


# ---- warehouse ------------------------------------------------------------------------------
@query
def dim_date(f: Frames) -> DataFrame:
    return f.dim_date


@query
def calendar_range(f: Frames) -> DataFrame:
    """The calendar, the fact and the quarantine with orders of the years 1 and 9999 among the others."""
    key = F.col("raw_id")
    wrong = F.when(key % 97 == 0, F.lit("0001-01-01")).when(key % 101 == 0, F.lit("9999-12-31"))
    bought = F.coalesce(wrong.cast("timestamp_ntz"), F.col("order_purchase_timestamp"))
    source = f.source("orders").withColumn("order_purchase_timestamp", bought)
    documents = raw.to_documents(source, "orders", LOADED_AT, "raw_id", with_hash=False)
    orders = f.kept(curated.orders_refined(processed.accepted(processed.orders(documents))), "orders")
    customers = f.kept(f.customers, "customers")
    locations = warehouse.dim_location(customers, f.sellers)
    days = warehouse.dim_date(warehouse.order_date_range(orders)).agg(
        F.min("date_value").alias("first_day"), F.max("date_value").alias("last_day"), F.count("*").alias("n_days")
    )
    fact = warehouse.fct_orders(orders, f.items, customers, locations).agg(
        F.count_distinct("order_id").alias("n_orders"),
        F.count_if(F.col("dim_date_id").isNull() & F.col("order_date").isNotNull()).alias("rows_without_date"),
    )
    outside = warehouse.outside_calendar(orders).agg(F.count("*").alias("n_outside"), F.min("document").alias("first_outside"))
    # Three single rows below each other, of which every column has one value.
    rows = days.unionByName(fact, True).unionByName(outside, True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


@query
def dim_customer(f: Frames) -> DataFrame:
    return f.dim_customer.drop("dim_customer_id", "created_at", "updated_at")


@query
def dim_location(f: Frames) -> DataFrame:
    return f.dim_location.drop("dim_location_id")


@query
def dim_product(f: Frames) -> DataFrame:
    return f.dim_product.drop("dim_product_id")


#: Surrogate and natural key of the dimensions that the fact refers to.
NATURAL = {
    "dim_customer": ("dim_customer_id", "customer_id"),
    "dim_product": ("dim_product_id", "product_id"),
    "dim_location": ("dim_location_id", "location_key"),
}


def _natural(f: Frames, fact: DataFrame, star: warehouse.Star | None = None) -> DataFrame:
    """The fact, or sums of it, with natural keys instead of surrogate ones."""
    columns = [c for c in fact.columns if c not in dict(NATURAL.values())]
    names = [natural for key, natural in NATURAL.values() if key in fact.columns]
    fact = fact.select(*_lines_last(fact.columns))
    for table, (key, natural) in NATURAL.items():
        if key in fact.columns:
            members = getattr(star or f, table).select(key, natural)
            fact = fact.join(members, key, "left").drop(key)
    return fact.select(*columns, *names)


def _lines_last(columns: list[str]) -> list[str]:
    """Columns of the fact with those that differ between the lines of an order at the end: neighbours that move together
    then differ in one stretch."""
    own = ["dim_product_id", "price_amount", "freight_value", "total_order_value"]
    return [c for c in columns if c not in own] + [c for c in own if c in columns]


def _fact(f: Frames, **options: object) -> DataFrame:
    """The fact built from the written curated zone, as a refresh builds it."""
    lake = f.written
    return warehouse.fct_orders(lake.orders, lake.items, lake.customers, lake.star.dim_location, **options)


def _named_fact(f: Frames, **options: object) -> DataFrame:
    """That fact with the natural keys that its surrogate ones have in the written dimensions."""
    return _fact(f, names=f.written.star, **options)


#: So many products whose key leads to another one, or to none, are broadcast at most.
MOST_RENAMED = 100_000


@query
def fct_orders(f: Frames) -> DataFrame:
    lake = f.written
    renamed = f.kept(warehouse.renamed_products(lake.items, lake.star.dim_product), "renamed")
    return _named_fact(f, renamed=renamed if renamed.count() <= MOST_RENAMED else None)


@query
def fct_orders_order_grain(f: Frames) -> DataFrame:
    return _named_fact(f, grain="order")


@query
def fct_orders_strict(f: Frames) -> DataFrame:
    """Blank ids match nothing, and orders of unknown customers have no location."""
    fact = _fact(f, strict_location=True, blank_keys="null")
    # Added up by surrogate keys first, so that sums and not rows meet the dimensions.
    sums = fact.groupBy("dim_customer_id", "dim_location_id").agg(
        F.count("*").alias("n_rows"), F.sum("total_order_value").alias("value")
    )
    return _natural(f, sums, f.written.star).groupBy("customer_id", "location_key").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("value").cast("decimal(18,2)").alias("value")
    )


@query
def star_join(f: Frames) -> DataFrame:
    s = f.written.star
    days = s.dim_date.select(F.col("date_id").alias("dim_date_id"), "year", "month")
    # Customers and products, which rows of the fact may have to move for, come first: keys take less room than what the
    # days and places have for them.
    keys = ["order_id", "dim_customer_id", "dim_date_id", "dim_location_id"]
    fact = s.fct_orders.select(*_lines_last([*keys, "quantity", "dim_product_id", "total_order_value"]))
    return (
        fact.join(s.dim_customer.select("dim_customer_id", "customer_state"), "dim_customer_id", "left")
        .join(s.dim_product.select("dim_product_id", "product_id", "avg_price"), "dim_product_id", "left")
        .join(days, "dim_date_id", "left")
        .join(s.dim_location.select("dim_location_id", "city_name"), "dim_location_id", "left")
        .select(
            "order_id",
            "year",
            "month",
            "customer_state",
            "city_name",
            "product_id",
            "avg_price",
            "quantity",
            "total_order_value",
        )
    )


@query
def surrogate_keys(f: Frames) -> DataFrame:
    """Dense ids of orders and products: as many as rows, from 1 to n; hash keys do not collide."""

    def report(name: str, df: DataFrame, key: str) -> DataFrame:
        keyed = surrogate.dense_key(df.select(key), [key], "id", buckets=64)
        return keyed.agg(
            F.count("*").alias("n_rows"),
            F.count_distinct("id").alias("n_ids"),
            F.min("id").alias("min_id"),
            F.max("id").alias("max_id"),
            F.count_distinct(surrogate.hash_key(key)).alias("n_hash_keys"),
        ).select(F.lit(name).alias("table_name"), "*")

    return report("orders", f.orders, "order_id").unionByName(
        report("products", f.dim_product, "product_id")
    )


def _versions(df: DataFrame) -> DataFrame:
    return df.drop("scd_id", "version")


@query
def scd2_initial(f: Frames) -> DataFrame:
    return _versions(warehouse.dim_seller_scd(f.seller_snapshot(1), DAY_1))


def _seller_history(f: Frames, compat: bool = False) -> DataFrame:
    first = warehouse.dim_seller_scd(f.seller_snapshot(1), DAY_1, compat=compat)
    return warehouse.dim_seller_scd(f.seller_snapshot(2), DAY_2, first, compat)


@query
def scd2_apply(f: Frames) -> DataFrame:
    return _versions(_seller_history(f))


@query
def scd2_reapply(f: Frames) -> DataFrame:
    """The second snapshot applied again changes nothing."""
    return _versions(warehouse.dim_seller_scd(f.seller_snapshot(2), DAY_2, _seller_history(f)))


@query
def scd2_compat(f: Frames) -> DataFrame:
    return _versions(_seller_history(f, compat=True))


@query
def scd2_history(f: Frames) -> DataFrame:
    rows = scd2.history_of(_seller_history(f), "seller_id", "S00000005")
    return rows.select(
        "seller_id",
        "seller_state",
        "seller_city",
        "valid_from",
        "valid_to",
        "is_current",
        "change_reason",
    )


@query
def scd2_current(f: Frames) -> DataFrame:
    return scd2.current(_seller_history(f)).select("seller_id", "seller_state", "seller_city", "valid_from")


@query
def insert_ignore(f: Frames) -> DataFrame:
    """Places of sellers added to those of customers."""

    def places(df: DataFrame, who: str) -> DataFrame:
        state, city = F.col(f"{who}_state"), F.col(f"{who}_city")
        return df.select(
            scalars.location_key(state, city).alias("location_key"),
            F.lit(who).alias("added_by"),
            city.alias("city_name"),
        )

    existing = places(f.customers, "customer").distinct()
    return dedupe.insert_ignore(existing, places(f.sellers, "seller"), ["location_key"], "city_name")


@query
def upsert_touch(f: Frames) -> DataFrame:
    """Customers first loaded on one day, loaded again with other cities a month later."""
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    known = f.customers.filter("data_quality_score < 1")
    existing = warehouse.dim_customer(known, first)
    changed = f.customers.withColumn("customer_city", F.concat("customer_city", F.lit("*")))
    merged = dedupe.upsert_touch(
        existing, warehouse.dim_customer(changed, second), "customer_id", second
    )
    return merged.select("customer_id", "customer_city", "created_at", "updated_at")


@query
def warehouse_validation(f: Frames) -> DataFrame:
    return warehouse.validation_report(f.written.star)


@query
def warehouse_summary(f: Frames) -> DataFrame:
    return warehouse.warehouse_summary(f.written.star.fct_orders)


@query
def zone_counts(f: Frames) -> DataFrame:
    """Every zone is made from the kept rows of the one before."""
    processed_orders, processed_items = (f.kept(f.processed(e), e) for e in ("orders", "order_items"))
    orders = f.kept(curated.orders_refined(processed_orders), "orders_refined")
    items, customers = curated.order_items_refined(processed_items), f.kept(f.customers, "customers")
    locations = warehouse.dim_location(customers, f.sellers)
    return lineage.zone_counts(
        {
            "raw.orders": f.raw("orders"),
            "raw.order_items": f.raw("order_items"),
            "processed.orders": processed_orders,
            "processed.order_items": processed_items,
            "curated.orders": orders,
            "curated.order_items": items,
            "warehouse.fct_orders": warehouse.fct_orders(orders, items, customers, locations),
        }
    )


@query
def lineage_raw(f: Frames) -> DataFrame:
    return lineage.raw_lineage(_audit(f))


@query
def lineage_counts(f: Frames) -> DataFrame:
    lake = f.written
    return lineage.zone_lineage(lake.orders, lake.customers, lake.items, lake.sellers, lake.star)


# ---- reports --------------------------------------------------------------------------------
@query
def sales_by_region_time(f: Frames) -> DataFrame:
    return analytics.sales_by_region_time(f.written.star, MIN_YEAR)


@query
def product_performance(f: Frames) -> DataFrame:
    return analytics.product_performance(f.written.star, MIN_ORDERS)


@query
def customer_segments(f: Frames) -> DataFrame:
    return analytics.customer_segments(f.written.star, SEGMENTS)


@query
def customer_segments_direct(f: Frames) -> DataFrame:
    lake = f.written
    return analytics.customer_segments_direct(lake.customers, lake.orders, lake.items, SEGMENTS)


@query
def dashboard_regional(f: Frames) -> DataFrame:
    return analytics.dashboard_regional(f.written.star)


@query
def dashboard_regional_totals(f: Frames) -> DataFrame:
    return analytics.dashboard_regional_totals(analytics.dashboard_regional(f.written.star))


@query
def dashboard_product(f: Frames) -> DataFrame:
    return analytics.dashboard_product(f.written.star)


@query
def dashboard_customer(f: Frames) -> DataFrame:
    return analytics.dashboard_customer(f.written.star, SEGMENTS)


@query
def chart_regions(f: Frames) -> DataFrame:
    return analytics.chart_regions(f.written.star)


@query
def chart_top_regions(f: Frames) -> DataFrame:
    return analytics.chart_top_regions(analytics.chart_regions(f.written.star))


@query
def chart_region_boxstats(f: Frames) -> DataFrame:
    return analytics.chart_region_boxstats(analytics.chart_regions(f.written.star))


@query
def chart_products(f: Frames) -> DataFrame:
    return analytics.top_products(f.written.star, min_orders=MIN_ORDERS)


@query
def chart_product_pie(f: Frames) -> DataFrame:
    return analytics.chart_product_pie(analytics.top_products(f.written.star, min_orders=MIN_ORDERS))


@query
def chart_product_normalised(f: Frames) -> DataFrame:
    return analytics.chart_product_normalised(analytics.top_products(f.written.star, min_orders=MIN_ORDERS))


@query
def chart_segments(f: Frames) -> DataFrame:
    return analytics.chart_segments(f.written.star, SEGMENTS)


# ---- whole flows ----------------------------------------------------------------------------
@query
def two_loads(f: Frames) -> DataFrame:
    """Customers in two deliveries, of which a third is the same; processed as from one."""
    store = files.ZoneStore(f.spark, scratch_dir(f.spark, "two-loads"))
    source, third = f.source("customers"), F.col("raw_id") % 3
    for day, part in ((DAY_1, third != 0), (DAY_2, third != 1)):
        loaded_at = dt.datetime.combine(day, dt.time())
        documents = refresh.ingest(store, "customers", source.filter(part), loaded_at, "raw_id")
        good = refresh.clean(store, "customers", documents)
    return good.select("customer_id", "customer_city", "data_quality_score", "is_valid", "source_raw_id")


@query
def raw_ids(f: Frames) -> DataFrame:
    """Ids that the raw zone gives itself, over two loads of all items."""
    store = files.ZoneStore(f.spark, scratch_dir(f.spark, "raw-ids"))
    for day in (DAY_1, DAY_2):
        source = f.source("order_items").drop("raw_id")
        refresh.ingest(store, "order_items", source, dt.datetime.combine(day, dt.time()))
    rows = store.read("raw", "order_items_raw")
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct("raw_id").alias("n_ids"))


@query
def quarantine_zones(f: Frames) -> DataFrame:
    """What every zone turned away, with its document: broken items, and states that are too wide."""
    store = files.ZoneStore(f.spark, scratch_dir(f.spark, "quarantine"))
    sellers = refresh.ingest(store, "sellers", f.source("sellers", blank_as_null=True), LOADED_AT, "raw_id")
    refresh.clean(store, "sellers", sellers, null_mode="compat")
    refresh.clean(store, "order_items", _broken_items(f))
    for entity in ("sellers", "order_items"):
        refresh.curate(store, entity)
    rows = store.read("quarantine", "rows")
    return rows.groupBy("zone", "entity", "reject_reason").agg(
        F.count("*").alias("n_rows"), F.count("document").alias("n_documents"), F.min("source_raw_id").alias("first_raw_id")
    )


@query
def pipeline_csv(f: Frames) -> DataFrame:
    """The entities as CSV files, a table without declaration among them, through the whole flow."""
    base = scratch_dir(f.spark, "csv-flow")
    for entity in adapters.ENTITIES:
        files.write_csv(f.source(entity).drop("raw_id"), f"{base}/in/{entity}.csv", "gzip")
    files.write_csv(f.table("nation"), f"{base}/in/nation.csv", "gzip")
    lake = refresh.run_folder(f.spark, f"{base}/in", f"{base}/lake", LOADED_AT)
    return _natural(f, lake.star.fct_orders, lake.star)


# ---- incremental loads ----------------------------------------------------------------------
def _event_stream(f: Frames) -> DataFrame:
    return incremental.file_stream(
        f.spark, f.sf_dir, f.table("events").schema, pattern="events.parquet"
    )


def _events(f: Frames) -> DataFrame:
    """The events, every 50th without its time."""
    timeless = F.col("event_id") % 50 == 0
    return f.table("events").withColumn("ts", F.when(~timeless, F.col("ts")))


@query
def stream_ingest(f: Frames) -> DataFrame:
    """The events in several files, twice over and out of order, one file per batch."""
    base = scratch_dir(f.spark, "ingest")
    events = _events(f)
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for n in range(3):
        events.filter((third == n) | (third == 0)).coalesce(1).write.parquet(f"{base}/inbox/{n}")
    stream = incremental.file_stream(f.spark, f"{base}/inbox/*", events.schema, files_per_batch=1)
    incremental.ingest_once(stream, "event_id", "ts", f"{base}/rows", f"{base}/state")
    return incremental.ingested(f.spark, f"{base}/rows")


@query
def stream_load_stats(f: Frames) -> DataFrame:
    base = scratch_dir(f.spark, "stats")
    incremental.load_stats_per_hour(
        _event_stream(f), "event_id", "ts", "event_type", "value", base, f"{base}/state"
    )
    return f.spark.read.parquet(f"{base}/stats").drop("_day")


@query
def stream_scd2(f: Frames) -> DataFrame:
    """Two deliveries of seller snapshots, then the second one again."""
    base = scratch_dir(f.spark, "sellers")
    store = files.ZoneStore(f.spark, base)
    for n, (day, as_of) in enumerate([(1, DAY_1), (2, DAY_2), (2, DAY_2)]):
        delivery = f.seller_snapshot(day).withColumn("snapshot_date", F.lit(as_of))
        delivery.write.parquet(f"{base}/inbox/{n}")
        stream = incremental.file_stream(f.spark, f"{base}/inbox/*", delivery.schema)
        incremental.apply_seller_snapshots(
            stream, store, "dim_seller_scd", "snapshot_date", f"{base}/state"
        )
    return _versions(store.read("warehouse", "dim_seller_scd"))


@query
def scd2_late(f: Frames) -> DataFrame:
    """Snapshots of three days, delivered from the last to the first, the one in between twice."""
    base = scratch_dir(f.spark, "late-sellers")
    store = files.ZoneStore(f.spark, base)
    snapshots = {DAY_1: f.seller_snapshot(1), BETWEEN: f.seller_snapshot(3), DAY_2: f.seller_snapshot(2)}
    for n, day in enumerate([DAY_2, BETWEEN, DAY_1, BETWEEN]):
        delivery = snapshots[day].withColumn("snapshot_date", F.lit(day))
        history = seller_history.deliver(store, delivery, "snapshot_date", n)
    return _versions(history)


def _deliveries(f: Frames) -> list[tuple[dt.datetime, dict[str, DataFrame]]]:
    """The sources in three deliveries.

    The first lacks a sixth of the customers and some items, and has orders without their customer and with a
    date of another month. The second brings those orders as they are, in other months, the customers and
    again some of the first; the third brings the items.
    """
    key = F.col("raw_id")
    orders, items, customers = f.source("orders"), f.source("order_items"), f.source("customers")
    early = F.col("order_purchase_timestamp") - F.make_dt_interval(days=F.lit(45))
    # Orders without a customer in both would tie, and the lower id, which is the first, would stay.
    mended = (key % 10 == 4) & (key % 29 != 0)
    wrong = orders.filter(mended).withColumns(
        {"raw_id": -key, "customer_id": F.lit(""), "order_purchase_timestamp": early}
    )
    late_item = (key % 8 == 1) & (F.floor(key / 8) % 7 == 0)
    first = {
        **{e: f.source(e) for e in ("sellers", "products", "geolocation")},
        "orders": orders.filter(~mended).unionByName(wrong),
        "order_items": items.filter(~late_item),
        "customers": customers.filter(key % 6 != 1),
    }
    second = {
        "orders": orders.filter(mended | (key % 10 == 5)),
        "customers": customers.filter((key % 6 == 1) | (key % 6 == 2)),
    }
    third = {"order_items": items.filter(late_item)}
    return [(dt.datetime(2024, n, 1), part) for n, part in enumerate([first, second, third], 1)]


@query
def fct_incremental(f: Frames) -> DataFrame:
    """The fact after three deliveries, each of which rewrites the months that it touches."""
    base = scratch_dir(f.spark, "deliveries")
    for loaded_at, sources in _deliveries(f):
        lake = deliver.deliver(f.spark, sources, base, loaded_at, raw_id="raw_id")
    return _natural(f, lake.star.fct_orders, lake.star)


@query
def incremental_loads(f: Frames) -> DataFrame:
    """What each of three deliveries of customers, which overlap, adds to the processed zone."""
    store = files.ZoneStore(f.spark, scratch_dir(f.spark, "loads"))
    source, key = f.source("customers"), F.col("raw_id")
    for n, part in enumerate([key % 4 < 2, key % 4 != 0, key % 2 == 0], 1):
        loaded_at = dt.datetime(2024, n, 1)
        documents = refresh.ingest(store, "customers", source.filter(part), loaded_at, "raw_id", only_new=True)
        refresh.clean(store, "customers", documents, refresh.load_name(loaded_at))
    rows = store.read("processed", "customers").filter("outcome = 'accepted'")
    return rows.select("load_id", "source_raw_id", "customer_id", "data_quality_score")
