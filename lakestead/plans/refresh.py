"""The whole flow: source entities to raw, processed, curated and warehouse tables.

Every zone table is written and read back, so a lost executor repeats only the zone at work and
no step sees the lineage of the one before.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestead.operators.surrogate import guarded
from lakestead.plans import curated, processed, seller_history, warehouse
from lakestead.schemas import TABLES, conform, schema
from lakestead.sources.files import (
    CORRUPT,
    ZoneStore,
    csv_tables,
    partition_folder,
    scan_csv,
    text_schema,
)
from lakestead.sources.index import ContentIndex
from lakestead.sources.raw import observed, to_documents
from lakestead.sources.versions import State

ACCEPTED, REJECTED = "accepted", "rejected"
#: The partition of a processed table that a whole refresh writes.
WHOLE = "all"
ENTITY_OF = {"geolocation": "geolocations"}
_audit = Lock()


@dataclass(frozen=True)
class Lakehouse:
    store: ZoneStore
    star: warehouse.Star
    orders: DataFrame
    items: DataFrame
    customers: DataFrame
    sellers: DataFrame


def ingest(
    store: ZoneStore,
    table: str,
    df: DataFrame,
    loaded_at: dt.datetime,
    raw_id: str | None = None,
    only_new: bool = False,
) -> DataFrame:
    """Add one load to the raw zone and its row to the audit; returns the documents of all loads, or
    with ``only_new`` those of this one.

    A load is a partition of its own: running it again replaces it instead of adding copies. A document
    that an earlier load brought stays in the raw table but is not returned again. Ids that are not
    given go on after the highest of the other loads, and stay where they were when the load is run again.
    A load that fails leaves an audit row that says so. Each task writes its rows in the order of their first column,
    in which all zones keep them: near keys take less room, in files and where rows are dealt.
    """
    load_id = load_name(loaded_at)
    name = f"{table}_raw"
    df = df.sortWithinPartitions(raw_id or df.columns[0])
    documents = to_documents(df, table, loaded_at, raw_id).withColumn("load_id", F.lit(load_id))
    stored = store.read_if_there("raw", name)
    if stored is not None and raw_id is None:
        own = F.col("load_id") == load_id
        ids = stored.agg(F.min(F.when(own, F.col("raw_id"))), F.max(F.when(~own, F.col("raw_id")))).first()
        first = ids[0] if ids[0] is not None else (ids[1] if ids[1] is not None else -1) + 1
        documents = documents.withColumn("raw_id", F.col("raw_id") + F.lit(first))
    counted, seen = observed(documents, f"{table}-{load_id}")
    writer = counted.write.mode("overwrite").partitionBy("load_id")
    try:
        writer.option("partitionOverwriteMode", "dynamic").parquet(store.path("raw", name))
    except Exception:
        audit(store, table, loaded_at, 0, "failed")
        raise
    audit(store, table, loaded_at, seen.get["n"], "loaded")
    # The schema is known, also where no load had a row.
    loads = store.spark.read.schema(documents.schema).parquet(store.path("raw", name))
    index = ContentIndex(store, "raw", name)
    own = loads.filter(F.col("load_id") == load_id)
    # The first 128 bits of the digest: among ten billion documents two share them with a chance of 2e-19.
    digest = F.unhex(F.substring("file_hash", 1, 32))
    index.enter(own.select(digest.alias("content")), load_id)
    return index.fresh(own if only_new else loads, digest)


def load_name(loaded_at: dt.datetime) -> str:
    return loaded_at.strftime("%Y%m%dT%H%M%S")


def audit(store: ZoneStore, table: str, loaded_at: dt.datetime, n: int, status: str) -> None:
    """Replace the audit row of a load."""
    row = store.spark.createDataFrame(
        [(table, n, loaded_at, f"source_data.{table}", n, status, load_name(loaded_at))],
        schema("raw.data_metadata").add("load_id", "string"),
    )
    writer = row.write.mode("overwrite").partitionBy("load_id", "table_name")
    with _audit:  # one table for all loads, which may run side by side
        writer.option("partitionOverwriteMode", "dynamic").parquet(store.path("raw", "data_metadata"))


def reject(store: ZoneStore, zone: str, entity: str, bad: DataFrame) -> None:
    """Replace the quarantined rows of an entity in a zone: id in the raw table, reason, document."""
    rows = bad.select(
        F.col("source_raw_id").cast("bigint").alias("source_raw_id"),
        "reject_reason",
        F.col("document").cast("string").alias("document"),
    )
    rows.write.mode("overwrite").parquet(f"{store.path('quarantine', 'rows')}/zone={zone}/entity={entity}")


def clean(
    store: ZoneStore, entity: str, documents: DataFrame, load_id: str | None = None, **modes: str
) -> DataFrame:
    """Processed table of an entity. Good rows and those that cannot be stored are written in one
    pass, as two partitions. With ``load_id`` the documents are those of one load and add to the table
    or replace what that load brought before; otherwise they are the whole table."""
    rows = processed.PROCESS[entity](documents, **modes)
    outcome = F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED)
    rows = rows.withColumns({"load_id": F.lit(load_id or WHOLE), "outcome": outcome})
    store.versions("processed", entity).write(
        rows, ("load_id", "outcome"), None if load_id is None else {partition_folder("load_id", load_id)}
    )
    reject(store, "processed", entity, quarantine(store, entity))
    good = stored(store, entity)
    return good if load_id is None else accepted(store, entity, load_id)


CURATED = {
    "orders": ("orders_refined", curated.orders_refined, "is_valid"),
    "order_items": ("order_items_refined", curated.order_items_refined, "order_id is not null"),
    "customers": ("customers_refined", curated.customers_refined, "is_valid"),
    "sellers": ("sellers_refined", curated.sellers_refined, "is_valid"),
}


def curate(store: ZoneStore, entity: str) -> DataFrame:
    """Curated table of an entity; rows with a text over its declared width go to quarantine.

    Orders are stored by purchase month and items by load, so a delivery replaces what it touches.
    """
    table, refine, _ = CURATED[entity]
    too_wide(store, entity)
    if entity == "orders":
        refine = partial(refine, repeated=few_repeated(store), by_month=True)
    rows = refine(_processed(store, entity), keep=["source_raw_id"]).withColumn("load_id", F.lit(WHOLE))
    store.overwrite("curated", table, rows, PARTITION.get(entity), balance=False)
    return curated_rows(store, entity)


#: So many repeated ids of orders are broadcast at most.
MOST_REPEATED = 100_000


def few_repeated(store: ZoneStore) -> DataFrame | None:
    """Ids that several processed orders have; None where they are too many to broadcast."""
    found = store.overwrite("staging", "repeated_orders", curated.repeated_orders(_processed(store, "orders")))
    return found if found.count() <= MOST_REPEATED else None


#: Partition columns of curated tables: a delivery replaces whole months, and adds its own items.
PARTITION = {"orders": "purchase_month", "order_items": "load_id"}


def curated_rows(store: ZoneStore, entity: str) -> DataFrame:
    """The curated table with its declared columns."""
    table = CURATED[entity][0]
    return conform(store.read("curated", table), f"curated.{table}")


def too_wide(store: ZoneStore, entity: str) -> None:
    """Quarantine the wanted rows that do not fit the curated table. The processed zone kept their documents."""
    kept = _processed(store, entity, columns=("document",)).filter("document is not null")
    reject(store, "curated", entity, curated.oversized(kept, CURATED[entity][2], keep=["document"]))


def stored(store: ZoneStore, entity: str) -> DataFrame:
    return _processed(store, entity)


def accepted(store: ZoneStore, entity: str, load_id: str) -> DataFrame:
    """What one load added to the processed table."""
    return _processed(store, entity, load_id)


def _processed(
    store: ZoneStore, entity: str, load_id: str | None = None, columns: tuple[str, ...] = ()
) -> DataFrame:
    name = f"processed.{entity}"
    if not store.exists("processed", entity):
        empty = store.spark.createDataFrame([], schema(name))
        return empty.withColumns({c: F.lit(None).cast("string") for c in columns})
    good = store.read("processed", entity).filter(F.col("outcome") == ACCEPTED)
    if load_id is not None:
        good = good.filter(F.col("load_id") == load_id)
    return good.select(*schema(name).names, *columns)


def quarantine(store: ZoneStore, entity: str) -> DataFrame:
    bad = store.read("processed", entity).filter(F.col("outcome") == REJECTED)
    return bad.select("source_raw_id", "reject_reason", "document")


def run(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    root: str,
    loaded_at: dt.datetime,
    raw_id: str | None = None,
    calendar: DataFrame | None = None,
    previous_sellers: DataFrame | None = None,
    null_mode: str = "missing",
) -> Lakehouse:
    """Refresh all zones under ``root`` from the source entities."""
    store = ZoneStore(spark, root)
    done: dict[str, DataFrame] = {}

    def load(table: str, df: DataFrame) -> None:
        entity = ENTITY_OF.get(table, table)
        documents = ingest(store, table, df, loaded_at, raw_id if raw_id in df.columns else None)
        if entity in processed.PROCESS:
            done[entity] = clean(store, entity, documents, null_mode=null_mode)

    side_by_side([partial(load, table, df) for table, df in sources.items()])
    # An entity that is not among the sources has the rows of earlier refreshes, or none.
    curated_tables = ("orders", "order_items", "customers", "sellers")
    *_, orders, items, customers, sellers = side_by_side(
        [partial(constraints, store, done)] + [partial(curate, store, e) for e in curated_tables]
    )
    star = load_star(
        store, orders, items, customers, sellers, loaded_at.date(), calendar, previous_sellers
    )
    return Lakehouse(store, star, orders, items, customers, sellers)


def run_folder(
    spark: SparkSession,
    folder: str,
    root: str,
    loaded_at: dt.datetime,
    multi_line: tuple[str, ...] = (),
) -> Lakehouse:
    """Refresh from a folder of CSV files: every one of them becomes a raw table.

    Lines that do not fit a declared table go to quarantine. Tables that are not declared are taken as
    text. ``multi_line`` names the tables with line breaks inside values.
    """
    store, sources = ZoneStore(spark, root), {}
    for table, path in csv_tables(spark, folder).items():
        declared = f"source.{table}" in TABLES
        table_schema = schema(f"source.{table}") if declared else text_schema(spark, path)
        # Parsed once, with all columns: Spark calls a line corrupt only by the columns that a query reads.
        scan = scan_csv(spark, path, table_schema, table in multi_line, corrupt=True)
        lines = store.overwrite("staging", f"source_{table}", scan)
        bad = lines.filter(F.col(CORRUPT).isNotNull()).select(
            F.lit(None).cast("bigint").alias("source_raw_id"),
            F.lit("unreadable line").alias("reject_reason"),
            F.col(CORRUPT).alias("document"),
        )
        reject(store, "source", table, bad)
        sources[table] = lines.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return run(spark, sources, root, loaded_at)


#: Keys that the constraint stage checks: entity -> its key.
KEYS = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "sellers": "seller_id"}


def constraints(store: ZoneStore, done: dict[str, DataFrame]) -> DataFrame:
    """Per key: rows without it, and values held by more than one row. Spark enforces neither."""

    def check(entity: str, key: str) -> DataFrame:
        value = F.nullif(F.col(key), F.lit(""))
        per_value = done[entity].groupBy(value.alias("v")).agg(F.count("*").alias("n"))
        return per_value.agg(
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
            F.count_if(F.col("v").isNotNull() & (F.col("n") > 1)).alias("repeated_values"),
        ).select(F.lit(entity).alias("table_name"), F.lit(key).alias("column_name"), "missing", "repeated_values")

    reports = [check(e, k) for e, k in KEYS.items() if e in done]
    if not reports:
        return store.spark.createDataFrame(
            [], "table_name string, column_name string, missing bigint, repeated_values bigint"
        )
    return store.overwrite("checks", "constraints", reduce(DataFrame.unionByName, reports))


def load_star(
    store: ZoneStore,
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    as_of: dt.date,
    calendar: DataFrame | None = None,
    previous_sellers: DataFrame | None = None,
) -> warehouse.Star:
    """Write the star; the fact is partitioned by order month."""
    # Written first: the fact's join with places is planned by how few they are.
    locations = write_dimension(store, "dim_location", warehouse.dim_location(customers, sellers))
    plan = warehouse.build_star(
        orders, items, customers, sellers, as_of, calendar, previous_sellers, locations
    )
    write = {
        "fct_orders": partial(store.overwrite, "warehouse", "fct_orders", plan.fct_orders, "order_month", balance=False),
        "dim_date": partial(store.overwrite, "warehouse", "dim_date", plan.dim_date.coalesce(1)),
        "dim_customer": partial(write_dimension, store, "dim_customer", plan.dim_customer),
        "dim_product": partial(write_dimension, store, "dim_product", plan.dim_product),
        "dim_location": lambda: locations,
        "dim_seller_scd": partial(store.overwrite, "warehouse", "dim_seller_scd", plan.dim_seller_scd),
    }
    # Later deliveries, late ones too, find what was seen on this day.
    seller_history.log(store, sellers, as_of)
    reject(store, "warehouse", "dim_location", warehouse.wide_places(customers, sellers))
    reject(store, "warehouse", "fct_orders", warehouse.outside_calendar(orders))
    star = warehouse.Star(**dict(zip(write, side_by_side(list(write.values())), strict=True)))
    mark_built(store)
    return star


BUILT_FROM = "_built_from"


def mark_built(store: ZoneStore) -> None:
    """Remember the states of the curated tables that the star was built from, when all of it is written."""
    states = {e: store.versions("curated", CURATED[e][0]).state() for e in CURATED}
    text = json.dumps({e: s.to_json() for e, s in states.items() if s})
    store.versions("warehouse", "fct_orders").folder.put(BUILT_FROM, text)


def built_from(store: ZoneStore) -> dict[str, State] | None:
    """Those states; None where no whole star was written."""
    text = store.versions("warehouse", "fct_orders").folder.text(BUILT_FROM)
    return {e: State.from_json(s) for e, s in json.loads(text).items()} if text else None


#: Surrogate and natural key of the dimensions.
DIMENSION_KEYS = {
    "dim_customer": ("dim_customer_id", "customer_id"),
    "dim_product": ("dim_product_id", "product_id"),
    "dim_location": ("dim_location_id", "location_key"),
}


def write_dimension(store: ZoneStore, table: str, rows: DataFrame) -> DataFrame:
    """Write a dimension, unless different members got one surrogate key: the load ends and the old table stays."""
    watched, check = guarded(rows, *DIMENSION_KEYS[table])
    return store.overwrite("warehouse", table, watched, check=check)


def side_by_side(steps: list[Callable], at_once: int = 4) -> list:
    """Run steps that do not depend on each other, a few at a time; results in their order."""
    with ThreadPoolExecutor(at_once) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]
