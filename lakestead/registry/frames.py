"""The zones over one data folder, as lazy frames shared by the registered queries."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lakestead.plans import curated, processed, refresh, warehouse
from lakestead.session import scratch_dir, tune
from lakestead.sources import adapters
from lakestead.sources.raw import to_documents

DAY_1, BETWEEN, DAY_2 = dt.date(2024, 1, 1), dt.date(2024, 1, 15), dt.date(2024, 2, 1)
LOADED_AT = dt.datetime(2024, 1, 1)
MIN_YEAR = 1997
MIN_ORDERS = 30
SEGMENTS = (("Bronze", 1_000_000), ("Silver", 2_000_000), ("Gold", 3_000_000))


_written: dict[tuple[str, str], refresh.Lakehouse] = {}


class Frames:
    """Lazy frames from the driver tables, and the same zones written to Parquet.

    Transforms are registered on the lazy frames. Reports read the written star, as they would in
    use: it is built from the whole tables once per application and folder.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return adapters.table(self.spark, self.sf_dir, name)

    def source(self, entity: str, **options: bool) -> DataFrame:
        return adapters.ENTITIES[entity](self.spark, self.sf_dir, **options)

    def raw(self, entity: str, **options: bool) -> DataFrame:
        # The content hash is left out where nothing reads it.
        return to_documents(self.source(entity, **options), entity, LOADED_AT, "raw_id", with_hash=False)

    def scored(self, entity: str, **modes: str) -> DataFrame:
        source = {"geolocations": "geolocation"}.get(entity, entity)
        return processed.PROCESS[entity](self.raw(source), **modes)

    def processed(self, entity: str) -> DataFrame:
        return processed.accepted(self.scored(entity))

    @cached_property
    def orders(self) -> DataFrame:
        return curated.orders_refined(self.processed("orders"))

    @cached_property
    def items(self) -> DataFrame:
        return curated.order_items_refined(self.processed("order_items"))

    @cached_property
    def customers(self) -> DataFrame:
        return curated.customers_refined(self.processed("customers"))

    @cached_property
    def sellers(self) -> DataFrame:
        return curated.sellers_refined(self.processed("sellers"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return warehouse.dim_date(warehouse.order_date_range(self.orders))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return warehouse.dim_customer(self.customers, LOADED_AT)

    @cached_property
    def dim_location(self) -> DataFrame:
        return warehouse.dim_location(self.customers, self.sellers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return warehouse.dim_product(self.items)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return warehouse.fct_orders(self.orders, self.items, self.customers, self.dim_location)

    @property
    def written(self) -> refresh.Lakehouse:
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _written:
            _written[key] = refresh.run(
                self.spark,
                {entity: self.source(entity) for entity in adapters.ENTITIES},
                scratch_dir(self.spark, "zones"),
                LOADED_AT,
                raw_id="raw_id",
            )
        return _written[key]

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """Rows that several steps read, written to the shared scratch folder once and read back."""
        path = scratch_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stored(self, entity: str) -> DataFrame:
        """An entity of the written processed zone."""
        return refresh.stored(self.written.store, entity)

    def seller_snapshot(self, day: int) -> DataFrame:
        return adapters.seller_snapshot(self.spark, self.sf_dir, day)

    @cached_property
    def documents(self) -> DataFrame:
        return adapters.customer_documents(self.spark, self.sf_dir)
