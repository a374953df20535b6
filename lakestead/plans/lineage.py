"""Lineage report over the zones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestead.fixed_values import LINEAGE_CURATED, LINEAGE_WAREHOUSE
from lakestead.plans.warehouse import Star, labelled_counts


def raw_lineage(audit: DataFrame) -> DataFrame:
    """Successful loads: how many, how many records, from how many sources, and when."""
    return audit.filter("status = 'loaded'").agg(
        F.count("*").alias("load_events"),
        F.sum("record_count").alias("records"),
        F.count_distinct("source_file").alias("source_tables"),
        F.max("loaded_at").alias("latest_load"),
        F.count_distinct(F.to_date("loaded_at")).alias("load_dates"),
    )


def zone_lineage(
    orders: DataFrame, customers: DataFrame, items: DataFrame, sellers: DataFrame, star: Star
) -> DataFrame:
    """Valid rows of the curated tables and rows of the star, as (label, value)."""
    every, valid, open_versions = F.count("*"), F.count_if("is_valid"), F.count_if("is_current")
    curated = zip(LINEAGE_CURATED, (orders, customers, items, sellers), (valid, valid, every, valid))
    warehouse = zip(
        LINEAGE_WAREHOUSE,
        (
            star.fct_orders,
            star.dim_customer,
            star.dim_product,
            star.dim_seller_scd,
            star.dim_location,
        ),
        (every, every, every, open_versions, every),
    )
    return labelled_counts([*curated, *warehouse])


def zone_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table, named ``zone.table``."""

    def one(name: str, df: DataFrame) -> DataFrame:
        zone, table = name.split(".")
        labels: list[Column] = [F.lit(zone).alias("zone"), F.lit(table).alias("table_name")]
        return df.agg(F.count("*").alias("n_rows")).select(*labels, "n_rows")

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])
