"""Curated zone: typed, enriched, one row per key."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestead.functions.scalars import days_between, month_start
from lakestead.operators.dedupe import best_per_key
from lakestead.schemas import conform, fits, schema, too_long


def repeated_orders(processed: DataFrame) -> DataFrame:
    """Ids (column ``repeated``) that more than one of the rows of orders_refined has; only ids move."""
    per_id = fits(processed.filter("is_valid")).groupBy(F.col("order_id").alias("repeated"))
    return per_id.agg(F.count("*").alias("n")).filter("n > 1").select("repeated")


def orders_refined(
    processed: DataFrame,
    dedupe: bool = True,
    keep: list[str] | None = None,
    repeated: DataFrame | None = None,
    by_month: bool = False,
) -> DataFrame:
    """Valid orders with delivery time, punctuality and purchase month. Documents loaded twice
    leave one row per order; ``dedupe=False`` keeps all rows. ``keep`` names further columns. ``repeated`` are the
    ids of repeated_orders, where they are few enough to broadcast: all other rows then stay where they are. ``by_month``
    balances the rows over the tasks by purchase month, for a write that is partitioned by it."""
    valid = fits(processed.filter("is_valid"))
    delivered, estimated = "order_delivered_customer_date", "order_estimated_delivery_date"
    on_time = (F.col("order_status") == "delivered") & (F.col(delivered) <= F.col(estimated))
    best = partial(best_per_key, key=["order_id"], better=F.col("data_quality_score"), tie="source_raw_id")
    if not dedupe:
        one = valid
    elif repeated is None:
        one = best(valid)
    else:
        ids, same = F.broadcast(repeated), F.col("order_id").eqNullSafe(F.col("repeated"))
        one = valid.join(ids, same, "left_anti").unionByName(best(valid.join(ids, same, "left_semi")))
    one = one.withColumn("purchase_month", month_start(F.col("order_purchase_timestamp")))
    if by_month:
        columns = [c for c in schema("curated.orders_refined").names if c in one.columns]
        # What follows from other columns is added after the rows have moved.
        one = one.select(*columns, *(keep or [])).hint("rebalance", "purchase_month")
    return conform(
        one.select(
            "*",
            days_between(F.col(delivered), F.col("order_purchase_timestamp")).alias(
                "days_to_delivery"
            ),
            F.coalesce(on_time, F.lit(False)).alias("is_on_time"),
        ),
        "curated.orders_refined",
        keep,
    )


def order_items_refined(processed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """All items with an order id, blank ones included."""
    zero = F.lit(0).cast("decimal(12,2)")
    total = F.coalesce("price", zero) + F.coalesce("freight_value", zero)
    return conform(
        fits(processed.filter("order_id is not null")).select(
            "*", F.col("source_raw_id").alias("order_item_id"), total.alias("total_item_value")
        ),
        "curated.order_items_refined",
        keep,
    )


def customers_refined(processed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return _best_valid(processed, "customer_id", "curated.customers_refined", keep)


def sellers_refined(processed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return _best_valid(processed, "seller_id", "curated.sellers_refined", keep)


def _best_valid(processed: DataFrame, key: str, table: str, keep: list[str] | None) -> DataFrame:
    valid = fits(processed.filter("is_valid"))
    best = best_per_key(
        conform(valid, table, keep=["source_raw_id"]),
        [key],
        F.col("data_quality_score"),
        "source_raw_id",
    )
    return conform(best, table, keep)


def oversized(
    processed: DataFrame, wanted: str = "is_valid", keep: list[str] | None = None
) -> DataFrame:
    """Wanted rows kept out of the curated zone because a text exceeds its declared width."""
    return (
        processed.filter(wanted)
        .select("source_raw_id", too_long(processed).alias("reject_reason"), *(keep or []))
        .filter("reject_reason is not null")
    )


def summary(
    orders: DataFrame, items: DataFrame, customers: DataFrame, sellers: DataFrame
) -> DataFrame:
    """Counts of the curated tables as (table, metric, value) rows, one pass per table."""

    def long(table: str, df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
        row = df.agg(*[c.alias(m) for m, c in metrics.items()])
        return row.unpivot([], list(metrics), "metric", "value").select(
            F.lit(table).alias("table_name"), "metric", "value"
        )

    parts = [
        long(
            "orders",
            orders,
            {
                "total_orders": F.count("*"),
                "unique_customers": F.count_distinct("customer_id"),
                "delivered_orders": F.count_if(F.col("order_status") == "delivered"),
                "on_time_orders": F.count_if("is_on_time"),
            },
        ),
        long(
            "order_items",
            items,
            {
                "total_items": F.count("*"),
                "unique_orders": F.count_distinct("order_id"),
                "unique_products": F.count_distinct("product_id"),
                "unique_sellers": F.count_distinct("seller_id"),
            },
        ),
        long("customers", customers, {"total_customers": F.count("*")}),
        long("sellers", sellers, {"total_sellers": F.count("*")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def translate_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """English category name, the original one where the translation has none."""
    names = translation.select("product_category_name", "product_category_name_english")
    return products.join(names, "product_category_name", "left").withColumn(
        "product_category_name_english",
        F.coalesce("product_category_name_english", "product_category_name"),
    )
