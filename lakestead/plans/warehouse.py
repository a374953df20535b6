"""Star schema: dimensions, the order fact and its reports."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestead.fixed_values import (
    CALENDAR_END,
    CALENDAR_START,
    LABEL_CUSTOMERS,
    LABEL_DATES,
    LABEL_LOCATIONS,
    LABEL_ORDER_VALUE,
    LABEL_ORDERS,
    LABEL_PRODUCTS,
    LABEL_SELLER_HISTORY,
    LABEL_SELLERS_CURRENT,
)
from lakestead.functions.scalars import date_key, location_key, mean, moment, money
from lakestead.operators import scd2
from lakestead.operators.surrogate import hash_key
from lakestead.schemas import conform, fits, too_long

SELLER_TRACKED = ["seller_state", "seller_city"]

#: The window that a calendar made from the data stays in.
FIRST_DAY, LAST_DAY = "1900-01-01", "2199-12-31"


@dataclass(frozen=True)
class Star:
    fct_orders: DataFrame
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_location: DataFrame
    dim_seller_scd: DataFrame


# ---- dimensions -----------------------------------------------------------------------------
def calendar_range(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    return spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )


def in_calendar(day: Column) -> Column:
    """Whether a date can be in the calendar; NULL for none."""
    return day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date"))


def order_date_range(orders: DataFrame) -> DataFrame:
    """Whole years around the purchase dates found in the orders, inside the declared window. One wrong date
    adds no millions of days; ``outside_calendar`` has the orders that have one."""
    bought = F.col("order_purchase_timestamp").cast("date")
    bought = F.when(in_calendar(bought), bought)
    return orders.agg(F.min(bought).alias("a"), F.max(bought).alias("b")).select(
        F.trunc("a", "year").alias("start"),
        F.date_sub(F.add_months(F.trunc("b", "year"), 12), 1).alias("end"),
    )


def outside_calendar(orders: DataFrame) -> DataFrame:
    """Quarantine rows of orders bought on a day that no calendar has; the fact keeps them without a date key."""
    day = F.col("order_purchase_timestamp").cast("date")
    return orders.filter(~in_calendar(day)).select(
        F.lit(None).cast("bigint").alias("source_raw_id"),
        F.lit("outside the calendar: order_purchase_timestamp").alias("reject_reason"),
        F.to_json(F.struct("order_id", day.cast("string").alias("order_date"))).alias("document"),
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day between the bounds of a one-row frame."""
    days = bounds.filter("start is not null").select(
        F.explode(F.sequence("start", "end")).alias("date_value")
    )
    d = F.col("date_value")
    return conform(
        days.select(
            date_key(d).alias("date_id"),
            d,
            F.year(d).alias("year"),
            F.month(d).alias("month"),
            F.dayofmonth(d).alias("day"),
            F.quarter(d).alias("quarter"),
            F.weekofyear(d).alias("week"),
            F.date_format(d, "E").alias("day_of_week"),
            F.dayofweek(d).isin(1, 7).alias("is_weekend"),
            F.lit(False).alias("is_holiday"),
        ),
        "warehouse.dim_date",
    )


def dim_customer(customers: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    stamp = moment(now)
    return conform(
        customers.filter("customer_id is not null").select(
            "*",
            hash_key("customer_id").alias("dim_customer_id"),
            F.coalesce("is_valid", F.lit(False)).alias("is_active"),
            stamp.alias("created_at"),
            stamp.alias("updated_at"),
        ),
        "warehouse.dim_customer",
    )


def places(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """One row per place key of customers and sellers; the first row of a key wins, ordered by state."""
    found = customers.select(
        F.col("customer_state").alias("state_code"), F.col("customer_city").alias("city_name")
    ).unionByName(
        sellers.select(
            F.col("seller_state").alias("state_code"), F.col("seller_city").alias("city_name")
        )
    )
    known = found.filter("state_code is not null and city_name is not null")
    keyed = known.withColumn("location_key", location_key(F.col("state_code"), F.col("city_name")))
    # Different (state, city) pairs may concatenate to one key, which is unique in the dimension.
    unique = keyed.groupBy("location_key").agg(F.min(F.struct("state_code", "city_name")).alias("p"))
    return unique.select("location_key", "p.state_code", "p.city_name")


def wide_places(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Places kept out of the dimension because a text exceeds its declared width."""
    rows = places(customers, sellers)
    document = F.to_json(F.struct("state_code", "city_name"))
    return rows.select(
        F.lit(None).cast("bigint").alias("source_raw_id"),
        too_long(rows).alias("reject_reason"),
        document.alias("document"),
    ).filter("reject_reason is not null")


def dim_location(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """The places whose texts fit."""
    return conform(
        fits(places(customers, sellers)).select(
            "*", hash_key("location_key").alias("dim_location_id"), F.lit(True).alias("is_active")
        ),
        "warehouse.dim_location",
    )


def dim_product(items: DataFrame) -> DataFrame:
    priced = items.filter("product_id is not null").groupBy("product_id")
    return conform(
        priced.agg(mean(F.col("price"), "decimal(12,2)").alias("avg_price")).select(
            "*", hash_key("product_id").alias("dim_product_id"), F.lit(True).alias("is_active")
        ),
        "warehouse.dim_product",
    )


def dim_seller_scd(
    sellers: DataFrame, as_of: dt.date, existing: DataFrame | None = None, compat: bool = False
) -> DataFrame:
    snapshot = sellers.select("seller_id", "seller_state", "seller_city", "seller_zip_code_prefix")
    versions = (
        scd2.initial(snapshot, "seller_id", SELLER_TRACKED, as_of, compat)
        if existing is None
        else scd2.apply(existing, snapshot, "seller_id", SELLER_TRACKED, as_of, compat)
    )
    return conform(
        versions.withColumn("scd_id", hash_key("seller_id", "valid_from")),
        "warehouse.dim_seller_scd",
    )


# ---- fact -----------------------------------------------------------------------------------
def fct_orders(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    locations: DataFrame,
    customer_dim: DataFrame | None = None,
    strict_location: bool = False,
    blank_keys: str = "keep",
    grain: str = "line",
    by_month: bool = False,
    names: Star | None = None,
    renamed: DataFrame | None = None,
) -> DataFrame:
    """Order fact, one row per order and product (``grain="order"``: per order).

    ``customers`` and ``locations`` hold a key once. ``customer_dim`` is given when the customer
    dimension keeps more customers than ``customers``. A missing customer has the location key
    ``-``, which matches a place with blank state and city; ``strict_location`` forbids that.
    ``blank_keys="null"`` keeps blank ids from matching each other. ``by_month`` balances the rows over the tasks by
    order month, for a write that is partitioned by it.
    With ``names`` the rows have the natural keys that the dimensions of that star hold for the surrogate ones. They are
    looked up for the customers, the places and the items, which are fewer or narrower than the rows of the fact.
    ``renamed`` are the rows of renamed_products, where they are few enough to broadcast: items then need not meet the products.
    """
    if blank_keys == "null":
        orders = _blank_to_null(orders, ["order_id", "customer_id"])
        items = _blank_to_null(items, ["order_id", "product_id"])
        customers = _blank_to_null(customers, ["customer_id"])

    placed = _placed_orders(orders, customers, locations, customer_dim, strict_location, names)
    if grain == "order":
        bought, product = _order_sums(placed, items), []
    else:
        bought, product = _order_lines(orders, placed, items, names, renamed)
    zero = F.lit(0).cast("decimal(20,2)")
    # What an order has comes first, then what its lines have: neighbours differ in one stretch of a row only.
    rows = bought.select(
        *placed.columns,
        F.trunc("order_date", "month").alias("order_month"),
        *product,
        *[money(F.coalesce(c, zero), 18).alias(c) for c in ("price_amount", "freight_value")],
        "quantity",
    )
    if by_month:
        rows = rows.hint("rebalance", "order_month")
    # What follows from other columns is added after the rows have moved.
    date_id = F.when(in_calendar(F.col("order_date")), date_key(F.col("order_date")))
    total = money(F.col("price_amount") + F.col("freight_value"), 18)
    natural = [c for c in ("customer_id", "product_id", "location_key") if c in rows.columns]
    fact = conform(
        rows.withColumns({"dim_date_id": date_id, "total_order_value": total}),
        "warehouse.fct_orders",
        keep=natural,
    )
    return fact if names is None else fact.drop("dim_customer_id", "dim_product_id", "dim_location_id")


def _order_sums(placed: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with the sums of their items. Tasks add up before they deal, so an order has one small row per task and
    a hot one is as small as the others."""
    sums = items.groupBy("order_id").agg(
        F.count("order_item_id").cast("int").alias("quantity"),
        F.sum("price").alias("price_amount"),
        F.sum("freight_value").alias("freight_value"),
    )
    return placed.join(sums, "order_id", "left").withColumn("quantity", F.coalesce("quantity", F.lit(0)))


def _order_lines(
    orders: DataFrame, placed: DataFrame, items: DataFrame, names: Star | None, renamed: DataFrame | None
) -> tuple[DataFrame, list[Column]]:
    """Orders with a row per product, or one without any, and the column of the product's key."""
    # Items shrink to the fact's grain before they meet the orders. Product ids are hashes of the
    # natural key and the product dimension is built from the same items, so surrogate keys need no join.
    # Items are dealt by order once, for the filter on known orders, the sums and the join. The filter is a
    # join, which splits a hot order; only then the sums are dealt again, by order and product.
    bought = items.select(
        "order_id", "product_id", F.col("order_item_id").isNotNull().alias("counted"), "price", "freight_value"
    )
    products, key = ["product_id"], _key_or_null("product_id").alias("dim_product_id")
    if renamed is not None:
        key = F.col("product_id")
    elif names is not None:
        bought = _with_name(bought, key, names.dim_product, "product_id")
        # Products without a name stay apart by their own id.
        products, key = ["product_id", "_name"], F.col("_name").alias("product_id")
    # A semi join would be moved below those that the items had before, and all of them dealt by order; of an order there
    # is one row.
    lines = (
        bought.join(orders.select("order_id").hint("merge"), "order_id")
        .groupBy("order_id", *products)
        .agg(
            F.count_if("counted").cast("int").alias("quantity"),
            F.sum("price").alias("price_amount"),
            F.sum("freight_value").alias("freight_value"),
        )
    )
    # An outer join cannot split a hot order on its optional side. An inner one can, and the ids below are distinct.
    bought = lines.join(placed, "order_id")
    # The ids of a task are made distinct before they move, which costs less than the sums a second time. An anti join
    # would be moved below the one with the places, and the orders dealt by order twice.
    with_items = items.select("order_id").distinct().withColumn("_bought", F.lit(True))
    empty = placed.join(with_items, "order_id", "left").filter("_bought is null").select(
        *placed.columns,
        *[F.lit(None).cast("string").alias(c) for c in products],
        F.lit(0).alias("quantity"),
        F.lit(None).cast("decimal(20,2)").alias("price_amount"),
        F.lit(None).cast("decimal(20,2)").alias("freight_value"),
    )
    rows = bought.unionByName(empty)
    if renamed is not None:
        other = F.broadcast(renamed.select(F.col("product_id").alias("_own"), "_name", F.lit(True).alias("_other")))
        rows = rows.join(other, F.col("product_id") == F.col("_own"), "left")
        key = F.when(F.col("_other"), F.col("_name")).otherwise(F.col("product_id")).alias("product_id")
    return rows, [key]


def renamed_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Product ids of items for whose surrogate key the dimension holds another natural key, or none, with that key
    as ``_name``. A product is looked up once, not once per item."""
    sold = items.select("product_id").filter("product_id is not null").distinct()
    found = _with_name(sold, _key_or_null("product_id"), products, "product_id")
    return found.filter(~F.col("_name").eqNullSafe(F.col("product_id")))


def _with_name(df: DataFrame, surrogate: Column, dimension: DataFrame, natural: str) -> DataFrame:
    """The natural key that a dimension has for a surrogate one, as ``_name``. The surrogate key is made on both
    sides of the shuffle and does not move."""
    members = dimension.select(F.col(f"dim_{natural.rsplit('_', 1)[0]}_id").alias("_key"), F.col(natural).alias("_name"))
    return df.join(members, surrogate == F.col("_key"), "left").drop("_key")


def order_grain(fact: DataFrame) -> DataFrame:
    """The fact with the products of each order added up."""
    sums = ["quantity", "price_amount", "freight_value", "total_order_value"]
    keys = [c for c in fact.columns if c not in [*sums, "dim_product_id"]]
    return conform(
        fact.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]), "warehouse.fct_orders"
    )


def _placed_orders(
    orders: DataFrame,
    customers: DataFrame,
    locations: DataFrame,
    customer_dim: DataFrame | None,
    strict_location: bool,
    names: Star | None,
) -> DataFrame:
    """Orders with customer and location keys; one row per order."""
    at = customers.select(
        F.col("customer_id").alias("_customer"), "customer_state", "customer_city", F.lit(True).alias("has_customer")
    )
    members = None
    if customer_dim is not None:
        members = customer_dim.select(F.col("customer_id").alias("_customer"), F.lit(True).alias("in_dimension"))
    if names is not None:
        # A key is looked up once per customer and place, not once per order.
        keyed = _with_name(at if members is None else members, hash_key("_customer"), names.dim_customer, "customer_id")
        keyed = keyed.withColumnRenamed("_name", "_customer_name")
        at, members = (keyed, None) if members is None else (at, keyed)
    # Days take less room than the moments that they are taken from.
    known = orders.filter("order_id is not null").select(
        "order_id",
        F.col("customer_id").alias("_customer"),
        "order_status",
        "days_to_delivery",
        "is_on_time",
        F.col("order_purchase_timestamp").cast("date").alias("order_date"),
        F.col("order_delivered_customer_date").cast("date").alias("delivery_date"),
        F.col("order_estimated_delivery_date").cast("date").alias("estimated_delivery_date"),
        "data_quality_score",
    )
    placed = known.join(at, "_customer", "left")
    if members is not None:
        placed = placed.join(members, "_customer", "left")
    else:
        placed = placed.withColumn("in_dimension", F.col("has_customer"))
    key = location_key(F.col("customer_state"), F.col("customer_city"))
    if strict_location:
        key = F.when(
            F.col("has_customer") & (F.col("customer_state") != "") & (F.col("customer_city") != ""),
            key,
        )
    places = locations.select(F.col("location_key").alias("_place"), "dim_location_id")
    customer, place = F.when(F.col("in_dimension"), hash_key("_customer")).alias("dim_customer_id"), "dim_location_id"
    if names is not None:
        places = _with_name(places, F.col("dim_location_id"), names.dim_location, "location_key")
        customer, place = F.col("_customer_name").alias("customer_id"), F.col("_name").alias("location_key")
    return (
        placed.withColumn("_place", key)
        .join(places, "_place", "left")
        .select("order_id", customer, place, *[c for c in known.columns if c not in ("order_id", "_customer")])
    )


def _key_or_null(natural: str) -> Column:
    return F.when(F.col(natural).isNotNull(), hash_key(natural))


def _blank_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})


# ---- whole star -----------------------------------------------------------------------------
def build_star(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    as_of: dt.date,
    calendar: DataFrame | None = None,
    previous_sellers: DataFrame | None = None,
    locations: DataFrame | None = None,
) -> Star:
    """All tables of the star from the curated zone, in dependency order; the fact is balanced by month. ``locations``
    are the places where they are written already."""
    locations = dim_location(customers, sellers) if locations is None else locations
    return Star(
        fct_orders=fct_orders(orders, items, customers, locations, by_month=True),
        dim_date=dim_date(calendar if calendar is not None else order_date_range(orders)),
        dim_customer=dim_customer(customers, dt.datetime.combine(as_of, dt.time())),
        dim_product=dim_product(items),
        dim_location=locations,
        dim_seller_scd=dim_seller_scd(sellers, as_of, previous_sellers),
    )


# ---- reports --------------------------------------------------------------------------------
def labelled_counts(parts: list[tuple[str, DataFrame, Column]]) -> DataFrame:
    """One row (label, value) per aggregate."""
    rows = [
        df.agg(value.cast("decimal(20,2)").alias("value")).select(F.lit(label).alias("label"), "value")
        for label, df, value in parts
    ]
    return reduce(DataFrame.unionByName, rows)


def validation_report(star: Star) -> DataFrame:
    n = F.count("*")
    # Current and all seller versions come from one pass, orders and their value from another.
    sellers = _side_by_side(
        star.dim_seller_scd,
        {LABEL_SELLERS_CURRENT: F.count_if("is_current"), LABEL_SELLER_HISTORY: n},
    )
    fact = _side_by_side(
        star.fct_orders,
        {LABEL_ORDERS: n, LABEL_ORDER_VALUE: F.coalesce(F.sum("total_order_value"), F.lit(0))},
    )
    counts = labelled_counts(
        [
            (LABEL_DATES, star.dim_date, n),
            (LABEL_CUSTOMERS, star.dim_customer, n),
            (LABEL_PRODUCTS, star.dim_product, n),
            (LABEL_LOCATIONS, star.dim_location, n),
        ]
    )
    return counts.unionByName(sellers).unionByName(fact)


def _side_by_side(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    row = df.agg(*[v.cast("decimal(20,2)").alias(k) for k, v in values.items()])
    return row.unpivot([], [f"`{k}`" for k in values], "label", "value")


def warehouse_summary(fact: DataFrame) -> DataFrame:
    value = F.col("total_order_value")
    counted = {
        "unique_customers": F.col("dim_customer_id"),
        "unique_products": F.col("dim_product_id"),
        "unique_locations": F.col("dim_location_id"),
        "unique_order_dates": F.unix_date("order_date").cast("bigint"),
    }
    # The values of all columns below each other: a row that moves has one of them, not a place for each.
    kinds = F.array(*[F.struct(F.lit(n).alias("kind"), c.alias("v")) for n, c in enumerate(counted.values())])
    values = fact.select(F.explode(kinds).alias("x")).select("x.*").filter("v is not null").distinct()
    uniques = values.agg(*[F.count_if(F.col("kind") == n).alias(name) for n, name in enumerate(counted)])
    sums = fact.agg(
        F.sum(value).cast("decimal(38,2)").alias("total_revenue"),
        mean(value, "decimal(12,2)").alias("avg_order_value"),
        F.count("*").alias("total_orders"),
    )
    # Two single rows below each other, of which every column has one value.
    rows = uniques.unionByName(sums, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])
