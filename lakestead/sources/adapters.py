"""Order-entry tables (customer, supplier, orders, lineitem, part) as the source entities.

The tables are clean, so the adapter blanks or breaks some values by key arithmetic; every row of a
table becomes one row of its entity. ``raw_id`` is the row's key and becomes the document id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestead.functions.scalars import moment



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _ident(prefix: str, key: str, width: int) -> Column:
    """The key with leading zeros up to the width; a longer key stays whole."""
    digits = F.col(key).cast("string")
    return F.concat(F.lit(prefix), F.repeat(F.lit("0"), F.lit(width) - F.length(digits)), digits)


def _zip(key: str) -> Column:
    code = F.lpad((F.col(key) % 100000).cast("string"), 5, "0")
    return F.when(_every(key, 13), "123").otherwise(code)


def _region_code() -> Column:
    return F.lower(F.substring("r_name", 1, 2))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation with its region: fixed reference tables of 25 and 5 rows."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return F.broadcast(
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", "r_name"
        )
    )


def _blanks_as_null(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.nullif(F.col(n), F.lit("")) for n in names})


def customers(spark: SparkSession, sf_dir: str, blank_as_null: bool = False) -> DataFrame:
    k = "c_custkey"
    base = table(spark, sf_dir, "customer").join(
        _places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    city = (
        F.when(_every(k, 11), "")
        .when(_every(k, 7), F.concat(F.lit("  "), "n_name", F.lit(" ")))
        .otherwise(F.col("n_name"))
    )
    out = base.select(
        F.col(k).alias("raw_id"),
        F.when(_every(k, 19), "").otherwise(_ident("C", k, 8)).alias("customer_id"),
        F.when(_every(k, 23), "").otherwise(F.col("c_name")).alias("customer_unique_id"),
        _zip(k).alias("customer_zip_code_prefix"),
        city.alias("customer_city"),
        F.when(_every(k, 17), "").otherwise(_region_code()).alias("customer_state"),
    )
    return _blanks_as_null(out, out.columns[1:]) if blank_as_null else out


def sellers(spark: SparkSession, sf_dir: str, blank_as_null: bool = False) -> DataFrame:
    k = "s_suppkey"
    base = table(spark, sf_dir, "supplier").join(
        _places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    )
    out = base.select(
        F.col(k).alias("raw_id"),
        _ident("S", k, 8).alias("seller_id"),
        _zip(k).alias("seller_zip_code_prefix"),
        F.when(_every(k, 11), "").otherwise(F.col("n_name")).alias("seller_city"),
        F.when(_every(k, 11) | _every(k, 17), "").otherwise(_region_code()).alias("seller_state"),
    )
    return _blanks_as_null(out, out.columns[1:]) if blank_as_null else out


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "o_orderkey"
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias(k))
        .agg(F.max("l_shipdate").alias("last_ship"))
    )
    status = F.col("o_orderstatus")
    no_time = F.lit(None).cast("timestamp_ntz")
    base = table(spark, sf_dir, "orders")
    # Only delivered orders show their last day; the others stay where they are.
    delivered = status.eqNullSafe("F")
    never = F.lit(None).cast(shipped.schema["last_ship"].dataType).alias("last_ship")
    return (
        base.filter(delivered)
        .join(shipped, k, "left")
        .unionByName(base.filter(~delivered).select("*", never))
        .select(
            F.col(k).alias("raw_id"),
            _ident("O", k, 9).alias("order_id"),
            F.when(_every(k, 29), "").otherwise(_ident("C", "o_custkey", 8)).alias("customer_id"),
            F.when(_every(k, 31), "Invoiced")
            .when(status == "F", "Delivered")
            .when(status == "O", "shipped")
            .otherwise("pending")
            .alias("order_status"),
            F.when(~_every(k, 37), F.col("o_orderdate")).alias("order_purchase_timestamp"),
            no_time.alias("order_approved_at"),
            no_time.alias("order_delivered_carrier_date"),
            F.when(status == "F", F.col("last_ship")).alias("order_delivered_customer_date"),
            (
                F.col("o_orderdate")
                + F.make_dt_interval(days=(F.lit(700) + F.col(k) % 61).cast("int"))
            ).alias("order_estimated_delivery_date"),
        )
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("raw_id"),
        _ident("O", "l_orderkey", 9).alias("order_id"),
        _ident("P", "l_partkey", 8).alias("product_id"),
        _ident("S", "l_suppkey", 8).alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(12,2)").alias("freight_value"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "p_partkey"
    return table(spark, sf_dir, "part").select(
        F.col(k).alias("raw_id"),
        _ident("P", k, 8).alias("product_id"),
        F.when(_every(k, 9), "").otherwise(F.lower("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_length"),
        (F.length("p_name") + F.length("p_brand")).alias("product_description_length"),
        (F.col("p_size") % 5).alias("product_photos_qty"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One position per customer, on a grid by nation."""
    k = "c_custkey"
    base = table(spark, sf_dir, "customer").join(
        _places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    nation = F.col("c_nationkey").cast("double")
    return base.select(
        F.col(k).alias("raw_id"),
        _zip(k).alias("geolocation_zip_code_prefix"),
        F.when(~_every(k, 21), nation * 3.25 - 40.5).alias("geolocation_lat"),
        F.when(~_every(k, 22), nation * -2.5 + 10.125).alias("geolocation_lng"),
        F.concat(F.lit(" "), "n_name").alias("geolocation_city"),
        _region_code().alias("geolocation_state"),
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for every category of the parts but one, which has to fall back."""
    kinds = table(spark, sf_dir, "part").select(F.lower("p_type").alias("t")).distinct()
    return kinds.filter("t <> 'promo'").select(
        F.col("t").alias("product_category_name"),
        F.concat(F.lit("english_"), "t").alias("product_category_name_english"),
    )


def seller_snapshot(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Sellers as known on one of two days, or on a third one between them.

    Day 1 leaves out sellers in debt, day 2 those with a high balance, day 3 every third one. In between some sellers
    move, some get a new zip code only, and some cities become unknown.
    """
    k, moved = "s_suppkey", F.col("s_nationkey")
    if day > 1:
        moved = F.when(_every(k, 5 if day == 2 else 4), (moved + 1) % 25).otherwise(moved)
    base = table(spark, sf_dir, "supplier").withColumn("nation_now", moved)
    base = base.filter({1: "s_acctbal >= 0", 2: "s_acctbal <= 9000", 3: "s_suppkey % 3 <> 0"}[day])
    at = base.join(_places(spark, sf_dir), F.col("nation_now") == F.col("n_nationkey"))
    unknown = _every(k, {1: 23, 2: 19, 3: 17}[day])
    code = F.lpad((F.col(k) % 100000).cast("string"), 5, "0")
    if day == 2:
        code = F.when(_every(k, 7), "99999").otherwise(code)
    return at.select(
        _ident("S", k, 8).alias("seller_id"),
        F.upper(_region_code()).alias("seller_state"),
        F.when(~unknown, F.col("n_name")).alias("seller_city"),
        code.alias("seller_zip_code_prefix"),
    )


# One text for every engine: a document per customer with nested, null and missing values.
CUSTOMER_DOCUMENT = """
case when c_custkey % 41 = 0 then '{}' when c_custkey % 43 = 0 then null else concat(
 '{"customer_id":"C', repeat('0', 8 - length(cast(c_custkey as string))), cast(c_custkey as string),
 '","zip_code":', cast(c_custkey % 100000 as string),
 ',"balance":', cast(cast(c_acctbal as decimal(12,2)) as string),
 ',"state":', case when c_custkey % 17 = 0 then 'null' else concat('"', lower(substr(r_name, 1, 2)), '"') end,
 case when c_custkey % 5 = 0 then '' else concat(',"city":"', n_name, '"') end,
 ',"address":{"nation":"', n_name, '","tags":["', c_mktsegment, '","', r_name, '"]}',
 ',"active":', case when c_acctbal < 0 then 'false' else 'true' end, '}') end
"""


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows whose documents have nested, null and missing values; loaded over three days.

    The table is small and its documents are dear to work on, so its rows are dealt to all tasks.
    """
    tasks = spark.sparkContext.defaultParallelism
    base = table(spark, sf_dir, "customer").repartition(tasks, "c_custkey").join(
        _places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    first = moment(dt.datetime(2024, 1, 1))
    return base.select(
        F.col("c_custkey").alias("raw_id"),
        F.expr(CUSTOMER_DOCUMENT).alias("data"),
        F.lower("c_mktsegment").alias("source_table"),
        (first + F.make_dt_interval(days=(F.col("c_custkey") % 3).cast("int"))).alias("loaded_at"),
    )


ENTITIES = {
    "customers": customers,
    "sellers": sellers,
    "orders": orders,
    "order_items": order_items,
    "products": products,
    "geolocation": geolocation,
}
