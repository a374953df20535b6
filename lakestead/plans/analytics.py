"""Report catalogue on the star schema, and the data behind the charts.

The fact holds one row per order and product, so rows per product are orders; a region counts its
orders distinctly. Dimensions, the calendar among them, are left to the planner, which broadcasts them
only when they turn out small.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestead.fixed_values import (
    CHART_TOP,
    PIE_REST,
    PIE_TOP,
    PRODUCT_DASHBOARD_ROWS,
    PRODUCT_REPORT_ROWS,
    REGION_REPORT_ROWS,
    REPORT_MIN_ORDERS,
    REPORT_MIN_YEAR,
    SEGMENT_BOUNDS,
    TOP_SEGMENT,
)
from lakestead.functions.scalars import mean, percent, ratio, total
from lakestead.operators.percentile import exact_percentile
from lakestead.plans.warehouse import Star

Bounds = tuple[tuple[str, int], ...]
VALUE = "total_order_value"


# ---- regions --------------------------------------------------------------------------------
def _with_region(star: Star) -> DataFrame:
    places = star.dim_location.select("dim_location_id", F.col("state_code").alias("region"))
    return star.fct_orders.join(places, "dim_location_id", "left")


def _distinct(column: str, approx: bool) -> Column:
    return F.approx_count_distinct(column) if approx else F.count_distinct(column)


def sales_by_region_time(
    star: Star,
    min_year: int = REPORT_MIN_YEAR,
    rows: int = REGION_REPORT_ROWS,
    approx: bool = False,
) -> DataFrame:
    """Sales per region and month, newest months first, best regions first within a month."""
    # Equal to the calendar filter below; stated on the fact it prunes month partitions.
    recent = star.fct_orders.filter(F.col("order_month") >= F.lit(dt.date(min_year, 1, 1)))
    days = star.dim_date.filter(F.col("year") >= min_year).select("date_id", "year", "month")
    places = star.dim_location.select("dim_location_id", F.col("state_code").alias("region"))
    facts = recent.join(
        days, F.col("dim_date_id") == F.col("date_id")
    ).join(places, "dim_location_id", "left")
    grouped = facts.groupBy("region", "year", "month").agg(
        _distinct("order_id", approx).alias("order_count"),
        F.sum(VALUE).cast("decimal(38,2)").alias("total_sales"),
        mean(F.col(VALUE), "decimal(12,2)").alias("avg_order_value"),
        _distinct("dim_customer_id", approx).alias("unique_customers"),
        F.count_if("is_on_time").alias("on_time_deliveries"),
    )
    report = grouped.withColumn(
        "on_time_percentage", percent(F.col("on_time_deliveries"), F.col("order_count"))
    )
    return report.orderBy(
        F.desc_nulls_first("year"),
        F.desc_nulls_first("month"),
        F.desc_nulls_first("total_sales"),
        F.asc_nulls_last("region"),
    ).limit(rows)


def _regions(star: Star) -> DataFrame:
    return _with_region(star).groupBy("region").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum(VALUE).cast("decimal(38,2)").alias("total_sales"),
        mean(F.col(VALUE), "decimal(12,2)").alias("avg_order_value"),
        F.count_distinct("dim_customer_id").alias("unique_customers"),
        F.count_if("is_on_time").alias("on_time"),
    )


def dashboard_regional(star: Star) -> DataFrame:
    orders, customers = F.col("total_orders"), F.col("unique_customers")
    return (
        _regions(star)
        .select(
            "region",
            "total_orders",
            "total_sales",
            "avg_order_value",
            "unique_customers",
            percent(F.col("on_time"), orders, "decimal(12,1)").alias("on_time_pct"),
            ratio(F.col("total_sales"), orders, "decimal(38,2)").alias("revenue_per_order"),
            ratio(orders, customers, "decimal(12,2)").alias("orders_per_customer"),
        )
        .orderBy(F.desc_nulls_first("total_sales"), F.asc_nulls_last("region"))
    )


def dashboard_regional_totals(regional: DataFrame) -> DataFrame:
    """Totals over the regional rows: customers of several regions count once in each."""
    totals = regional.agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_sales").cast("decimal(38,2)").alias("total_sales"),
        F.sum("unique_customers").alias("total_unique_customers"),
    )
    return totals.withColumn(
        "avg_order_value", ratio(F.col("total_sales"), F.col("total_orders"), "decimal(38,2)")
    )


def chart_regions(star: Star) -> DataFrame:
    return (
        _regions(star)
        .filter("region is not null")
        .drop("on_time")
        .orderBy(F.desc("total_sales"), F.asc("region"))
    )


def chart_top_regions(regions: DataFrame, rows: int = CHART_TOP) -> DataFrame:
    """The best regions by sales and by orders."""

    def top(metric: str) -> DataFrame:
        best = regions.orderBy(F.desc(metric), F.desc("total_sales"), F.asc("region")).limit(rows)
        return best.select(
            F.lit(metric).alias("metric"),
            "region",
            F.col(metric).cast("decimal(38,2)").alias("value"),
        )

    return top("total_sales").unionByName(top("total_orders"))


def chart_region_boxstats(regions: DataFrame) -> DataFrame:
    """Box-plot numbers of three scaled metrics: quartiles, whiskers at 1.5 times the quartile
    distance, and values outside. ``regions`` has one row per two-letter region code."""
    scaled = regions.select(
        (F.col("total_sales").cast("double") / 1000000).alias("Sales ($M)"),
        (F.col("total_orders").cast("double") / 1000).alias("Orders (K)"),
        (F.col("avg_order_value").cast("double") / 100).alias("Avg Order ($100)"),
    )
    values = scaled.unpivot([], [f"`{c}`" for c in scaled.columns], "metric", "x")
    quartiles = values.groupBy("metric").agg(
        F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")
    )
    boxes = quartiles.select(
        "metric",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
        ((F.col("q")[2] - F.col("q")[0]) * 1.5).alias("reach"),
    )
    x = F.col("x")
    inside = (x >= F.col("q1") - F.col("reach")) & (x <= F.col("q3") + F.col("reach"))
    stats = (
        values.join(boxes, "metric")
        .groupBy("metric", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, x)).alias("low"),
            F.max(F.when(inside, x)).alias("high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )
    return stats.select(
        "metric",
        F.round("q1", 6).alias("q1"),
        F.round("median", 6).alias("median"),
        F.round("q3", 6).alias("q3"),
        F.round(F.least("low", "q1"), 6).alias("whisker_low"),
        F.round(F.greatest("high", "q3"), 6).alias("whisker_high"),
        "n_outliers",
    )


# ---- products -------------------------------------------------------------------------------
def _products(star: Star) -> DataFrame:
    """Sales per active product. The fact has one row per order and product, so rows are orders."""
    active = star.dim_product.filter("is_active").select("dim_product_id", "product_id", "avg_price")
    # Added up per product first: the join to the dimension then moves one row per product.
    sold = (
        star.fct_orders.filter("dim_product_id is not null")
        .groupBy("dim_product_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("quantity").alias("total_quantity"),
            total(F.col(VALUE)).alias("total_revenue"),
            mean(F.col(VALUE), "decimal(12,2)", total).alias("avg_order_value"),
        )
    )
    return sold.join(active, "dim_product_id")


def _best_products(star: Star, rows: int, min_orders: int | None) -> DataFrame:
    """The products with the highest revenue, with their customers.

    Customers are counted for the list only: it has ``rows`` rows at most, so it is broadcast to the fact, and the
    pairs of product and customer of no other product move.
    """
    products, order = _products(star), [F.desc_nulls_first("total_revenue"), F.asc("product_id")]
    if min_orders is not None:
        products = products.filter(F.col("orders") > min_orders)
    top = products.orderBy(*order).limit(rows)
    buyers = star.fct_orders.select("dim_product_id", "dim_customer_id").join(F.broadcast(top), "dim_product_id")
    # A product has one value of the others, which a report that does not show them need not add up.
    key = ["dim_product_id", "product_id", "total_revenue"]
    counted = buyers.groupBy(*key).agg(
        *[F.any_value(c).alias(c) for c in top.columns if c not in key],
        F.count_distinct("dim_customer_id").alias("unique_customers"),
    )
    return counted.drop("dim_product_id").orderBy(*order)


def product_performance(
    star: Star, min_orders: int = REPORT_MIN_ORDERS, rows: int = PRODUCT_REPORT_ROWS
) -> DataFrame:
    """Best-selling products with more than ``min_orders`` orders."""
    all_orders = star.fct_orders.agg(F.count_distinct("order_id").alias("all_orders"))
    return _best_products(star, rows, min_orders).select(
        "product_id",
        "orders",
        "total_quantity",
        "total_revenue",
        "avg_order_value",
        F.col("avg_price").cast("decimal(10,2)").alias("avg_product_price"),
        "unique_customers",
        percent(F.col("orders"), all_orders.scalar()).alias("pct_of_total_orders"),
    )


def top_products(
    star: Star, rows: int = PRODUCT_DASHBOARD_ROWS, min_orders: int | None = None
) -> DataFrame:
    return _best_products(star, rows, min_orders).select(
        "product_id",
        F.col("orders").alias("order_count"),
        F.col("total_quantity").alias("units_sold"),
        "total_revenue",
        "unique_customers",
    )


def _ranked(top: DataFrame) -> DataFrame:
    """Position in a top list; the window runs over the few rows of the list."""
    order = Window.orderBy(F.desc("total_revenue"), F.asc("product_id"))
    return top.withColumn("rank", F.row_number().over(order))


def dashboard_product(star: Star, rows: int = PRODUCT_DASHBOARD_ROWS) -> DataFrame:
    """Top products with rank and share of the list's revenue."""
    ranked = _ranked(top_products(star, rows))
    total = F.sum("total_revenue").over(Window.partitionBy())
    return ranked.withColumn("pct_of_total", percent(F.col("total_revenue"), total))


def chart_product_pie(top: DataFrame, slices: int = PIE_TOP) -> DataFrame:
    """The first products of a top list and one slice for the rest of that list."""
    label = F.when(F.col("rank") <= slices, F.col("product_id")).otherwise(F.lit(PIE_REST))
    return (
        _ranked(top)
        .groupBy(label.alias("slice"))
        .agg(F.sum("total_revenue").cast("decimal(38,2)").alias("revenue"))
        .withColumn(
            "pct", percent(F.col("revenue"), F.sum("revenue").over(Window.partitionBy()), "decimal(12,1)")
        )
    )


def chart_product_normalised(top: DataFrame, rows: int = CHART_TOP) -> DataFrame:
    """Orders and customers of the first products, each scaled to a maximum of 100."""
    first = _ranked(top).filter(F.col("rank") <= rows)
    everything = Window.partitionBy()

    def scaled(c: str) -> Column:
        return percent(F.col(c), F.max(c).over(everything), "decimal(12,4)")

    return first.select(
        "rank",
        "product_id",
        scaled("order_count").alias("orders_norm"),
        scaled("unique_customers").alias("customers_norm"),
    )


# ---- customers ------------------------------------------------------------------------------
def segment_of(value: Column, bounds: Bounds = SEGMENT_BOUNDS, top: str = TOP_SEGMENT) -> Column:
    """Segment of a lifetime value; NULL compares with nothing and ends in the top segment."""
    (name, limit), *others = bounds
    segment = F.when(value < limit, name)
    for name, limit in others:
        segment = segment.when(value < limit, name)
    return segment.otherwise(top)


def _customers(star: Star) -> DataFrame:
    """Orders and value per customer. The fact holds a customer key only when the dimension has
    it, so orders of unknown customers share the NULL key. Added up per order first, which spreads
    that key over all tasks."""
    per_order = star.fct_orders.groupBy("dim_customer_id", "order_id").agg(
        F.sum(VALUE).alias("value"), F.count(VALUE).alias("lines")
    )
    per_customer = per_order.groupBy("dim_customer_id").agg(
        F.count("*").alias("order_frequency"),
        F.sum("value").cast("decimal(24,2)").alias("customer_lifetime_value"),
        F.sum("lines").alias("lines"),
    )
    average = ratio(F.col("customer_lifetime_value"), F.col("lines"), "decimal(24,10)")
    return per_customer.withColumn("avg_order_value", average)


def customer_segments(star: Star, bounds: Bounds = SEGMENT_BOUNDS) -> DataFrame:
    ltv = F.col("customer_lifetime_value")
    return (
        _customers(star)
        .groupBy(segment_of(ltv, bounds).alias("customer_segment"))
        .agg(
            F.count("*").alias("segment_size"),
            mean(ltv, "decimal(18,2)").alias("avg_lifetime_value"),
            F.sum(ltv).cast("decimal(38,2)").alias("segment_total_value"),
            mean(F.col("order_frequency"), "decimal(18,6)").alias("avg_orders_per_customer"),
            mean(F.col("avg_order_value"), "decimal(18,6)").alias("segment_avg_order_value"),
        )
        .orderBy(F.desc_nulls_first("avg_lifetime_value"))
    )


def customer_segments_direct(
    customers: DataFrame, orders: DataFrame, items: DataFrame, bounds: Bounds = SEGMENT_BOUNDS
) -> DataFrame:
    """Segments straight from the curated tables. Customers without orders have no value and fall
    into the top segment; an item without freight adds nothing.

    Items are added up per order and orders per customer before each join, so no join sees a key
    twice on either side."""
    per_order = items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("order_value")
    )
    valid = orders.filter("is_valid").select("customer_id", "order_id")
    per_customer = (
        valid.join(per_order, "order_id", "left")
        .groupBy("customer_id")
        .agg(F.sum("order_value").cast("decimal(24,2)").alias("customer_lifetime_value"))
    )
    ltv = F.col("customer_lifetime_value")
    return (
        customers.filter("is_valid")
        .select("customer_id")
        .join(per_customer, "customer_id", "left")
        .groupBy(segment_of(ltv, bounds).alias("customer_segment"))
        .agg(
            F.count("*").alias("segment_size"),
            mean(ltv, "decimal(18,2)").alias("avg_lifetime_value"),
            F.sum(ltv).cast("decimal(38,2)").alias("segment_total_value"),
        )
        .orderBy(F.desc_nulls_first("avg_lifetime_value"))
    )


def _profiles(star: Star, bounds: Bounds) -> DataFrame:
    ltv = F.col("customer_lifetime_value")
    return _customers(star).select(segment_of(ltv, bounds).alias("segment"), ltv, "order_frequency")


def _share(column: str, out: str = "decimal(12,2)") -> Column:
    """Share of the sum over all segments, of which there are few."""
    return percent(F.col(column), F.sum(column).over(Window.partitionBy()), out)


def dashboard_customer(
    star: Star, bounds: Bounds = SEGMENT_BOUNDS, approx: bool = False
) -> DataFrame:
    """Segments with mean and median value and their shares of customers and revenue."""
    profiles = _profiles(star, bounds)
    ltv = F.col("customer_lifetime_value")
    segments = profiles.groupBy("segment").agg(
        F.count("*").alias("customer_count"),
        mean(ltv, "decimal(18,2)").alias("avg_ltv"),
        F.sum(ltv).cast("decimal(38,2)").alias("total_value"),
        mean(F.col("order_frequency"), "decimal(12,2)").alias("avg_orders"),
        *(
            [F.percentile_approx(ltv, 0.5).cast("decimal(18,2)").alias("median_ltv")]
            if approx
            else []
        ),
    )
    if not approx:
        medians = exact_percentile(
            profiles, ["segment"], "customer_lifetime_value", 0.5, 2, "decimal(18,2)"
        )
        segments = segments.join(
            medians.withColumnRenamed("percentile", "median_ltv"), "segment", "left"
        )
    return segments.select(
        "segment",
        "customer_count",
        "avg_ltv",
        "total_value",
        "avg_orders",
        "median_ltv",
        _share("customer_count").alias("pct_customers"),
        _share("total_value").alias("pct_revenue"),
    ).orderBy(F.desc_nulls_first("avg_ltv"))


def chart_segments(star: Star, bounds: Bounds = SEGMENT_BOUNDS) -> DataFrame:
    ltv = F.col("customer_lifetime_value")
    segments = _profiles(star, bounds).groupBy("segment").agg(
        F.count("*").alias("customer_count"),
        mean(ltv, "decimal(18,6)").alias("avg_lifetime_value"),
        F.sum(ltv).cast("decimal(38,2)").alias("segment_total_value"),
        mean(F.col("order_frequency"), "decimal(18,6)").alias("avg_orders"),
    )
    return segments.select(
        "*",
        _share("customer_count", "decimal(12,1)").alias("pct_customers"),
        _share("segment_total_value", "decimal(12,1)").alias("pct_revenue"),
    ).orderBy(F.desc_nulls_first("avg_lifetime_value"))
