"""Curated zone, star schema and reports: the traps with hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest

from lakestead.plans import analytics, curated, warehouse
from lakestead.schemas import conform, schema

DAY = dt.datetime(2018, 3, 5, 10)
AS_OF = dt.date(2024, 1, 1)


def frame(spark, table, rows):
    """Rows given as dicts; undeclared columns are NULL."""
    names = schema(table).names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema(table))


def order(order_id, customer_id="c1", on_time=False, **more):
    return {
        "order_id": order_id,
        "customer_id": customer_id,
        "order_status": "delivered",
        "order_purchase_timestamp": DAY,
        "is_on_time": on_time,
        "is_valid": True,
        "data_quality_score": Decimal("1.00"),
        **more,
    }


def item(n, order_id, product_id, price, freight):
    money = [None if v is None else Decimal(v) for v in (price, freight)]
    return {
        "order_item_id": n,
        "order_id": order_id,
        "product_id": product_id,
        "price": money[0],
        "freight_value": money[1],
    }


def customer(customer_id, state="SP", city="x"):
    return {
        "customer_id": customer_id,
        "customer_state": state,
        "customer_city": city,
        "is_valid": True,
        "data_quality_score": Decimal("1.00"),
    }


def star(spark, orders, items, customers, sellers=(), calendar=None):
    return warehouse.build_star(
        frame(spark, "curated.orders_refined", orders),
        frame(spark, "curated.order_items_refined", items),
        frame(spark, "curated.customers_refined", customers),
        frame(spark, "curated.sellers_refined", list(sellers)),
        AS_OF,
        calendar,
    )


def test_delivery_measures(spark):
    late = order("late", order_delivered_customer_date=DAY + dt.timedelta(days=9, hours=20))
    early = order("early", order_delivered_customer_date=DAY + dt.timedelta(days=1))
    shipped = order("shipped", order_delivered_customer_date=DAY, order_status="shipped")
    rows = [
        {**o, "order_estimated_delivery_date": DAY + dt.timedelta(days=3), "source_raw_id": i}
        for i, o in enumerate([late, early, shipped, order("open")])
    ]
    got = {r.order_id: r for r in curated.orders_refined(frame(spark, "processed.orders", rows)).collect()}
    assert (got["late"].days_to_delivery, got["late"].is_on_time) == (10, False)
    assert (got["early"].days_to_delivery, got["early"].is_on_time) == (1, True)
    assert got["shipped"].is_on_time is False
    assert (got["open"].days_to_delivery, got["open"].is_on_time) == (None, False)
    assert got["open"].purchase_month == dt.date(2018, 3, 1)


def test_order_loaded_twice_leaves_one_row(spark):
    rows = [{**order("o"), "source_raw_id": n} for n in (1, 2)]
    orders = frame(spark, "processed.orders", rows)
    assert curated.orders_refined(orders).count() == 1
    assert curated.orders_refined(orders, dedupe=False).count() == 2


def test_on_time_share_counts_lines_at_line_grain(spark):
    s = star(
        spark,
        [order("o", on_time=True)],
        [item(1, "o", "p1", "10", "1"), item(2, "o", "p2", "5", "1")],
        [customer("c1")],
    )
    at = analytics.sales_by_region_time(s)
    assert at.first().on_time_percentage == Decimal("200.00")
    per_order = warehouse.Star(**{**s.__dict__, "fct_orders": warehouse.order_grain(s.fct_orders)})
    row = analytics.sales_by_region_time(per_order).first()
    assert (row.on_time_percentage, row.total_sales) == (Decimal("100.00"), Decimal("17.00"))


def test_unknown_freight_counts_in_the_star_but_not_directly(spark):
    items = [item(1, "o", "p", "10.00", None)]
    s = star(spark, [order("o")], items, [customer("c1")])
    assert s.fct_orders.first().total_order_value == Decimal("10.00")
    direct = analytics.customer_segments_direct(
        frame(spark, "curated.customers_refined", [customer("c1")]),
        frame(spark, "curated.orders_refined", [order("o")]),
        frame(spark, "curated.order_items_refined", items),
    ).first()
    assert (direct.customer_segment, direct.segment_total_value) == ("Platinum", None)


def test_customer_without_orders_is_platinum(spark):
    got = analytics.customer_segments_direct(
        frame(spark, "curated.customers_refined", [customer("c1"), customer("c2")]),
        frame(spark, "curated.orders_refined", [order("o")]),
        frame(spark, "curated.order_items_refined", [item(1, "o", "p", "10", "2")]),
    ).collect()
    assert {(r.customer_segment, r.segment_size) for r in got} == {("Platinum", 1), ("Bronze", 1)}


def test_order_of_unknown_customer_meets_the_blank_place(spark):
    customers = [customer("c1"), customer("c2", state="", city="")]
    orders, items = [order("o", customer_id="gone")], [item(1, "o", "p", "1", "1")]
    s = star(spark, orders, items, customers)
    row = s.fct_orders.join(s.dim_location, "dim_location_id").first()
    assert (row.location_key, row.dim_customer_id) == ("-", None)
    strict = warehouse.fct_orders(
        frame(spark, "curated.orders_refined", orders),
        frame(spark, "curated.order_items_refined", items),
        frame(spark, "curated.customers_refined", customers),
        s.dim_location,
        strict_location=True,
    )
    assert strict.first().dim_location_id is None


def test_blank_keys_join_unless_told_otherwise(spark):
    customers = [customer("", state="RJ")]
    orders, items = [order("o", customer_id="")], []
    s = star(spark, orders, items, customers)
    assert s.fct_orders.first().dim_customer_id is not None
    apart = warehouse.fct_orders(
        frame(spark, "curated.orders_refined", orders),
        frame(spark, "curated.order_items_refined", items),
        frame(spark, "curated.customers_refined", customers),
        s.dim_location,
        blank_keys="null",
    )
    assert apart.first().dim_customer_id is None


def test_order_without_items_stays_with_zero_values(spark):
    row = star(spark, [order("o")], [], [customer("c1")]).fct_orders.first()
    assert (row.quantity, row.total_order_value, row.dim_product_id) == (0, Decimal("0.00"), None)


def test_customer_kept_by_the_dimension_only(spark):
    orders = frame(spark, "curated.orders_refined", [order("o", customer_id="old")])
    items = frame(spark, "curated.order_items_refined", [])
    now = frame(spark, "curated.customers_refined", [customer("c1")])
    dimension = warehouse.dim_customer(
        frame(spark, "curated.customers_refined", [customer("c1"), customer("old")])
    )
    places = warehouse.dim_location(now, frame(spark, "curated.sellers_refined", []))
    assert warehouse.fct_orders(orders, items, now, places).first().dim_customer_id is None
    kept = warehouse.fct_orders(orders, items, now, places, customer_dim=dimension).first()
    assert kept.dim_customer_id is not None and kept.dim_location_id is None


def test_purchase_date_outside_the_calendar(spark):
    far = order("far", order_purchase_timestamp=dt.datetime(2031, 1, 1))
    calendar = warehouse.calendar_range(spark)
    s = star(spark, [order("o"), far], [], [customer("c1")], calendar=calendar)
    assert s.dim_date.count() == 4018 and s.fct_orders.count() == 2
    assert analytics.sales_by_region_time(s).count() == 1
    derived = star(spark, [order("o"), far], [], [customer("c1")])
    assert analytics.sales_by_region_time(derived).count() == 2


def test_region_without_a_place_is_kept_except_in_charts(spark):
    s = star(
        spark,
        [order("a"), order("b", customer_id="gone")],
        [item(1, "a", "p", "10", "1"), item(2, "b", "p", "5", "1")],
        [customer("c1")],
    )
    assert {r.region for r in analytics.sales_by_region_time(s).collect()} == {"SP", None}
    assert {r.region for r in analytics.dashboard_regional(s).collect()} == {"SP", None}
    assert {r.region for r in analytics.chart_regions(s).collect()} == {"SP"}


def test_calendar_attributes(spark):
    bounds = warehouse.calendar_range(spark, "2016-12-31", "2017-01-02")
    got = warehouse.dim_date(bounds).orderBy("date_id").collect()
    assert [r.date_id for r in got] == [20161231, 20170101, 20170102]
    assert [r.week for r in got] == [52, 52, 1]
    assert [r.day_of_week for r in got] == ["Sat", "Sun", "Mon"]
    assert [r.is_weekend for r in got] == [True, True, False]


def test_segments_and_shares(spark):
    customers = [customer(f"c{i}") for i in range(5)]
    spent = ["100", "900", "4999", "20000", "1"]
    orders = [order(f"o{i}", customer_id=f"c{i}") for i in range(5)]
    items = [item(i, f"o{i}", "p", v, None) for i, v in enumerate(spent)]
    s = star(spark, orders, items, customers)
    got = {r.segment: r for r in analytics.dashboard_customer(s).collect()}
    assert {k: r.customer_count for k, r in got.items()} == {"Bronze": 3, "Silver": 1, "Platinum": 1}
    assert got["Bronze"].median_ltv == Decimal("100.00")
    assert sum(r.pct_customers for r in got.values()) == pytest.approx(100)
    approx = {r.segment: r.median_ltv for r in analytics.dashboard_customer(s, approx=True).collect()}
    assert approx == {k: r.median_ltv for k, r in got.items()}


def test_conform_fills_absent_columns(spark):
    df = conform(spark.createDataFrame([("a",)], "seller_id string"), "curated.sellers_refined")
    assert df.columns == schema("curated.sellers_refined").names
    assert df.first().seller_city is None


def test_location_key_over_its_width_is_left_out(spark):
    places = warehouse.dim_location(
        frame(spark, "curated.customers_refined", [customer("a", city="x" * 48), customer("b")]),
        frame(spark, "curated.sellers_refined", []),
    )
    assert [r.location_key for r in places.collect()] == ["SP-x"]
