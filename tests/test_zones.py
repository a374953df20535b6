"""Files, catalog, the whole refresh and the incremental loads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakestead.operators import checks
from lakestead.plans import lineage, refresh, warehouse
from lakestead.registry.frames import Frames
from lakestead.schemas import schema
from lakestead.session import scratch_dir
from lakestead.sources import adapters, catalog, files
from lakestead.streaming import incremental

SF = "/root/testdata/sf0.001"
LOAD = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def built(spark):
    return Frames(spark, SF).written


def test_csv_with_byte_order_mark_and_crlf(spark, tmp_path):
    text = "﻿product_category_name,product_category_name_english\r\ncama,bed\r\n\"a,b\",\r\n"
    (tmp_path / "names.csv").write_bytes(text.encode("utf-8"))
    tables = files.scan_csv_folder(
        spark, str(tmp_path), {"names": schema("source.category_translation")}
    )
    assert [tuple(r) for r in tables["names"].collect()] == [("cama", "bed"), ("a,b", None)]


def test_leading_zero_of_a_zip_survives_a_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("s", "01037", " x ", "SP")], schema("source.sellers"))
    files.write_csv(df, str(tmp_path / "sellers.csv"))
    again = files.scan_csv_folder(spark, str(tmp_path), {"sellers": schema("source.sellers")})
    assert tuple(again["sellers"].first()) == ("s", "01037", " x ", "SP")


def test_zones_in_the_catalog(spark, tmp_path):
    catalog.create_zone(spark, "zone_t", str(tmp_path / "zone_t"))
    spark.range(3).write.mode("overwrite").saveAsTable("zone_t.numbers")
    assert catalog.tables(spark, "zone_t") == ["numbers"]
    assert ("zone_t",) in [tuple(r) for r in catalog.zones(spark).collect()]
    columns = catalog.table_columns({"numbers": spark.table("zone_t.numbers")})
    assert [tuple(r) for r in columns.collect()] == [("numbers", "id", 1, "bigint", 3, 0)]
    catalog.drop_zone(spark, "zone_t")
    assert ("zone_t",) not in [tuple(r) for r in catalog.zones(spark).collect()]


def test_written_zones_equal_the_lazy_ones(spark, built, rows):
    lake = built
    lazy = Frames(spark, SF)
    for name in ("fct_orders", "dim_customer", "dim_product", "dim_location", "dim_date"):
        written, plan = getattr(lake.star, name), getattr(lazy, name)
        assert rows(written, *plan.columns) == rows(plan), name
    items = ["order_item_id", "price", "freight_value"]
    assert rows(lake.items, *items) == rows(lazy.items, *items)


def test_running_a_load_again_adds_nothing(spark, built):
    store = files.ZoneStore(spark, scratch_dir(spark, "test-again"))
    customers = adapters.customers(spark, SF)
    counts = []
    for _ in range(2):
        refresh.ingest(store, "customers", customers, LOAD, raw_id="raw_id")
        star = refresh.load_star(
            store, built.orders, built.items, built.customers, built.sellers, LOAD.date()
        )
        counts.append((store.read("raw", "customers_raw").count(), star.fct_orders.count()))
    assert counts[0] == counts[1] == (customers.count(), built.star.fct_orders.count())
    assert store.read("raw", "data_metadata").count() == 1


def test_audit_of_a_refresh(spark, built):
    row = lineage.raw_lineage(built.store.read("raw", "data_metadata")).first()
    sources = [adapter(spark, SF) for adapter in adapters.ENTITIES.values()]
    assert (row.load_events, row.records) == (6, sum(df.count() for df in sources))


def test_fact_keys_all_lead_to_a_dimension(built):
    star = built.star
    for key, parent, parent_key in [
        ("dim_customer_id", star.dim_customer, "dim_customer_id"),
        ("dim_product_id", star.dim_product, "dim_product_id"),
        ("dim_location_id", star.dim_location, "dim_location_id"),
        ("dim_date_id", star.dim_date, "date_id"),
    ]:
        assert checks.orphans(star.fct_orders, parent, key, parent_key).count() == 0, key


def test_fact_adds_up_to_the_items(built):
    lake = built
    total = lake.star.fct_orders.agg(F.sum("total_order_value")).first()[0]
    placed = lake.items.join(lake.orders, "order_id", "left_semi")
    assert total == placed.agg(F.sum("total_item_value")).first()[0]


def test_replacing_one_month_leaves_the_others(spark, built):
    lake = built
    store = files.ZoneStore(spark, scratch_dir(spark, "months"))
    fact = lake.star.fct_orders
    store.overwrite("warehouse", "fct", fact, "order_month")
    before = fact.count()
    month = fact.agg(F.max("order_month")).first()[0]
    changed = fact.filter(F.col("order_month") == F.lit(month)).withColumn("quantity", F.lit(77))
    after = store.overwrite("warehouse", "fct", changed, "order_month", only_touched=True)
    assert after.count() == before
    assert after.filter("quantity = 77").count() == changed.count()


def test_quarantine_holds_the_document(spark):
    store = files.ZoneStore(spark, scratch_dir(spark, "quarantine"))
    raw = spark.createDataFrame([(1, '{"seller_id":'), (2, '{"seller_id":"s"}')], "raw_id long, data string")
    good = refresh.clean(store, "sellers", raw)
    assert [r.seller_id for r in good.collect()] == ["s"]
    bad = refresh.quarantine(store, "sellers").collect()
    assert [tuple(r) for r in bad] == [(1, "malformed document", '{"seller_id":')]


def test_table_replaced_from_itself(spark):
    store = files.ZoneStore(spark, scratch_dir(spark, "replace"))
    first = store.overwrite("z", "t", spark.range(5))
    assert store.overwrite("z", "t", first.filter("id > 1")).count() == 3


def test_seller_history_over_two_refreshes(spark, built):
    lake = built
    moved = lake.sellers.withColumn("seller_city", F.concat("seller_city", F.lit("!")))
    later = warehouse.dim_seller_scd(moved, dt.date(2024, 2, 1), lake.star.dim_seller_scd)
    n = lake.sellers.count()
    assert later.count() == 2 * n and later.filter("is_current").count() == n


def test_events_repeated_late_and_out_of_order_are_stored_once(spark, rows):
    """Several files in one batch, or one file per batch: the same rows and the same statistics."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    last, first = (events.orderBy(F.col("ts").desc() if d else F.col("ts")).limit(40) for d in (1, 0))
    want = rows(events)
    for per_batch in (1, 1000):
        base = scratch_dir(spark, "late")
        for n, part in enumerate([last, events, first, events.limit(7), events.limit(0)]):
            part.coalesce(1).write.parquet(f"{base}/in/{n}")
        for _ in range(2):
            stream = incremental.file_stream(spark, f"{base}/in/*", events.schema, files_per_batch=per_batch)
            incremental.ingest_once(stream, "event_id", "ts", f"{base}/out", f"{base}/state")
            stream = incremental.file_stream(spark, f"{base}/in/*", events.schema, files_per_batch=per_batch)
            incremental.load_stats_per_hour(
                stream, "event_id", "ts", "event_type", "value", f"{base}/s", f"{base}/state-2"
            )
        assert rows(incremental.ingested(spark, f"{base}/out"), *events.columns) == want
        stats = spark.read.parquet(f"{base}/s/stats").drop("_day")
        assert rows(stats) == rows(incremental.hourly_stats(events, "ts", "event_type", "value"))


def test_seller_history_of_many_days_in_any_batches(spark, rows):
    """Twelve days, each delivered twice; all in one batch, or a file per batch."""
    sellers = spark.createDataFrame([(f"s{i}", "SP", f"c{i}", "01000") for i in range(3)], schema("source.sellers"))
    found = []
    for per_batch in (1, 1000):
        base = scratch_dir(spark, "days")
        store = files.ZoneStore(spark, base)
        for day in range(12):
            moved = sellers.withColumn("seller_city", F.concat("seller_city", F.lit(f"-{day // 4}")))
            dated = moved.withColumn("day", F.lit(dt.date(2024, 1, 1 + day)))
            dated.union(dated).coalesce(1).write.parquet(f"{base}/in/{day:02}")
        stream = incremental.file_stream(spark, f"{base}/in/*", dated.schema, files_per_batch=per_batch)
        incremental.apply_seller_snapshots(stream, store, "history", "day", f"{base}/state")
        history = store.read("warehouse", "history")
        assert history.filter("is_current").count() == 3 and history.count() == 9
        found.append(rows(history, "seller_id", "seller_city", "valid_from", "valid_to", "is_current"))
    assert found[0] == found[1]


def test_long_keys_stay_whole(spark):
    keys = spark.createDataFrame([(1234567890,), (1234567891,), (7,), (123456789012,)], "k long")
    got = [r[0] for r in keys.select(adapters._ident("O", "k", 9)).collect()]
    assert got == ["O1234567890", "O1234567891", "O000000007", "O123456789012"]


def test_csv_quotes_breaks_and_bad_numbers(spark, tmp_path):
    text = 'order_id,product_id,seller_id,shipping_limit_date,price,freight_value\n'
    text += 'O1,"P ""x"" 1",S1,2018-01-01,1.5,2\nO2,"a\nb",S1,,,\nO3,P,S,2018-01-01,abc,1\n'
    (tmp_path / "order_items.csv").write_text(text)
    assert files.csv_tables(spark, str(tmp_path)) == {"order_items": str(tmp_path / "order_items.csv")}
    items = files.scan_csv(
        spark, str(tmp_path / "order_items.csv"), schema("source.order_items"), multi_line=True, corrupt=True
    ).collect()
    assert [(r.order_id, r.product_id, r._corrupt_record) for r in items] == [
        ("O1", 'P "x" 1', None), ("O2", "a\nb", None), ("O3", "P", "O3,P,S,2018-01-01,abc,1"),
    ]


def test_rows_in_are_rows_accepted_and_rejected(spark):
    """Over two loads, with wide states, a broken document and a repeated delivery."""
    store = files.ZoneStore(spark, scratch_dir(spark, "whole"))
    customers = adapters.customers(spark, SF).withColumn(
        "customer_state", F.when(F.col("raw_id") % 4 == 0, "XXXX").otherwise(F.col("customer_state"))
    )
    for day, part in ((1, "raw_id % 2 = 0"), (2, "raw_id > 10")):
        documents = refresh.ingest(store, "customers", customers.filter(part), dt.datetime(2024, 1, day), "raw_id")
        good = refresh.clean(store, "customers", documents)
    assert documents.count() == customers.filter("raw_id % 2 = 0 or raw_id > 10").count() == good.count()
    kept = refresh.curate(store, "customers")
    wide = store.read("quarantine", "rows").filter("zone = 'curated'")
    valid = good.filter("is_valid")
    assert wide.count() == valid.filter("length(customer_state) > 2").count() > 0
    assert wide.filter("document is null").count() == 0
    fitting = valid.filter("length(customer_state) <= 2").select("customer_id").distinct().count()
    assert kept.count() == fitting


def test_wide_places_are_quarantined(spark, built):
    long = built.customers.limit(1).withColumn("customer_city", F.lit("x" * 60))
    bad = warehouse.wide_places(built.customers.union(long), built.sellers).collect()
    assert len(bad) == 1 and "x" * 60 in bad[0].document
    assert warehouse.dim_location(long, built.sellers.limit(0)).count() == 0
