"""Shape of the physical plans."""

import datetime as dt
import re

from pyspark.sql import Window, functions as F

from lakestead.plans import analytics, curated, warehouse
from lakestead.registry.frames import Frames
from lakestead.registry.queries import QUERIES, _natural
from lakestead.schemas import schema
from lakestead.session import Scratch, scratch_dir
from lakestead.sources.files import ZoneStore, csv_tables, scan_csv, write_csv
from lakestead.sources.index import ContentIndex

SF = "/root/testdata/sf0.001"

def plan_of(df):
    """The formatted physical plan, which names every scanned column and pushed filter."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_scan_reads_only_the_columns_a_report_needs(spark):
    star = Frames(spark, SF).written.star
    plan = plan_of(analytics.sales_by_region_time(star, 1999))
    reads = [s for s in re.findall(r"ReadSchema: struct<(.*)>", plan) if "total_order_value" in s]
    assert reads and all("price_amount" not in s and "order_status" not in s for s in reads)
    assert re.search(r"PartitionFilters: \[[^]]*order_month[^]]*>= 1999-01-01", plan)


def test_filters_reach_the_scan(spark):
    star = Frames(spark, SF).written.star
    plan = plan_of(star.dim_seller_scd.filter("is_current").select("seller_id"))
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]" in plan


def test_documents_are_parsed_once(spark):
    frames = Frames(spark, SF)
    plan = frames.items._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_fact_is_stored_by_month(spark):
    fact = Frames(spark, SF).written.star.fct_orders
    assert all("order_month=" in path for path in fact.inputFiles())


def test_scratch_folders_go_with_their_block(spark):
    def kept(path):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)

    with Scratch(spark) as outer:
        with Scratch(spark) as inner:
            paths = [scratch_dir(spark, "own")]
            with inner.outside():
                paths.append(scratch_dir(spark, "result"))
            for path in paths:
                spark.range(3).write.parquet(path)
        assert [kept(p) for p in paths] == [False, True] and outer.paths == paths[1:]
        assert spark.read.parquet(paths[1]).count() == 3
    assert not kept(paths[1])
    with Scratch(spark) as last:
        with last.outside():
            free = scratch_dir(spark, "free")
            spark.range(1).write.parquet(free)
    assert kept(free)


# ---- what a refresh moves -------------------------------------------------------------------
def test_items_are_dealt_once_for_the_fact(spark):
    lake = Frames(spark, SF).written
    fact = warehouse.fct_orders(lake.orders, lake.items, lake.customers, lake.star.dim_location)
    dealt = [line for line in plan_of(fact).splitlines() if "hashpartitioning(order_id" in line]
    assert dealt and not any("product_id" in line for line in dealt)


def test_a_load_is_written_unsorted_and_indexed_by_short_digests(spark):
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 1
    store = Frames(spark, SF).written.store
    seen, raw = store.read("raw", "orders_raw_seen"), store.read("raw", "orders_raw")
    assert {r[0] for r in seen.select(F.length("content")).distinct().collect()} == {16}
    assert seen.schema["content"].dataType.typeName() == "binary"
    assert seen.count() == raw.select("file_hash").distinct().count()


def test_a_load_is_in_the_order_of_its_key(spark):
    raw = Frames(spark, SF).written.store.read("raw", "order_items_raw")
    place = Window.partitionBy("file").orderBy("at")
    rows = raw.select(F.col("_metadata.file_path").alias("file"), "raw_id", F.monotonically_increasing_id().alias("at"))
    falls = rows.withColumn("before", F.lag("raw_id").over(place)).filter("raw_id < before")
    assert raw.count() == 6000 and falls.count() == 0


def test_rows_of_the_fact_move_to_their_month_without_what_follows_from_them(spark):
    lake = Frames(spark, SF).written
    star = warehouse.build_star(lake.orders, lake.items, lake.customers, lake.sellers, dt.date(2024, 1, 1))
    plan = star.fct_orders._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RebalancePartitions") :]
    assert "dim_product_id" in below and "date_id" not in below and "total_order_value" not in below


def test_only_customers_of_listed_products_are_counted(spark):
    star = Frames(spark, SF).written.star
    sums = [s for s in re.findall(r"ReadSchema: struct<(.*)>", plan_of(analytics.top_products(star))) if "quantity" in s]
    assert sums and all("dim_customer_id" not in s for s in sums)


def test_orders_move_only_where_an_id_is_repeated(spark, rows):
    source = Frames(spark, SF).processed("orders").filter("source_raw_id < 40")
    worse = source.filter("source_raw_id % 7 = 0").withColumns(
        {"source_raw_id": F.col("source_raw_id") + 1000, "order_status": F.lit("worse")}
    )
    both = source.unionByName(worse)
    repeated = curated.repeated_orders(both)
    assert repeated.count() == worse.filter("is_valid").count() > 0
    once = curated.orders_refined(both, keep=["source_raw_id"], repeated=repeated)
    assert rows(once) == rows(curated.orders_refined(both, keep=["source_raw_id"]))
    assert rows(once) == rows(curated.orders_refined(source, keep=["source_raw_id"]))
    lake = Frames(spark, SF).written
    assert lake.store.read("staging", "repeated_orders").count() == 0


def test_contents_of_a_later_load_are_dealt_once(spark, monkeypatch):
    store = ZoneStore(spark, scratch_dir(spark, "dealt"))
    index, written = ContentIndex(store, "raw", "t"), []
    write = ContentIndex._write

    def noted(self, rows, kind, *partitions):
        written.append((kind, len(re.findall(r"Arguments: hashpartitioning\(", plan_of(rows)))))
        write(self, rows, kind, *partitions)

    monkeypatch.setattr(ContentIndex, "_write", noted)
    contents = spark.range(50).select(F.col("id").cast("string").alias("content"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for load in ("1", "2", "1"):
            index.enter(contents, load)
        index.enter(contents.unionByName(contents.select(F.concat("content", F.lit("x")).alias("content"))), "3")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Nothing is new in the second load; the first, run again, meets no other.
    assert [kind for kind, _ in written] == ["seen", "again", "seen", "again", "seen"]
    assert [n for kind, n in written if kind == "again"] == [2, 2]
    assert store.read("raw", "t_seen").groupBy("load_id").count().orderBy("load_id").collect() == [(1, 50), (3, 50)]


def test_sums_of_the_fact_meet_the_dimensions(spark):
    plan = plan_of(QUERIES["fct_orders_strict"](spark, SF))
    assert "dim_product/" not in plan


def test_csv_files_may_be_compressed(spark, rows):
    base = scratch_dir(spark, "gz")
    df = Frames(spark, SF).source("sellers").drop("raw_id")
    write_csv(df, f"{base}/sellers.csv", "gzip")
    read = scan_csv(spark, csv_tables(spark, base)["sellers"], schema("source.sellers"))
    assert all(name.endswith(".csv.gz") for name in read.inputFiles())
    assert rows(read.fillna("")) == rows(df.fillna(""))


def dealt(plan, key):
    """How often rows are dealt by a key."""
    return len(re.findall(rf"Arguments: hashpartitioning\({key}", plan))


def without_broadcast(spark, build):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return build()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_sums_of_an_order_and_not_its_items_are_dealt(spark):
    plan = without_broadcast(spark, lambda: plan_of(QUERIES["fct_orders_order_grain"](spark, SF)))
    assert "product_id" not in plan
    # Orders and sums, each once; tasks add up before they deal.
    assert dealt(plan, "order_id") == 2 and "partial_sum(price" in plan
    # Orders meet the customers once; surrogate keys are looked up per customer.
    assert dealt(plan, "_customer") == 2 and dealt(plan, r"xxhash64\(_customer") == 1
    assert "hashpartitioning(dim_customer_id" not in plan


def test_sums_per_order_equal_those_of_its_lines(spark, rows):
    lake = Frames(spark, SF).written
    extra = lake.items.limit(1).withColumns({"order_id": F.lit("unknown"), "order_item_id": F.lit(-1).cast("bigint")})
    some = lake.items.filter("order_item_id % 3 <> 0").unionByName(extra)
    tables = (lake.orders, some, lake.customers, lake.star.dim_location)
    lines = warehouse.fct_orders(*tables)
    assert lines.filter("quantity = 0").count() > 0
    per_order = warehouse.fct_orders(*tables, grain="order")
    assert rows(per_order) == rows(warehouse.order_grain(lines)) and per_order.count() == lake.orders.count()


def test_items_and_not_rows_of_the_fact_meet_the_products(spark):
    plan = without_broadcast(spark, lambda: plan_of(QUERIES["fct_orders"](spark, SF)))
    # Items meet products, then orders; rows of the fact stay where they were made.
    assert not re.search(r"hashpartitioning\(dim_(customer|product)_id", plan) and dealt(plan, "order_id") >= 3
    assert "product_id" not in "".join(re.findall(r"hashpartitioning\(order_id.*", plan))


# ---- what a first load, the star and its reports move ---------------------------------------
def test_contents_of_a_first_load_stay_where_they_are(spark, rows, monkeypatch):
    store, plans = ZoneStore(spark, scratch_dir(spark, "first")), []
    write = ContentIndex._write

    def noted(self, df, kind, *partitions):
        plans.append(plan_of(df))
        write(self, df, kind, *partitions)

    monkeypatch.setattr(ContentIndex, "_write", noted)
    number = spark.range(500).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("content"))
    ContentIndex(store, "raw", "single").enter(number, "1")
    assert "Exchange" not in plans[0] and store.read("raw", "single_seen").count() == 500
    thrice = number.unionByName(number.limit(7)).unionByName(number.limit(3))
    ContentIndex(store, "raw", "some").enter(thrice, "1")
    monkeypatch.setattr("lakestead.sources.index.MOST_REPEATED", 2)
    ContentIndex(store, "raw", "many").enter(thrice, "1")
    for table in ("some", "many"):
        seen = store.read("raw", f"{table}_seen")
        assert rows(seen, "content", "bucket") == rows(store.read("raw", "single_seen"), "content", "bucket")


def test_orders_move_to_their_month_without_what_follows_from_them(spark, rows):
    source = Frames(spark, SF).processed("orders")
    moved = curated.orders_refined(source, keep=["source_raw_id"], by_month=True)
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RebalancePartitions") :]
    assert "purchase_month" in below and "days_to_delivery" not in below and "is_on_time" not in below
    assert rows(moved) == rows(curated.orders_refined(source, keep=["source_raw_id"]))


def test_only_delivered_orders_meet_their_lines(spark, rows):
    orders = Frames(spark, SF).source("orders")
    plan = without_broadcast(spark, lambda: orders._jdf.queryExecution().optimizedPlan().toString())
    join = plan[plan.index("Join") : plan.index("max(l_shipdate")]
    assert re.search(r"Filter .*o_orderstatus#\d+ <=> F", join)
    base, lines = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "lineitem"))
    last = lines.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
    both = base.join(last, base.o_orderkey == last.l_orderkey, "left")
    want = both.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("last")))
    assert rows(orders, "raw_id", "order_delivered_customer_date") == rows(want)


def test_keys_and_not_what_they_stand_for_move_in_the_star_join(spark):
    plan = without_broadcast(spark, lambda: QUERIES["star_join"](spark, SF)._jdf.queryExecution().optimizedPlan().toString())
    products = plan.index("Join LeftOuter, (dim_product_id")
    assert plan.index("Join LeftOuter, (dim_date_id") < products and plan.index("Join LeftOuter, (dim_location_id") < products


def test_a_product_and_not_its_items_meets_the_dimension(spark, rows):
    plan = without_broadcast(spark, lambda: plan_of(QUERIES["fct_orders"](spark, SF)))
    assert not dealt(plan, "product_id") and not dealt(plan, r"CASE WHEN isnotnull\(product_id")
    lake = Frames(spark, SF).written
    number = F.substring("product_id", -2, 2).cast("int")
    other = F.when(number % 5 == 1, F.concat(F.lit("new "), "product_id")).otherwise(F.col("product_id"))
    products = lake.star.dim_product.filter(number % 5 != 0).withColumn("product_id", other)
    star = warehouse.Star(**{**lake.star.__dict__, "dim_product": products})
    gone = F.when(F.col("order_item_id") % 11 != 0, F.col("product_id"))
    items = lake.items.withColumn("product_id", gone)
    tables = (lake.orders, items, lake.customers, lake.star.dim_location)
    renamed = warehouse.renamed_products(items, products)
    assert 0 < renamed.count() < lake.star.dim_product.count()
    got = rows(warehouse.fct_orders(*tables, names=star, renamed=renamed))
    assert got == rows(warehouse.fct_orders(*tables, names=star))


def test_values_of_a_summary_move_alone(spark):
    fact = Frames(spark, SF).written.star.fct_orders
    row = warehouse.warehouse_summary(fact).first()
    plan = plan_of(warehouse.warehouse_summary(fact))
    assert "Expand" not in plan and "NestedLoop" not in plan and dealt(plan, r"kind#\d+, v") == 1
    keys = ["dim_customer_id", "dim_product_id", "dim_location_id", "order_date"]
    assert list(row)[:4] == list(fact.agg(*[F.count_distinct(k) for k in keys]).first())
    empty = warehouse.warehouse_summary(fact.limit(0)).first()
    assert list(empty) == [0, 0, 0, 0, None, None, 0]


def test_a_chart_adds_up_only_what_it_shows(spark):
    star = Frames(spark, SF).written.star
    plan = plan_of(analytics.chart_product_normalised(analytics.top_products(star)))
    assert "total_order_value" in plan and "quantity" not in plan and "avg_price" not in plan


def test_what_differs_between_lines_moves_last(spark, rows):
    plan = without_broadcast(spark, lambda: plan_of(QUERIES["star_join"](spark, SF)))
    moved = re.search(r"Input \[\d+\]: \[([^]]*)\]\nArguments: hashpartitioning\(dim_customer_id#\d+L, \d+\), ENSURE_REQUIREMENTS[^\n]*", plan)
    assert [c.split("#")[0] for c in moved[1].split(", ")][-2:] == ["dim_product_id", "total_order_value"]
    star = Frames(spark, SF).written.star
    own = _natural(Frames(spark, SF), star.fct_orders, star)
    keys = ["dim_customer_id", "dim_product_id", "dim_location_id"]
    assert own.columns == [c for c in star.fct_orders.columns if c not in keys] + ["customer_id", "product_id", "location_key"]
    names = {"dim_customer": "customer_id", "dim_product": "product_id", "dim_location": "location_key"}
    want = star.fct_orders
    for table, natural in names.items():
        want = want.join(getattr(star, table).select(f"{table}_id", natural), f"{table}_id", "left").drop(f"{table}_id")
    assert rows(own) == rows(want)


def test_numbers_of_48_bits_tell_what_may_be_there_twice(spark):
    store = ZoneStore(spark, scratch_dir(spark, "bits"))
    contents = spark.range(300).select(F.concat(F.lit("c"), F.col("id") % 290).alias("content"))
    ContentIndex(store, "raw", "t").enter(contents, "1")
    twice = store.read("staging", "t_repeated")
    assert twice.count() == 10 and twice.filter("_number < 0 or _number >= 281474976710656").count() == 0
    assert store.read("raw", "t_seen").count() == 290
