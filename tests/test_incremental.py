"""Versioned tables, late snapshots, deliveries and streams that touch only what they must."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakestead.operators import scd2, sieve
from lakestead.plans import changes, deliver, refresh, seller_history, warehouse
from lakestead.plans.changes import Change
from lakestead.registry.frames import Frames
from lakestead.schemas import schema
from lakestead.session import scratch_dir
from lakestead.sources import adapters, files
from lakestead.sources.index import ContentIndex
from lakestead.sources.versions import VersionedTable
from lakestead.streaming import incremental

SF = "/root/testdata/sf0.001"
TRACKED = ["state", "city"]


def plan_of(df):
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def new_store(spark, name):
    return files.ZoneStore(spark, scratch_dir(spark, name))


# ---- versioned tables -----------------------------------------------------------------------
def test_a_failed_write_leaves_the_table(spark):
    store = new_store(spark, "failed")
    store.overwrite("z", "t", spark.range(5))
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        store.overwrite("z", "t", broken)
    assert store.read("z", "t").count() == 5
    assert store.overwrite("z", "t", spark.range(7)).count() == 7


def test_a_reader_keeps_its_rows(spark):
    store = new_store(spark, "reader")
    opened = store.overwrite("z", "t", spark.range(5))
    store.overwrite("z", "t", spark.range(50, 60))
    store.overwrite("z", "t", spark.range(60, 61))
    assert opened.count() == 5
    versions = store.versions("z", "t")
    assert versions.vacuum(dt.datetime(2000, 1, 1)) == []
    # The table and the state before it stay.
    assert versions.vacuum(dt.datetime.now() + dt.timedelta(days=1)) == ["_v=1"]
    assert [r.id for r in store.read("z", "t").collect()] == [60]


def test_an_empty_table_has_its_columns(spark):
    store = new_store(spark, "empty")
    empty = spark.createDataFrame([], "a int, m date, b string")
    got = store.overwrite("z", "t", empty, "m")
    assert got.columns == ["a", "m", "b"] and got.collect() == []


def test_partitions_are_replaced_and_emptied(spark, rows):
    store = new_store(spark, "partitions")
    day = dt.date(2024, 1, 1)
    months = [day, dt.date(2024, 2, 1), None]
    all_rows = spark.createDataFrame([(i, months[i % 3]) for i in range(9)], "i int, m date")
    store.overwrite("z", "t", all_rows, "m")
    first = store.versions("z", "t").state()
    new = spark.createDataFrame([(100, None)], "i int, m date")
    got = store.overwrite("z", "t", new, "m", only_touched=True, emptied=[day])
    assert rows(got, "i") == [(1,), (100,), (4,), (7,)]
    gone, came = store.versions("z", "t").between(first, store.versions("z", "t").state())
    assert rows(gone, "i") == [(0,), (2,), (3,), (5,), (6,), (8,)] and rows(came, "i") == [(100,)]
    assert all("2024-02-01" not in f for f in gone.inputFiles() + came.inputFiles())


def test_a_repeated_tag_takes_its_place(spark):
    table = VersionedTable(spark, scratch_dir(spark, "tags"))
    table.write(spark.range(1), tag=0)
    table.write(spark.range(2), tag=1)
    assert table.before(1).count() == 1 and table.before(2).count() == 2
    table.write(spark.range(3), tag=1)
    assert table.before(1).count() == 1 and table.read().count() == 3


# ---- late snapshots -------------------------------------------------------------------------
def plain_history(sightings):
    """(id, state, city, zip, from, to, reason) from (id, state, city, zip, day), each day once."""
    out = []
    for key in {s[0] for s in sightings}:
        line, starts = sorted((s for s in sightings if s[0] == key), key=lambda s: s[4]), []
        for s in line:
            if not starts or starts[-1][1:3] != s[1:3]:
                starts.append(s)
        for n, s in enumerate(starts):
            end = starts[n + 1][4] if n + 1 < len(starts) else None
            reason = "Location changed" if end else "Location updated" if n else "Initial load"
            out.append((*s, end, reason))
    return sorted(out, key=repr)


def as_tuples(dimension):
    fields = ("id", "state", "city", "zip", "valid_from", "valid_to", "change_reason")
    got = dimension.collect()
    assert all(r.is_current == (r.valid_to is None) for r in got)
    return sorted((tuple(r[f] for f in fields) for r in got), key=repr)


SIGHTING = "id string, state string, city string, zip string, day date"


def test_one_line_from_versions_and_sightings(spark):
    d = [dt.date(2024, n, 1) for n in range(1, 6)]
    known = [("a", "SP", "x", "1", d[1]), ("a", "SP", "y", "2", d[3]), ("b", "RJ", None, "3", d[1])]
    history = scd2.splice(None, spark.createDataFrame(known, SIGHTING), "id", TRACKED, "day")
    assert as_tuples(history) == plain_history(known)
    late = [("a", "SP", "x", "9", d[2]), ("a", "SP", "z", "8", d[0]), ("c", "MG", "q", "1", d[4])]
    # What is known of a from its first late day on comes along.
    since = late + [s for s in known if s[0] == "a"]
    history = scd2.splice(history, spark.createDataFrame(since, SIGHTING), "id", TRACKED, "day")
    assert as_tuples(history) == plain_history(known + late)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_delivery_gives_the_same_history(spark, seed):
    r = random.Random(seed)
    days = [dt.date(2024, 1, n) for n in range(1, 7)]
    all_sightings = {
        day: [
            (f"s{i}", r.choice(["SP", None]), r.choice(["x", "y", None]), str(r.randrange(9)), day)
            for i in range(8)
            if r.random() < 0.6
        ]
        for day in days
    }
    named = "seller_id string, seller_state string, seller_city string, seller_zip_code_prefix string, day date"
    want = plain_history(list(itertools.chain(*all_sightings.values())))
    order = days * 2
    r.shuffle(order)
    store, n = new_store(spark, "any-order"), 0
    while order:
        part, order = order[: r.randrange(1, 4)], order[3:] if len(order) > 3 else []
        part = part if order else list(dict.fromkeys(part + days))
        given = [s for day in part for s in all_sightings[day]]
        for _ in range(r.randrange(1, 3)):  # some batches are replayed
            history = seller_history.deliver(store, spark.createDataFrame(given, named), "day", n)
        n += 1
    plain = history.toDF(*history.columns).withColumnsRenamed(
        {"seller_id": "id", "seller_state": "state", "seller_city": "city", "seller_zip_code_prefix": "zip"}
    )
    assert as_tuples(plain) == want


def test_a_snapshot_of_today_reads_no_earlier_day(spark):
    store = new_store(spark, "today")
    named = "seller_id string, seller_state string, seller_city string, seller_zip_code_prefix string, day date"
    for n in range(1, 4):
        rows = [(f"s{i}", "SP", f"c{i * n}", "1", dt.date(2024, 1, n)) for i in range(3)]
        history = seller_history.deliver(store, spark.createDataFrame(rows, named), "day", n)
    stored = spark.read.parquet(store.path("warehouse", "dim_seller_scd_sightings"))
    assert stored.count() == 9 and history.filter("is_current").count() == 3
    assert "PartitionFilters: [isnotnull(_day" in plan_of(stored.filter(F.col("_day") >= F.lit(dt.date(2024, 1, 3))))


# ---- changes of the fact --------------------------------------------------------------------
ORDER = "order_id string, customer_id string, bought timestamp_ntz, status string"
ITEM = "order_item_id long, order_id string, product_id string, price int"
CUSTOMER = "customer_id string, customer_state string, customer_city string"


def zone(spark, orders, items, customers):
    """Curated frames from short rows."""
    o = spark.createDataFrame(orders, ORDER).select(
        "order_id", "customer_id", F.col("status").alias("order_status"), F.col("bought").alias("order_purchase_timestamp"),
        F.trunc("bought", "month").alias("purchase_month"),
    )
    i = spark.createDataFrame(items, ITEM).withColumns(
        {"freight_value": F.lit(1).cast("decimal(10,2)"), "price": F.col("price").cast("decimal(10,2)")}
    )
    full = lambda df, name: df.to(schema(f"curated.{name}"))
    c = full(spark.createDataFrame(customers, CUSTOMER), "customers_refined")
    return full(o, "orders_refined"), full(i, "order_items_refined"), c


def random_zone(r, old=None):
    times = [None] + [dt.datetime(2024, m, 1 + m) for m in range(1, 6)]
    place = lambda: (r.choice(["SP", "RJ", "", None]), r.choice(["x", "y", ""]))
    if old is None:
        orders = {f"o{i}": (f"c{r.randrange(8)}", r.choice(times), "new") for i in range(30)}
        items = [(f"o{r.randrange(32)}", f"p{r.randrange(4)}", r.randrange(1, 4)) for _ in range(60)]
        return orders, items, {f"c{i}": place() for i in range(6)}
    orders, items, customers = dict(old[0]), list(old[1]), dict(old[2])
    for _ in range(r.randrange(4)):
        o = f"o{r.randrange(35)}"
        orders[o] = (f"c{r.randrange(8)}", r.choice(times), r.choice(["new", "sent"]))
    for o in r.sample(sorted(orders), 2):
        del orders[o]
    for _ in range(r.randrange(3)):
        items[r.randrange(len(items))] = (f"o{r.randrange(32)}", "p1", 2)
    if r.random() < 0.7:
        customers[f"c{r.randrange(8)}"] = place()
    if r.random() < 0.4:
        customers.pop(r.choice(sorted(customers)))
    return orders, items, customers


@pytest.mark.parametrize("seed", range(4))
def test_updated_months_equal_a_rebuild(spark, rows, seed):
    r = random.Random(seed)
    sellers = spark.createDataFrame([], schema("curated.sellers_refined"))
    frames, plain, fact = None, None, None
    for _ in range(3):
        plain = random_zone(r, plain)
        before, frames = frames, zone(
            spark,
            [(o, c, t, s) for o, (c, t, s) in plain[0].items()],
            [(n, o, p, v) for n, (o, p, v) in enumerate(plain[1])],
            [(c, *place) for c, place in plain[2].items()],
        )
        locations = warehouse.dim_location(frames[2], sellers)
        whole = warehouse.fct_orders(*frames, locations)
        if before is None:
            fact = whole
            continue
        flip = changes.has_no_place(before[2], sellers) != changes.has_no_place(frames[2], sellers)
        deltas = [Change(a, b) for a, b in zip(before, frames, strict=True)]
        changed = changes.changed_orders(*deltas, frames[0], flip, frames[2])
        months = changes.months_of(changed, before[0], frames[0])
        rest = fact.filter(~changes.in_months(F.col("order_month"), months).eqNullSafe(True))
        updated = changes.updated_months(fact, changed, months, *frames, locations)
        fact = spark.createDataFrame(rest.unionByName(updated).collect(), whole.schema)
        assert rows(fact) == rows(whole)


def test_a_change_names_added_changed_and_gone_rows(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", 1), (None, 5), ("d", 9)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1), ("e", 1), (None, 6), ("d", 9)], "k string, v int")
    got = changes.differing_keys(Change(old, new), "k").collect()
    assert sorted(r.k for r in got) == ["a", "c", "e"]


def test_a_delivery_rewrites_only_its_months(spark, rows):
    base = scratch_dir(spark, "deliver")
    store = files.ZoneStore(spark, base)
    orders, items = adapters.orders(spark, SF), adapters.order_items(spark, SF)
    first = {e: a(spark, SF) for e, a in adapters.ENTITIES.items() if e not in ("orders", "order_items")}
    held_back = F.col("raw_id") == orders.filter("order_purchase_timestamp is not null").agg(F.min("raw_id")).first()[0]
    own = F.floor(F.col("raw_id") / 8) == orders.filter(held_back).first().raw_id
    first |= {"orders": orders.filter(~held_back), "order_items": items.filter(~own)}
    deliver.deliver(spark, first, base, dt.datetime(2024, 1, 1), "raw_id")
    before = store.versions(*deliver.FACT).state()
    second = {"orders": orders.filter(held_back), "order_items": items.filter(own)}
    lake = deliver.deliver(spark, second, base, dt.datetime(2024, 2, 1), "raw_id")
    gone, came = store.versions(*deliver.FACT).between(before, store.versions(*deliver.FACT).state())
    month = orders.filter(held_back).select(F.trunc("order_purchase_timestamp", "month")).first()[0]
    assert {r.order_month for r in came.collect()} == {month}
    assert all(f"order_month={month}" in f for f in gone.inputFiles() + came.inputFiles())
    lazy = Frames(spark, SF)
    assert rows(lake.star.fct_orders, *lazy.fct_orders.columns) == rows(lazy.fct_orders)
    assert rows(lake.star.dim_product) == rows(lazy.dim_product)
    now = store.versions(*deliver.FACT).state()
    again = deliver.deliver(spark, second, base, dt.datetime(2024, 2, 1), "raw_id")
    assert rows(again.star.fct_orders) == rows(lake.star.fct_orders)
    assert store.read("raw", "orders_raw").count() == orders.count()
    assert len(now.paths) == len(store.versions(*deliver.FACT).state().paths)


def test_a_failed_delivery_is_made_up_for(spark, rows, monkeypatch):
    base = scratch_dir(spark, "broken-deliver")
    sources = {e: a(spark, SF) for e, a in adapters.ENTITIES.items()}
    key = F.col("raw_id")
    parts = [
        {**sources, "orders": sources["orders"].filter(key % 9 > 1), "order_items": sources["order_items"].filter(key % 5 > 1)},
        {"orders": sources["orders"].filter(key % 9 == 0), "order_items": sources["order_items"].filter(key % 5 == 0)},
        {"orders": sources["orders"].filter(key % 9 == 1), "order_items": sources["order_items"].filter(key % 5 == 1)},
    ]
    for n, part in enumerate(parts, 1):
        with monkeypatch.context() as broken:
            if n == 2:  # the curated zone is written, the star is not
                broken.setattr(deliver, "update_star", lambda *a: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    deliver.deliver(spark, part, base, dt.datetime(2024, n, 1), "raw_id")
                continue
            lake = deliver.deliver(spark, part, base, dt.datetime(2024, n, 1), "raw_id")
    lazy = Frames(spark, SF)
    assert rows(lake.star.fct_orders, *lazy.fct_orders.columns) == rows(lazy.fct_orders)
    assert rows(lake.star.dim_product, *lazy.dim_product.columns) == rows(lazy.dim_product)


def test_only_orders_of_the_loads_are_compared(spark, rows):
    base = scratch_dir(spark, "compared")
    store = files.ZoneStore(spark, base)
    sources = {e: a(spark, SF) for e, a in adapters.ENTITIES.items()}
    key, versions = F.col("raw_id"), store.versions("curated", "orders_refined")
    states = []
    for n, part in enumerate([key % 9 > 1, key % 9 == 1, key % 9 == 0], 1):
        deliver.deliver(spark, {**(sources if n == 1 else {}), "orders": sources["orders"].filter(part)}, base,
                        dt.datetime(2024, n, 1), "raw_id")
        states.append(versions.state())
    # Over two merges, of which the last star knows one.
    for first, of_loads in ((states[0], "source_raw_id % 9 < 2"), (states[1], "source_raw_id % 9 = 0")):
        n = versions.read().filter(of_loads).count()
        found = deliver.touched(store, "orders_refined", "order_id", first.version, states[2].version)
        assert found.distinct().count() == n
        change = deliver.change_of(store, {"orders": first}, "orders")
        whole = Change(*versions.between(first, states[2]))
        assert rows(changes.differing_keys(change, "order_id")) == rows(changes.differing_keys(whole, "order_id"))
        assert change.came.count() < 1.1 * n + 10 < whole.came.count()
    # Where a version was not made by a merge, all orders are compared.
    store.overwrite("curated", "orders_refined", store.read("curated", "orders_refined"), "purchase_month")
    assert deliver.touched(store, "orders_refined", "order_id", states[0].version, versions.state().version) is None
    assert deliver.change_of(store, {"orders": states[0]}, "orders").came.count() == versions.read().count()


def test_the_update_reads_only_touched_months(spark):
    star = Frames(spark, SF).written.star
    month = star.fct_orders.agg(F.min("order_month")).first()[0]
    lake = Frames(spark, SF).written
    changed = lake.orders.filter(F.col("purchase_month") == F.lit(month)).select("order_id").limit(3)
    rows = changes.updated_months(
        star.fct_orders, changed, [month], lake.orders, lake.items, lake.customers, star.dim_location
    )
    plan = plan_of(rows)
    assert f"PartitionFilters: [isnotnull(order_month" in plan or f"(order_month" in plan.split("PartitionFilters")[1]
    assert plan.count("purchase_month") and "PartitionFilters: [isnotnull(purchase_month" in plan


def test_rows_without_the_keys_stay_where_they_are(spark, rows):
    df = spark.range(20000).select(F.when(F.col("id") % 50 != 7, F.concat(F.lit("k"), F.col("id") % 9000)).alias("k"), "id")
    keys = spark.range(300).select(F.concat(F.lit("k"), F.col("id") * 31).alias("k"))
    keys = keys.unionByName(keys).unionByName(spark.createDataFrame([(None,)], "k string"))
    kept, others = sieve.split(df, "k", keys)
    assert rows(kept.unionByName(others)) == rows(df)
    assert rows(sieve.having(df, "k", keys)) == rows(df.join(keys, "k", "left_semi"))
    assert rows(kept.unionByName(sieve.lacking(others, "k", keys))) == rows(df.join(keys, "k", "left_anti"))
    assert rows(sieve.possible(df, "k", keys)) == rows(others)
    wanted = df.join(keys, "k", "left_semi").count()
    assert wanted <= others.count() < 1.05 * wanted + 10
    assert rows(sieve.split(df, "k", keys.limit(0))[0]) == rows(df)
    # Only words of the filter are dealt; the rows are not.
    plan = plan_of(kept)
    assert "SortMergeJoin" not in plan and plan.count("hashpartitioning(") == plan.count("hashpartitioning(_word")


def test_an_update_leaves_the_other_rows_where_they_are(spark):
    lake = Frames(spark, SF).written
    fact, month = lake.star.fct_orders, lake.star.fct_orders.agg(F.min("order_month")).first()[0]
    changed = lake.orders.filter(F.col("purchase_month") == F.lit(month)).select("order_id").limit(3)
    kept = changes.balanced(*sieve.split(fact, "order_id", changed), "order_month", [])
    assert kept.count() == fact.count()
    rows = changes.updated_months(
        fact, changed, [month], lake.orders, lake.items, lake.customers, lake.star.dim_location
    )
    # Neither an anti join nor a semi join of all rows with the changed orders.
    assert "LeftAnti" not in plan_of(rows) and "LeftSemi" not in plan_of(rows)


def test_orders_of_customers_that_did_not_move_stay(spark, rows):
    orders, items, customers = zone(
        spark, [(f"o{i}", f"c{i % 40}", None, "new") for i in range(400)], [], [(f"c{i}", "SP", "x") for i in range(40)]
    )
    there = customers.filter("customer_id <> 'c7'")
    none = Change(orders.limit(0), orders.limit(0))
    no_item = Change(items.limit(0), items.limit(0))
    changed = changes.changed_orders(none, no_item, Change(there, customers), orders, False, customers)
    assert rows(changed) == sorted([(f"o{i}",) for i in range(7, 400, 40)], key=repr)
    assert "LeftSemi" not in plan_of(changed)


def test_a_small_load_meets_few_known_contents(spark, rows):
    store = new_store(spark, "small-load")
    index = ContentIndex(store, "raw", "t", buckets=4)
    content = spark.range(2000).select(F.concat(F.lit("c"), "id").alias("content"))
    index.enter(content, "1")
    small = spark.createDataFrame([("c5",), ("c5",), ("c77",), ("new",)], "content string")
    index.enter(small, "2")
    found = rows(store.read("raw", "t_again"), "content")
    assert found == [("c5",), ("c77",)]
    assert rows(index.fresh(small.withColumn("load_id", F.lit("2")), "content"), "content") == [("new",)]
    assert store.read("raw", "t_seen").count() == 2001
    # All of a load is new, then none of it.
    other = spark.createDataFrame([("x",), ("y",), ("x",)], "content string")
    for load, n in (("3", 0), ("4", 2)):
        index.enter(other, load)
        assert store.read("raw", "t_again").filter(F.col("load_id") == load).count() == n
    assert store.read("raw", "t_seen").count() == 2003


def test_a_month_of_many_small_files_is_put_together(spark, rows):
    store = new_store(spark, "crowded")
    full, other = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    many = spark.range(0, 60, 1, 12).select(F.col("id").cast("string").alias("k"), F.lit(full).alias("m"))
    one = spark.range(60, 64, 1, 1).select(F.col("id").cast("string").alias("k"), F.lit(other).alias("m"))
    stored = store.overwrite("z", "t", many.unionByName(one), "m", balance=False)
    table = store.versions("z", "t")
    crowded = table.crowded([full, other, None])
    assert crowded == [full]
    kept, moved = sieve.split(stored, "k", spark.createDataFrame([("3",)], "k string"))
    got = store.overwrite("z", "t", changes.balanced(kept, moved, "m", crowded), "m", True, [full, other], balance=False)
    assert rows(got, "k") == sorted([(str(i),) for i in range(64)], key=repr)
    assert table.crowded([full, other]) == []
    assert changes.balanced(kept, moved, "m", [None]).count() == 64


# ---- loads ----------------------------------------------------------------------------------
def test_the_index_knows_what_loads_brought(spark):
    store = new_store(spark, "index")
    index = ContentIndex(store, "raw", "t", buckets=8)
    loads = {"1": ["a", "b", "b"], "2": ["b", "c"], "3": ["a", "c", "d", "d"], "4": []}

    def fresh(load):
        df = spark.createDataFrame([(c, load) for c in loads[load]], "content string, load_id string")
        index.enter(df.select("content"), load)
        return sorted(r.content for r in index.fresh(df, "content").collect())

    want = {"1": ["a", "b", "b"], "2": ["c"], "3": ["d", "d"], "4": []}
    assert {load: fresh(load) for load in loads} == want
    # Any load may be run again.
    assert {load: fresh(load) for load in ("2", "1", "4", "3")} == want
    seen = store.read("raw", "t_seen")
    assert seen.count() == 4
    one = spark.createDataFrame([("a", 0)], "content string, bucket int").withColumn(
        "bucket", F.pmod(F.xxhash64("content"), F.lit(8)).cast("int")
    )
    plan = plan_of(index.known(one, "9"))
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_ids_stay_when_a_load_runs_again(spark, rows):
    store = new_store(spark, "ids")
    customers = adapters.customers(spark, SF).drop("raw_id").coalesce(2)
    for day in (1, 2, 1, 2):
        part = customers if day == 1 else customers.limit(10)
        refresh.ingest(store, "customers", part, dt.datetime(2024, 1, day))
        ids = rows(store.read("raw", "customers_raw").filter(F.col("load_id").startswith("20240101")), "raw_id", "data")
        first = ids if day == 1 and "first" not in locals() else first  # noqa: F821
        assert ids == first
    every = store.read("raw", "customers_raw")
    assert every.select("raw_id").distinct().count() == every.count()


def test_a_failed_load_is_in_the_audit(spark):
    store = new_store(spark, "audit")
    broken = adapters.sellers(spark, SF).withColumn("seller_city", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        refresh.ingest(store, "sellers", broken, dt.datetime(2024, 1, 1))
    assert [r.status for r in store.read("raw", "data_metadata").collect()] == ["failed"]
    refresh.ingest(store, "sellers", adapters.sellers(spark, SF), dt.datetime(2024, 1, 1))
    assert [r.status for r in store.read("raw", "data_metadata").collect()] == ["loaded"]


def test_a_lake_of_some_tables(spark):
    base = scratch_dir(spark, "some")
    for entity in ("orders", "customers"):
        files.write_csv(adapters.ENTITIES[entity](spark, SF).drop("raw_id"), f"{base}/in/{entity}.csv")
    lake = refresh.run_folder(spark, f"{base}/in", f"{base}/lake", dt.datetime(2024, 1, 1))
    assert lake.sellers.count() == 0 and lake.items.count() == 0
    assert lake.star.fct_orders.count() == lake.orders.count() > 0
    assert lake.star.fct_orders.filter("quantity <> 0").count() == 0


# ---- streams --------------------------------------------------------------------------------
EVENT = "event_id long, ts timestamp_ntz, event_type string, value double"


def test_events_without_time_are_stored_once(spark, rows):
    base = scratch_dir(spark, "timeless")
    t = dt.datetime(2024, 1, 1, 5)
    given = [[(1, t, "a", 1.0), (2, None, "a", 2.0)], [(2, None, "a", 2.0), (3, None, "b", 1.0), (1, t, "a", 1.0)], [(None, t, "a", 0.0)]]
    for n, part in enumerate([*given, given[2]]):
        spark.createDataFrame(part, EVENT).coalesce(1).write.parquet(f"{base}/in/{n}")
        stream = incremental.file_stream(spark, f"{base}/in/*", spark.createDataFrame([], EVENT).schema)
        incremental.ingest_once(stream, "event_id", "ts", f"{base}/rows", f"{base}/state")
        stream = incremental.file_stream(spark, f"{base}/in/*", spark.createDataFrame([], EVENT).schema)
        incremental.load_stats_per_hour(stream, "event_id", "ts", "event_type", "value", f"{base}/s", f"{base}/state-2")
    assert rows(incremental.ingested(spark, f"{base}/rows"), "event_id") == [(1,), (2,), (3,), (None,)]
    stats = spark.read.parquet(f"{base}/s/stats")
    assert rows(stats, "hour", "event_type", "n_events") == [(t, "a", 2)]


def test_an_event_that_comes_back_on_another_day(spark, rows):
    base = scratch_dir(spark, "moved")
    days = [dt.datetime(2024, 1, n) for n in (1, 2, 3)]
    for across, want in ((False, 5), (True, 3)):
        for n, part in enumerate([[(1, days[0], "a", 1.0), (2, days[1], "a", 1.0)], [(1, days[1], "a", 1.0)],
                                  [(2, None, "a", 1.0), (3, days[2], "a", 1.0)]]):
            spark.createDataFrame(part, EVENT).coalesce(1).write.mode("overwrite").parquet(f"{base}/{across}/{n}")
            stream = incremental.file_stream(spark, f"{base}/{across}/*", spark.createDataFrame([], EVENT).schema)
            incremental.ingest_once(
                stream, "event_id", "ts", f"{base}/rows-{across}", f"{base}/state-{across}", across_days=across
            )
        assert incremental.ingested(spark, f"{base}/rows-{across}").count() == want


def test_a_batch_reads_only_its_days(spark):
    base = scratch_dir(spark, "pruned")
    rows = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 9), 0) for i in range(90)], "k long, _day date, _batch int")
    rows.write.partitionBy("_day", "_batch").parquet(base)
    stored = spark.read.parquet(base)
    day = dt.date(2024, 1, 4)
    batch = spark.createDataFrame([(3, day), (4, day), (4, None)], "k long, _day date")
    found = incremental.unseen(batch, stored, "k", [day, None])
    assert sorted((r.k, str(r._day)) for r in found.collect()) == [(4, "2024-01-04"), (4, "None")]
    read = incremental.of_days(stored, [day, None])
    assert "_day" in plan_of(read).split("PartitionFilters: [")[1].split("]")[0]
    files_read = {r[0] for r in read.select(F.input_file_name()).collect()}
    assert files_read and all("_day=2024-01-04" in f for f in files_read)
