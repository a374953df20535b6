"""Keys and references found in the data, the catalog of stored zones, the calendar's window, clashing keys."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakestead.operators import discovery, surrogate
from lakestead.plans import refresh, warehouse
from lakestead.registry.frames import Frames
from lakestead.session import scratch_dir
from lakestead.sources import catalog, files

SF = "/root/testdata/sf0.001"


def plain_references(tables, percent):
    """All pairs of columns of one type, with Python sets."""
    columns = {}
    for t, (names, rows) in tables.items():
        for i, n in enumerate(names):
            values = [r[i] for r in rows if r[i] not in (None, "")]
            columns[t, n] = (type(values[0]) if values else None, values)
    out = []
    for (child, (ck, cv)), (parent, (pk, pv)) in itertools.permutations(columns.items(), 2):
        if cv and ck == pk and len(pv) == len(set(pv)):
            found = len(set(cv) & set(pv))
            if found and found * 100 >= len(set(cv)) * percent:
                out.append((*child, *parent, len(set(cv)), found))
    return sorted(out)


@pytest.mark.parametrize("percent", [100, 60])
def test_references_equal_all_pairs(spark, percent):
    r = random.Random(percent)
    ids = [f"k{i}" for i in range(60)]
    long = ["x" * 200 + str(i) for i in range(20)]
    tables = {
        "a": (["id", "n", "other"], [(k, i, r.choice([None, "", "k1", "k2"])) for i, k in enumerate(ids)]),
        "b": (["a_id", "n", "text"], [(r.choice(ids + ["zz"] * 20), r.randrange(80), r.choice(long)) for _ in range(300)]),
        "c": (["a_id", "text", "none"], [(k, t, None) for k, t in zip(ids[:20], long, strict=True)]),
    }
    schemas = {"a": "id string, n int, other string", "b": "a_id string, n bigint, text string", "c": "a_id string, text string, none string"}
    frames = {t: spark.createDataFrame(rows, schemas[t]) for t, (_, rows) in tables.items()}
    got = discovery.references(frames, percent=percent).collect()
    assert sorted(tuple(x) for x in got) == plain_references(tables, percent)


def test_sketches_leave_out_what_cannot_refer(spark):
    big = spark.range(2000).select("id", F.col("id").cast("string").alias("s"))
    small = spark.range(10).select((F.col("id") * 7).cast("double").alias("d"))
    kept = discovery.worth_comparing({"big": big, "small": small}, {"big": big.columns, "small": small.columns}, 100)
    assert kept == {"big": [], "small": []}


def test_a_value_that_most_rows_share_stays_one_row(spark):
    df = spark.range(5000).select(F.lit("same").alias("a"), F.lit("same").alias("b"))
    sets = discovery.value_sets({"t": df}, {"t": ["a", "b"]}).collect()
    assert [(sorted(h.column for h in s.held), s.n) for s in sets] == [(["t.a", "t.b"], 1)]


def plain_keys(rows, names, most):
    found = []
    for size in range(1, most + 1):
        for combination in itertools.combinations(range(len(names)), size):
            if any(set(k) <= set(combination) for k in found):
                continue
            values = [tuple(r[i] for i in combination) for r in rows]
            if all(v is not None for row in values for v in row) and len(set(values)) == len(values):
                found.append(combination)
    return [tuple(names[i] for i in k) for k in found]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_minimal_keys_equal_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(i // 4, i % 4, i // 16, i % 16, r.randrange(3), r.choice([None, 1, 2])) for i in range(64)]
    names = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    assert discovery.composite_keys(df) == plain_keys(rows, names, 3)


def test_keys_of_repeated_rows_and_of_none(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    assert discovery.composite_keys(df) == []
    assert discovery.composite_keys(df.limit(1)) == [("a",), ("b",)]


# ---- catalog --------------------------------------------------------------------------------
def test_stored_zones_in_the_catalog(spark):
    store = files.ZoneStore(spark, scratch_dir(spark, "catalog"))
    months = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), None]
    rows = spark.createDataFrame([(i, months[i % 3]) for i in range(9)], "i int, m date")
    store.overwrite("z", "by_month", rows, "m")
    changed = spark.createDataFrame([(100, months[0])], "i int, m date")
    store.overwrite("z", "by_month", changed, "m", only_touched=True)
    store.overwrite("z", "plain", rows)
    rows.write.partitionBy("m").parquet(store.path("z", "loose"))
    deep = rows.withColumn("k", F.col("i") % 2)
    store.versions("z", "deep").write(deep, ("m", "k"))
    store.versions("z", "deep").write(deep.filter("m is null and k = 1"), ("m", "k"), {"m=2024-01-01"})
    catalog.register(store, "z", "zone_z")
    assert sorted(r.i for r in spark.table("zone_z.deep").collect()) == [1, 4, 5, 7]
    catalog.register(store, "z", "zone_z", ["by_month", "loose", "plain"])
    spark.sql("DROP TABLE zone_z.deep")
    got = catalog.zone_tables(spark, {"z": "zone_z"})
    assert sorted(tuple(r) for r in got.collect()) == [
        ("z", "by_month", 7, 2, "m"), ("z", "loose", 9, 2, "m"), ("z", "plain", 9, 2, "")
    ]
    assert sorted(r.i for r in spark.table("zone_z.by_month").collect()) == [1, 2, 4, 5, 7, 8, 100]
    january = spark.table("zone_z.by_month").filter(F.col("m") == F.lit(months[0]))
    assert len({r[0] for r in january.select(F.input_file_name()).collect()}) == 1
    columns = catalog.zone_columns(spark, {"z": "zone_z"})
    for df in (got, columns):
        assert "Scan parquet" not in df._jdf.queryExecution().executedPlan().toString()
    assert ("z", "plain", 2, "m", "date", True, None, 3) in [tuple(r) for r in columns.collect()]
    catalog.register(store, "z", "zone_z", ["plain"])
    catalog.drop_zone(spark, "zone_z")
    assert store.read("z", "plain").count() == 9


# ---- calendar -------------------------------------------------------------------------------
def test_dates_out_of_the_window_add_no_days(spark):
    stamps = [dt.datetime(1, 1, 1), dt.datetime(2020, 5, 5), None, dt.datetime(9999, 12, 31), dt.datetime(2199, 12, 31)]
    orders = spark.createDataFrame(
        [(str(i), s) for i, s in enumerate(stamps)], "order_id string, order_purchase_timestamp timestamp_ntz"
    )
    bounds = warehouse.order_date_range(orders).first()
    assert (bounds.start, bounds.end) == (dt.date(2020, 1, 1), dt.date(2199, 12, 31))
    outside = [r.document for r in warehouse.outside_calendar(orders).collect()]
    assert sorted(outside) == ['{"order_id":"0","order_date":"0001-01-01"}', '{"order_id":"3","order_date":"9999-12-31"}']
    only = orders.filter("order_id in ('0', '2')")
    assert warehouse.dim_date(warehouse.order_date_range(only)).count() == 0


# ---- clashing keys --------------------------------------------------------------------------
def test_a_clash_of_keys_ends_the_load(spark, monkeypatch):
    lake = Frames(spark, SF).written
    store = files.ZoneStore(spark, scratch_dir(spark, "clash"))
    args = (store, lake.orders, lake.items, lake.customers, lake.sellers, dt.date(2024, 1, 1))
    star = refresh.load_star(*args)
    n = star.dim_product.count()
    monkeypatch.setattr(warehouse, "hash_key", lambda *natural: F.pmod(F.xxhash64(*natural), F.lit(5)))
    with pytest.raises(surrogate.KeyCollision, match="share a dim_"):
        refresh.load_star(*args)
    assert store.read("warehouse", "dim_product").count() == n
    assert store.read("warehouse", "dim_product").agg(F.max("dim_product_id")).first()[0] > 5


# ---- what a search moves --------------------------------------------------------------------
def test_few_values_need_no_sketch(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("a"), (F.col("id") % 5).alias("b"), "id")
    sizes = {}
    list(discovery._ruled_in(df, [("a",), ("b",), ("id",)], 100, sizes))
    assert list(discovery._ruled_in(df, [("a", "b"), ("a", "id")], 100, sizes)) == [("a", "id")]
    assert sizes["a", "b"] < 30 and discovery.composite_keys(df) == [("id",)]


def test_kept_rows_are_read_and_not_made_again(spark):
    f = Frames(spark, SF)
    kept = f.kept(f.processed("orders"), "orders")
    assert "from_json" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count() == f.table("orders").count()
