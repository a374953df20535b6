"""Dedupe, upserts, surrogate keys, checks and the exact percentile."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestead.functions.scalars import total
from lakestead.operators import checks, dedupe, surrogate
from lakestead.operators.percentile import exact_percentile
from lakestead.sources import raw


def test_best_per_key_breaks_ties_by_lowest_id(spark, rows):
    df = spark.createDataFrame(
        [("a", 0.5, 3, "x"), ("a", 0.9, 2, "y"), ("a", 0.9, 1, "z"), ("b", 0.1, 4, None)],
        "k string, score double, id long, v string",
    )
    assert rows(dedupe.best_per_key(df, ["k"], F.col("score"), "id")) == [
        ("a", 0.9, 1, "z"),
        ("b", 0.1, 4, None),
    ]


def test_insert_ignore_keeps_existing_and_first_new(spark, rows):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "k string, v int")
    assert rows(dedupe.insert_ignore(old, new, ["k"], "v")) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize(("refresh", "city"), [(False, "old"), (True, "new")])
def test_upsert_touch(spark, refresh, city):
    day1, day2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    schema = "k string, city string, created_at timestamp_ntz, updated_at timestamp_ntz"
    old = spark.createDataFrame([("a", "old", day1, day1), ("z", "same", day1, day1)], schema)
    new = spark.createDataFrame([("a", "new"), ("b", "first")], "k string, city string")
    got = {r.k: r[1:] for r in dedupe.upsert_touch(old, new, "k", day2, refresh).collect()}
    assert got == {
        "a": (city, day1, day2),
        "b": ("first", day2, day2),
        "z": ("same", day1, day1),
    }


def test_dense_key_is_gapless_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k")).repartition(7)
    first = {r.k: r.id for r in surrogate.dense_key(df, ["k"], "id", buckets=16).collect()}
    again = {r.k: r.id for r in surrogate.dense_key(df.coalesce(2), ["k"], "id", buckets=16).collect()}
    assert sorted(first.values()) == list(range(1, 5001)) and first == again


def test_hash_key_collisions(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert surrogate.hash_collisions(df, ["k"]).count() == 0


def test_checks(spark, rows):
    child = spark.createDataFrame([("a",), ("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    assert rows(checks.orphans(child, parent, "k", "k")) == [("x", 2)]
    assert rows(checks.reference_report({"r": (child, "k", parent, "k")})) == [("r", 2, 2, 1, 2)]
    assert rows(checks.duplicate_keys(parent, ["k"])) == [("b", 2)]
    assert rows(checks.not_null_violations(child, ["k"])) == [("k", 1)]


def test_raw_dedupe_leaves_the_first_copy(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "raw_id long, v string")
    documents = raw.to_documents(df, "t", dt.datetime(2024, 1, 1), "raw_id")
    assert rows(raw.unique_documents(documents), "raw_id", "data") == [(1, '{"v":"x"}'), (3, '{"v":"y"}')]


def test_documents_keep_nulls_and_drop_nan(spark):
    df = spark.createDataFrame(
        [(1.5, None, dt.datetime(2017, 10, 2, 10, 56, 33)), (float("nan"), "x", dt.datetime(2017, 1, 1, 0, 0, 0, 1500))],
        "d double, s string, ts timestamp_ntz",
    )
    got = {r.data for r in raw.to_documents(df, "t", dt.datetime(2024, 1, 1)).collect()}
    assert got == {
        '{"d":1.5,"s":null,"ts":"2017-10-02T10:56:33"}',
        '{"d":null,"s":"x","ts":"2017-01-01T00:00:00.001500"}',
    }


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_percentile(spark, fraction):
    rng = random.Random(7)
    groups = {
        "even": [rng.randint(-(10**6), 10**6) for _ in range(400)],
        "odd": [rng.randint(0, 50) for _ in range(333)],
        "hot": [4200] * 500 + [1, 10**14, -(10**14)],
        "one": [17],
    }
    data = [(g, Decimal(v) / 100) for g, vs in groups.items() for v in vs] + [("odd", None)]
    df = spark.createDataFrame(data, "g string, v decimal(18,2)").repartition(5)
    got = dict(
        tuple(r) for r in exact_percentile(df, ["g"], "v", fraction, 2, "decimal(24,6)").collect()
    )
    for g, vs in groups.items():
        expected = np.percentile(np.array(vs, dtype=float), fraction * 100) / 100
        assert float(got[g]) == pytest.approx(expected, rel=1e-9, abs=1e-6), g


def test_total_is_exact(spark):
    big = "9999999999999999.99"
    values = [Decimal(v) for v in (big, big, "-" + big, "0.01", "-0.02", "10737418.24", "-10737418.25", big)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None)], "k string, v decimal(18,2)")
    got = {r.k: r.s for r in df.groupBy("k").agg(total(F.col("v")).alias("s")).collect()}
    assert got == {"a": sum(values), "b": None} and df.agg(total(F.col("v"))).schema[0].dataType.simpleString() == "decimal(38,2)"
