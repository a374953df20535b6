"""Type 2 history: the traps, and properties over random snapshots."""

import datetime as dt
import random

import pytest

from lakestead.operators import scd2

TRACKED = ["state", "city"]
SCHEMA = "id string, state string, city string, zip string"
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


def snapshot(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def load(spark, *days, compat=False):
    dimension = None
    for as_of, rows in days:
        if dimension is None:
            dimension = scd2.initial(snapshot(spark, rows), "id", TRACKED, as_of, compat)
        else:
            dimension = scd2.apply(dimension, snapshot(spark, rows), "id", TRACKED, as_of, compat)
    return dimension


def brief(dimension):
    fields = ("id", "city", "zip", "is_current", "valid_from", "valid_to", "change_reason")
    versions = sorted(dimension.collect(), key=lambda r: (r.id, r.valid_from))
    return [tuple(r[f] for f in fields) for r in versions]


def test_move_closes_and_opens(spark):
    got = load(spark, (D1, [("a", "SP", "x", "1")]), (D2, [("a", "SP", "y", "2")]))
    assert brief(got) == [
        ("a", "x", "1", False, D1, D2, "Location changed"),
        ("a", "y", "2", True, D2, None, "Location updated"),
    ]


def test_zip_only_change_and_absent_key_change_nothing(spark):
    got = load(spark, (D1, [("a", "SP", "x", "1"), ("b", "RJ", "z", "1")]), (D2, [("a", "SP", "x", "9")]))
    assert brief(got) == [
        ("a", "x", "1", True, D1, None, "Initial load"),
        ("b", "z", "1", True, D1, None, "Initial load"),
    ]


def test_change_to_null(spark):
    days = (D1, [("a", "SP", "x", "1")]), (D2, [("a", "SP", None, "1")])
    assert len(brief(load(spark, *days))) == 2
    assert brief(load(spark, *days, compat=True)) == [("a", "x", "1", True, D1, None, "Initial load")]


def test_second_change_on_one_day(spark):
    days = (D1, [("a", "SP", "x", "1")]), (D2, [("a", "SP", "y", "1")]), (D2, [("a", "SP", "w", "3")])
    assert brief(load(spark, *days))[1] == ("a", "w", "3", True, D2, None, "Location updated")
    compat = brief(load(spark, *days, compat=True))
    assert [r[3] for r in compat] == [False, False], "compat mode ends without a current version"


def test_compat_first_load_with_null_city(spark):
    got = load(spark, (D1, [("a", "SP", None, "1")]), compat=True)
    assert brief(got) == [("a", None, "1", False, D1, D1, "Location changed")]
    after = scd2.apply(got, snapshot(spark, [("a", "SP", "x", "1")]), "id", TRACKED, D2, compat=True)
    assert brief(after)[1] == ("a", "x", "1", True, D2, None, "Location updated")


def test_late_snapshot_does_not_override_newer_version(spark):
    got = load(spark, (D2, [("a", "SP", "x", "1")]), (D1, [("a", "SP", "old", "1")]))
    assert brief(got) == [("a", "x", "1", True, D2, None, "Initial load")]


@pytest.mark.parametrize("seed", [1, 2])
def test_properties_over_random_snapshots(spark, seed):
    rng = random.Random(seed)
    ids = [f"s{i}" for i in range(12)]

    def some():
        return [
            (i, rng.choice(["SP", "RJ", None]), rng.choice(["x", "y", "z", None]), "1")
            for i in ids
            if rng.random() < 0.7
        ]

    days = [(dt.date(2024, 1, n), some()) for n in (1, 2, 3, 4)]
    dimension = load(spark, *days)
    versions = dimension.collect()
    last = {}
    for _, rows in days:
        last.update({r[0]: r[1:3] for r in rows})
    by_id = {}
    for v in versions:
        by_id.setdefault(v.id, []).append(v)
    assert set(by_id) == set(last)
    for key, vs in by_id.items():
        vs.sort(key=lambda v: v.valid_from)
        assert [v.is_current for v in vs] == [False] * (len(vs) - 1) + [True]
        assert all(a.valid_to == b.valid_from for a, b in zip(vs, vs[1:]))
        assert (vs[-1].state, vs[-1].city) == last[key]
    again = scd2.apply(dimension, snapshot(spark, days[-1][1]), "id", TRACKED, days[-1][0])
    assert sorted(map(repr, again.collect())) == sorted(map(repr, versions))


def test_history_and_current(spark):
    got = load(spark, (D1, [("a", "SP", "x", "1")]), (D2, [("a", "SP", "y", "1")]))
    assert [r.valid_from for r in scd2.history_of(got, "id", "a").collect()] == [D2, D1]
    assert [r.city for r in scd2.current(got).collect()] == ["y"]
