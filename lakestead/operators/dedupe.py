"""One row per key, and inserts that respect a key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestead.functions.scalars import moment


def first_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row per key. Spark keeps one row per key and task before it shuffles, so copies of a hot key
    never meet in one task as a full group."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def best_per_key(df: DataFrame, key: list[str], better: Column, tie: str) -> DataFrame:
    """Keep the row with the highest ``better`` per key, the lowest ``tie`` among equals."""
    return first_per_key(df, key, [better.desc_nulls_last(), F.asc_nulls_last(tie)])


def insert_ignore(existing: DataFrame, new: DataFrame, key: list[str], first: str) -> DataFrame:
    """Add the new rows whose key is not there yet; the lowest ``first`` wins among new ones."""
    rows = first_per_key(new, key, [F.asc_nulls_last(first)])
    fresh = rows.join(existing.select(*key), key, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def upsert_touch(
    existing: DataFrame, new: DataFrame, key: str, now: dt.datetime, refresh: bool = False
) -> DataFrame:
    """Insert unknown keys; known ones only get a new ``updated_at``.

    ``refresh=True`` also takes the new attributes. ``new`` holds a key at most once.
    """
    stamp = moment(now)
    kept = {"created_at", "updated_at", key}
    attributes = [c for c in existing.columns if c not in kept and c in new.columns]
    incoming = new.select(key, F.struct(*attributes).alias("_new"))
    merged = existing.join(incoming, key, "left")
    matched = F.col("_new").isNotNull()

    def value(c: str) -> Column:
        if c == "updated_at":
            return F.when(matched, stamp).otherwise(F.col(c)).alias(c)
        if refresh and c in attributes:
            return F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
        return F.col(c)

    touched = merged.select(*[value(c) for c in existing.columns])
    fresh = (
        new.join(existing.select(key), key, "left_anti")
        .withColumn("created_at", stamp)
        .withColumn("updated_at", stamp)
    )
    return touched.unionByName(fresh.select(*existing.columns))
