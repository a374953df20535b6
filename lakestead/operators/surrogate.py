"""Surrogate keys without a global counter."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F


class KeyCollision(ValueError):
    """Different rows of a dimension share a surrogate key."""


def guarded(df: DataFrame, key: str, natural: str) -> tuple[DataFrame, Callable[[], None]]:
    """The rows of a dimension, and a check that raises when a key was given twice.

    The rows of a key are counted on their way into the write, so the check needs no second pass; it is asked
    after the write, before the table is switched.
    """
    seen = Observation(f"keys-{key}-{uuid.uuid4().hex}")
    same = F.count("*").over(Window.partitionBy(key))
    clash = F.col("_same") > 1
    watched = df.withColumn("_same", same).observe(
        seen,
        F.count_if(clash).alias("rows"),
        F.min(F.when(clash, F.col(natural).cast("string"))).alias("one"),
        F.max(F.when(clash, F.col(natural).cast("string"))).alias("other"),
    )

    def check() -> None:
        if seen.get["rows"]:
            raise KeyCollision(
                f"{seen.get['rows']} rows share a {key}; among them are {seen.get['one']!r} and {seen.get['other']!r}"
            )

    return watched.drop("_same"), check


def hash_key(*natural: str | Column) -> Column:
    """Stable key computed from the natural one: needs no join and no state between loads."""
    return F.xxhash64(*natural)


def hash_collisions(df: DataFrame, natural: list[str]) -> DataFrame:
    """Hash keys shared by different natural keys; empty for a sound dimension."""
    keys = df.select(*natural).distinct()
    return keys.groupBy(hash_key(*natural).alias("hash_key")).agg(
        F.count("*").alias("n_keys")
    ).filter("n_keys > 1")


def dense_key(df: DataFrame, natural: list[str], name: str, buckets: int = 4096) -> DataFrame:
    """Ids 1..n. Rows are numbered inside hash buckets of the unique natural key and shifted by the
    sizes of the buckets before; only the ``buckets`` sizes are summed in one place."""
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*natural), F.lit(buckets)))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(*natural))
    # At most ``buckets`` rows: safe to broadcast at any size of ``df``.
    numbered = bucketed.withColumn("_position", position).join(F.broadcast(offsets), "_bucket")
    return numbered.select((F.col("_offset") + F.col("_position")).alias(name), *df.columns)
