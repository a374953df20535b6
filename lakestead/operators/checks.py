"""Constraints as checks on the data: not null, unique, references, key discovery."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "violations")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values held by more than one row. NULLs never clash, as in a unique constraint."""
    known = df.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in key]))
    return known.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child key values without a parent and the rows that hold them.

    The child is counted per key first: the join then sees every value once, so a value that many
    rows share costs no more than a rare one.
    """
    used = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key_value"))
        .agg(F.count("*").alias("n_rows"))
    )
    known = parent.select(F.col(parent_key).alias("key_value"))
    return used.join(known, "key_value", "left_anti")


def reference_report(references: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Distinct values used, distinct parents, orphan values and orphan rows per reference."""

    def one(name: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str):
        used = child.groupBy(F.col(child_key).alias("key_value")).agg(F.count("*").alias("n_rows"))
        known = (
            parent.filter(F.col(parent_key).isNotNull())
            .select(F.col(parent_key).alias("key_value"), F.lit(True).alias("known"))
            .distinct()
        )
        # Both sides hold each value once; values only the parent has still count as parents.
        joined = used.join(known, "key_value", "full_outer").filter("key_value is not null")
        orphan = F.col("known").isNull()
        return joined.agg(
            F.count("n_rows").alias("distinct_values"),
            F.count("known").alias("distinct_parents"),
            F.count_if(orphan).alias("orphan_values"),
            F.coalesce(F.sum(F.when(orphan, F.col("n_rows"))), F.lit(0)).alias("orphan_rows"),
        ).select(F.lit(name).alias("reference"), "*")

    rows = [one(n, c, ck, p, pk) for n, (c, ck, p, pk) in references.items()]
    return reduce(DataFrame.unionByName, rows)


def key_candidates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Which single columns could be the primary key: no NULL and no repeated value.

    One grouping per value of every column: the long form combines repeats before its shuffle.
    """
    pairs = df.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "column_name", "v")
    per_value = pairs.groupBy("column_name", "v").agg(F.count("*").alias("n"))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.count("v").alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_nulls"),
        (F.max("n") == 1).alias("is_unique"),
    ).withColumn("is_candidate", F.col("is_unique") & (F.col("n_nulls") == 0)).drop("is_unique")
