"""Raw zone: every source row becomes one JSON document with its lineage."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampNTZType, TimestampType

from lakestead.fixed_values import RAW_USER
from lakestead.functions.scalars import iso_timestamp, moment
from lakestead.operators.dedupe import first_per_key


def null_normalised(df: DataFrame) -> DataFrame:
    """NaN and infinities become NULL, timestamps ISO text."""

    def clean(field) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            finite = ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
            return F.when(finite, c)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return iso_timestamp(c)
        return c

    return df.select(*[clean(f).alias(f.name) for f in df.schema])


def to_documents(
    df: DataFrame,
    source_table: str,
    loaded_at: dt.datetime,
    raw_id: str | None = None,
    with_hash: bool = True,
) -> DataFrame:
    """One document per row; nulls stay in it. ``raw_id`` names a unique column of ``df`` that is
    taken as the row id and left out of the document; without it ids are unique but not dense."""
    rows = null_normalised(df)
    body = F.struct(*[f"`{c}`" for c in df.columns if c != raw_id])
    document = F.to_json(body, {"ignoreNullFields": "false"})
    ident = F.col(raw_id).cast("bigint") if raw_id else F.monotonically_increasing_id()
    documents = rows.select(ident.alias("raw_id"), document.alias("data"))
    return documents.select(
        "raw_id",
        "data",
        F.lit(source_table).alias("source_table"),
        moment(loaded_at).alias("loaded_at"),
        (F.sha2("data", 256) if with_hash else F.lit(None).cast("string")).alias("file_hash"),
        F.lit(RAW_USER).alias("created_by"),
    )


def load_audit(documents: list[DataFrame], source_schema: str = "source_data") -> DataFrame:
    """One audit row per table and load, counted from the documents."""

    def audit(df: DataFrame) -> DataFrame:
        per_load = df.groupBy("source_table", "loaded_at").agg(F.count("*").alias("n"))
        return per_load.select(
            F.col("source_table").alias("table_name"),
            F.col("n").alias("total_records"),
            "loaded_at",
            F.concat(F.lit(f"{source_schema}."), "source_table").alias("source_file"),
            F.col("n").alias("record_count"),
            F.lit("loaded").alias("status"),
        )

    return reduce(DataFrame.unionByName, [audit(d) for d in documents])


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, so that the audit needs no second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def load_stats(documents: DataFrame) -> DataFrame:
    return documents.groupBy("source_table").agg(
        F.count("*").alias("record_count"),
        F.min("loaded_at").alias("first_record"),
        F.max("loaded_at").alias("last_record"),
    )


def unique_documents(documents: DataFrame) -> DataFrame:
    """Keep the first of all rows with equal content."""
    hashed = documents.withColumn("file_hash", F.coalesce(F.col("file_hash"), F.sha2("data", 256)))
    columns = ["raw_id", "data", "source_table", "loaded_at", "file_hash", "created_by"]
    return first_per_key(hashed, ["source_table", "file_hash"], [F.asc("raw_id")]).select(*columns)


def without_redelivered(documents: DataFrame) -> DataFrame:
    """Documents of all loads without those that an earlier load already brought.

    Equal documents of one load all stay: two items of an order may well be the same. ``load_id`` orders
    the loads. One small row per content meets the documents, not their groups.
    """
    first = documents.groupBy("file_hash").agg(F.min("load_id").alias("load_id"))
    return documents.join(first, ["file_hash", "load_id"], "left_semi").select(*documents.columns)
