"""Text rules and table helpers that the operators of this package share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestead.session import scratch_dir

#: The white space of the word and line rules: blank and \\x09 to \\x0D.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"

#: Settings that the plans of this package rely on; none depends on the size of the data.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared scratch folder; cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all else as it is. Texts of ASCII alone take the faster lower()."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column) -> Column:
    """The maximal runs without white space, in order; none for a null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))


def bind(value: Column, body) -> Column:
    """body(value) with value computed once: lambda variables are never inlined by the optimizer."""
    return F.transform(F.array(value), body)[0]


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def private(df: DataFrame, *names: str) -> list[str]:
    """For each name a column name that df does not have yet, so that extra columns never clash."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def carry(docs: DataFrame, *needed: str) -> DataFrame:
    """docs as its needed columns and one struct `carried` of all others, which no operator's columns clash with."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, F.struct(F.lit(0).alias("none"), *rest).alias("carried"))


def unpack(carried: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The named columns again, from the needed ones and `carried`."""
    inner = carried.schema["carried"].dataType.names
    own = lambda c: F.col("carried").getField(c) if c in inner else F.col(c)
    return carried.select(*[changed.get(c, own(c)).alias(c) for c in columns])
