"""Rows of a large table that may have one of many keys, told apart where they lie.

The keys set three bits each in one of 2^21 words of a Bloom filter. Only words with a bit are rows of it, so it has
at most as many rows as there are keys, and 2^21 of two numbers each: the bound of what is broadcast. A row
whose bits are not all set has none of the keys. The other rows have one, but for a small part (about 3 % of
the rest at 15 million keys, more beyond), so they have to meet the keys themselves. More false positives move more rows; the
results stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 1 << 21


def split(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that have none of the keys (column ``key`` of both frames) for certain, and all others. A null key
    is none."""
    marked = df.withColumns(_place(key))
    words = _words(key, keys)
    without = marked.join(words, "_word", "left").filter(
        F.col(key).isNull() | F.col("_set").isNull() | (F.col("_set").bitwiseAND(F.col("_bits")) != F.col("_bits"))
    )
    return without.select(*df.columns), _hits(marked, words, key).select(*df.columns)


def possible(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows that may have one of the keys; all that have one are among them."""
    return _hits(df.withColumns(_place(key)), _words(key, keys), key).select(*df.columns)


def having(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows that have one of the keys; few others move."""
    # A semi join would be moved below the one with the words, and all rows dealt by key.
    return possible(df, key, keys).join(keys.select(key).distinct(), key).select(*df.columns)


def lacking(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows that have none of the keys, out of few; an anti join that is not moved."""
    known = keys.select(key).distinct().withColumn("_known", F.lit(True))
    return df.join(known, key, "left").filter("_known is null").select(*df.columns)


def _hits(marked: DataFrame, words: DataFrame, key: str) -> DataFrame:
    hit = F.col("_set").bitwiseAND(F.col("_bits")) == F.col("_bits")
    return marked.join(words, "_word").filter(F.col(key).isNotNull() & hit)


def _words(key: str, keys: DataFrame) -> DataFrame:
    placed = keys.filter(F.col(key).isNotNull()).select(*[c.alias(n) for n, c in _place(key).items()])
    return F.broadcast(placed.groupBy("_word").agg(F.bit_or("_bits").alias("_set")))


def _place(key: str) -> dict[str, Column]:
    """The word of a key and its bits there."""
    h, one = F.xxhash64(key), F.lit(1).cast("bigint")

    def bit(first: int) -> Column:
        place = F.shiftrightunsigned(h, first).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        return F.call_function("shiftleft", one, place)

    return {
        "_word": h.bitwiseAND(F.lit(WORDS - 1).cast("bigint")),
        "_bits": bit(21).bitwiseOR(bit(27)).bitwiseOR(bit(33)),
    }
