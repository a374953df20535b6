"""Exact percentile of few groups, each too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# A 64-bit value is resolved in three steps of 21 bits, so that no step orders more than 2^22
# counts per group, whatever the number of rows.
_SHIFTS = (42, 21, 0)


def exact_percentile(
    df: DataFrame, keys: list[str], value: str, fraction: float, scale: int, out: str
) -> DataFrame:
    """Per group, the percentile of a decimal column with linear interpolation.

    Counts per coarse range of values tell which range holds the wanted ranks; the next step looks
    only into that range. Counts are combined before each shuffle, and no group is ever collected,
    unlike in the built-in exact percentile. NULL values are left out. Meant for a number of
    groups fixed by the caller, such as segments: two wanted ranks per group are broadcast.
    """
    units = (F.col(value) * F.lit(10**scale)).cast("bigint")
    values = df.filter(F.col(value).isNotNull()).select(*keys, units.alias("_v"))

    # Step 1: where do the two ranks around the percentile fall among the coarsest ranges?
    counts = values.groupBy(*keys, F.shiftright("_v", _SHIFTS[0]).alias("_range")).agg(
        F.count("*").alias("_count")
    )
    group = Window.partitionBy(*keys)
    point = F.lit(str(fraction)).cast("decimal(12,10)") * (F.sum("_count").over(group) - 1).cast(
        "decimal(19,0)"
    )
    low = F.floor(point).cast("bigint")
    upto = F.sum("_count").over(group.orderBy("_range"))
    located = counts.select(
        *keys,
        "_range",
        (upto - F.col("_count")).alias("_before"),
        upto.alias("_upto"),
        (point - low).cast("decimal(12,10)").alias("_weight"),
        low.alias("_low"),
        F.ceil(point).cast("bigint").alias("_high"),
    ).select("*", F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("_low").alias("rank")),
                                    F.struct(F.lit(1).alias("end"), F.col("_high").alias("rank")))).alias("w"))
    wanted = _hit(located.select("*", F.col("w.end").alias("_end"), F.col("w.rank").alias("_rank")), keys)

    # Steps 2 and 3: the same inside the range found before.
    for coarse, fine in zip(_SHIFTS, _SHIFTS[1:]):
        inside = values.withColumn("_within", F.shiftright("_v", coarse)).join(
            F.broadcast(wanted), [*keys, "_within"]
        )
        state = [*keys, "_end", "_weight", "_rank"]
        counts = inside.groupBy(*state, F.shiftright("_v", fine).alias("_range")).agg(
            F.count("*").alias("_count")
        )
        upto = F.sum("_count").over(Window.partitionBy(*keys, "_end").orderBy("_range"))
        wanted = _hit(
            counts.select("*", (upto - F.col("_count")).alias("_before"), upto.alias("_upto")), keys
        )

    found = F.col("_within").cast("decimal(20,0)")
    ends = wanted.groupBy(*keys).agg(
        F.min(found).alias("_lo"), F.max(found).alias("_hi"), F.max("_weight").alias("_weight")
    )
    exact = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_weight")
    unit = F.lit(10**scale).cast("decimal(10,0)")
    return ends.select(*keys, (exact / unit).cast(out).alias("percentile"))


def _hit(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """The ranges that hold a wanted rank, with the rank counted from the start of its range."""
    return ranges.filter("_rank >= _before and _rank < _upto").select(
        *keys,
        "_end",
        "_weight",
        (F.col("_rank") - F.col("_before")).alias("_rank"),
        F.col("_range").alias("_within"),
    )
