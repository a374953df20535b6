"""Record rules as column expressions: penalties, score, validity and notes in one projection."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestead.fixed_values import VALID_ABOVE
from lakestead.functions.scalars import clamp, join_notes

SCORE = "decimal(3,2)"


@dataclass(frozen=True)
class Rule:
    failed: Column
    penalty: str
    note: str | Column

    def cost(self) -> Column:
        return F.when(self._fails(), F.lit(self.penalty).cast(SCORE)).otherwise(
            F.lit("0.00").cast(SCORE)
        )

    def remark(self) -> Column:
        return F.when(self._fails(), F.lit(self.note) if isinstance(self.note, str) else self.note)

    def _fails(self) -> Column:
        return F.coalesce(self.failed, F.lit(True))


def assess(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add score, validity and notes. Validity is judged before the score is clamped; decimals keep
    the sum free of float noise."""
    total = reduce(Column.__add__, [r.cost() for r in rules])
    raw = F.lit("1.00").cast(SCORE) - total
    return df.select(
        "*",
        clamp(raw, F.lit("0.00").cast(SCORE), F.lit("1.00").cast(SCORE)).cast(SCORE).alias(
            "data_quality_score"
        ),
        (raw > F.lit(VALID_ABOVE).cast(SCORE)).alias("is_valid"),
        join_notes([r.remark() for r in rules]).alias("validation_notes"),
    )


def quality_summary(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows, valid rows, mean and lowest score of every table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        score = F.col("data_quality_score")
        return df.agg(
            F.count("*").alias("total"),
            F.count_if("is_valid").alias("valid"),
            F.try_divide(F.sum(score), F.count(score).cast("decimal(19,0)"))
            .cast("decimal(6,3)")
            .alias("avg_quality"),
            F.min(score).alias("min_quality"),
        ).select(F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in frames.items()])


def status_counts(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("order_status").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc("order_status"))
