"""The corpus pipeline over `documents`.

Quality rules reject documents, line dedup takes frequent lines out of the others, near dedup keeps one
document of each group, mixing takes sources by their weights (a document of a short source up to
twice), and packing cuts what is left into training sequences. Every stage sees all that the one before kept; its
result is written as a table, which the next one reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestead.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from lakestead.llm.common import carry, table, tune, unpack, written
from lakestead.llm.queries import MIX, tree, trusted_ids
from lakestead.session import Scratch

#: Five words and a similarity of 0.8; 32 bands of 4 miss a link at 0.8 with a chance of 5e-8.
NEAR = near_dedup.Near(shingle=5, percent=80, bands=32, rows=4)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, as they are."""
    judged = quality_rules.quality_rules(carry(docs, "doc_id", "text"), trusted_ids(tune(spark), sf_dir))
    return unpack(judged.filter("kept"), docs.columns)


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that stand in ten or more; n_chars follows the text."""
    tune(spark)
    done = line_dedup.line_dedup(carry(docs, "doc_id", "text"))
    changed = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("carried.n_chars"))
    return unpack(done, docs.columns, n_chars=changed.cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; of repeated rows of an id, all."""
    tune(spark)
    found = near_dedup.near_dedup(docs, near=NEAR)
    gone = found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter("not kept").select("doc_id")
    return docs.join(written(gone, "near_copies"), "doc_id", "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    tune(spark)
    kept = carry(docs, "doc_id", "text", "lang", "source")
    return unpack(mixing.mix_sources(kept, tree(), MIX), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of documents, placed in training sequences."""
    tune(spark)
    return packing.best_fit_packing(docs)


STAGES = [
    ("quality rules", drop_low_quality),
    ("line dedup", drop_frequent_lines),
    ("near dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: The first stage hashes n-grams, and the last one packs greedily: SQL has no form of either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # What a stage wrote on its way goes when its result is written.
        with Scratch(spark) as own:
            kept = stage(spark, docs, sf_dir)
            with own.outside():
                docs = written(kept, name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
