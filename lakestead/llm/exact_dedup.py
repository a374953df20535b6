"""Exact dedup: a Bloom filter of repeated hashes decides which rows have to meet.

Every row is fingerprinted once (SHA-256 of the text with A-Z lower-cased; id and fingerprint are
written). The first pass sets two bits per fingerprint in one segment of a blocked Bloom filter and
counts them up to "twice or more"; only bits set twice make up the filter. The second
pass lets every row through whose bits are not both in it: no other row can have its text. The rest,
a small part where repeats are few, is grouped by fingerprint. False positives only shuffle more rows.

The filter has 16 bits per row, rounded up to a power of two, and at most ``max_bits`` (2^30 bits,
128 MB): the bound of what is broadcast. Beyond 2^26 rows it fills up, and more single rows are
shuffled; the result is the same. Counting and grouping pre-aggregate, and the join that brings the
group back has exchanges on both sides, so adaptive planning can split a hot text.

Defined cases: a null text is the empty text. Rows equal in id and text are one document and give one
row. A null id is less than all others. Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestead.llm.common import lower_ascii, written

MAX_BITS = 1 << 30
BITS_PER_ROW = 16
SEGMENT = 1 << 15  # bits of one bitmap of bitmap_construct_agg


def fingerprints(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    sha = F.unhex(F.sha2(lower_ascii(F.coalesce(F.col(text), F.lit(""))), 256))
    return docs.select(F.col(id_col).alias("id"), sha.alias("sha"))


def bits_for(rows: int, max_bits: int) -> int:
    """Segments of a filter for that many rows."""
    return max(SEGMENT, min(max_bits, 1 << (BITS_PER_ROW * max(rows, 1) - 1).bit_length())) // SEGMENT


def bitmap_places(column: str, n_segments: int) -> list[Column]:
    """The segment of a value in a blocked filter, and its two bits there."""
    h, g = F.xxhash64(column), F.xxhash64(F.lit(1), column)
    return [
        F.pmod(h, F.lit(n_segments)).cast("int").alias("segment"),
        F.pmod(g, F.lit(SEGMENT)).cast("int").alias("bit1"),
        F.pmod(F.shiftrightunsigned(g, 20), F.lit(SEGMENT)).cast("int").alias("bit2"),
    ]


def segment_bitmaps(placed: DataFrame, least: int) -> DataFrame:
    """(segment, bitmap) of the bits that at least that many rows of (segment, bit1, bit2) set."""
    return (
        placed.select("segment", F.explode(F.array_distinct(F.array("bit1", "bit2"))).alias("bit"))
        .groupBy("segment", "bit")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= least)
        .groupBy("segment")
        .agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bitmap"))
    )


def in_bitmap(bit: str) -> Column:
    """Whether a bit is set in the column bitmap."""
    byte = F.substring("bitmap", F.shiftright(bit, 3) + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.col(bit).bitwiseAND(F.lit(7))) == 1


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept and sha (binary)."""
    prints = written(fingerprints(docs, id_col, text), "fingerprints")
    segments = bits_for(prints.count(), max_bits)
    bloom = written(segment_bitmaps(prints.select(*bitmap_places("sha", segments)), 2), "repeated_bits")
    maybe = F.col("bitmap").isNotNull() & in_bitmap("bit1") & in_bitmap("bit2")
    probed = (
        prints.select("id", "sha", *bitmap_places("sha", segments))
        .join(F.broadcast(bloom), "segment", "left")
        .select("id", "sha", maybe.alias("maybe"))
    )
    one = F.lit(1).cast("long")
    single = probed.filter(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), one.alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    suspects = probed.filter("maybe").select("id", "sha").distinct()
    groups = written(
        suspects.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")),
        "groups",
    )
    met = suspects.join(groups, "sha").select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "sha"
    )
    return single.unionByName(met).withColumnRenamed("id", id_col)


ORACLE_SQL = """
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
           AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM hashed
"""
