"""Line dedup: drop the lines whose normalised text stands in many documents.

Lines are exploded with their position, normalised and hashed (two 64-bit hashes). Every document
contributes each hash once; hashes of at least ``min_docs`` distinct documents are written as a table.
Line positions of those hashes come back to their document, and the other lines are joined again in
their order.

Only DataFrame functions are used. Pairs of hash and document are made distinct and then counted; both steps
pre-aggregate in every task, so a line that all documents share is one row per task. The join of lines with frequent hashes has plain exchanges or
a written table on both sides, so adaptive planning can split a hot line. Only numbers are exploded;
the text itself is shuffled once, by document.

Defined cases: a null or empty text is one empty line. An empty key is never dropped. A document is an id: its
rows, repeated or not, count once per key, and so do all rows without an id together. A document that loses all
lines has the empty text. Extra columns are left alone, but for ones named n_lines or n_dropped, in any
spelling, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestead.llm.common import SPACE, bind, lower_ascii, private, written

MIN_DOCS = 10


def _hashes(text: Column) -> Column:
    """One entry per line: the hashes of its key, or null for an empty key."""
    return F.transform(
        F.split(lower_ascii(text), "\n"),
        lambda line: bind(
            F.btrim(line, F.lit(SPACE)),
            lambda key: F.when(
                key != "",
                F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")),
            ),
        ),
    )


def frequent_lines(docs: DataFrame, id_col: str, text: str, min_docs: int) -> DataFrame:
    """(h1, h2) of the keys that stand in at least min_docs distinct documents."""
    keys = F.array_compact(F.array_distinct(_hashes(F.coalesce(F.col(text), F.lit("")))))
    return (
        docs.select(F.col(id_col).alias("id"), F.explode(keys).alias("k"))
        .select("id", F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2"))
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
        .select("h1", "h2")
    )


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS
) -> DataFrame:
    """docs with text replaced by the lines that stay, and with n_lines and n_dropped added."""
    frequent = written(frequent_lines(docs, id_col, text, min_docs), "frequent_lines")
    body = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(body).alias("fp"),
        F.posexplode(_hashes(body)).alias("pos", "k"),
    ).filter(F.col("k").isNotNull())
    dropped = (
        lines.select("id", "fp", "pos", F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2"))
        .join(frequent, ["h1", "h2"], "left_semi")
        .groupBy("id", "fp")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    fp, gone, key_id, key_fp = private(docs, "fp", "dropped", "key_id", "key_fp")
    dropped = dropped.select(
        F.col("id").alias(key_id), F.col("fp").alias(key_fp), F.col("dropped").alias(gone)
    )
    joined = docs.withColumn(fp, F.xxhash64(body)).join(
        dropped, F.col(id_col).eqNullSafe(F.col(key_id)) & (F.col(fp) == F.col(key_fp)), "left"
    )
    n_lines = F.size(F.split(body, "\n")).cast("long")
    kept = bind(
        F.split(body, "\n"),
        lambda all_lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(gone)),
                lambda pos: F.get(all_lines, pos),
            ),
            "\n",
        ),
    )
    columns = [
        F.when(F.col(gone).isNull(), body).otherwise(kept).alias(c) if c == text else F.col(f"`{c}`")
        for c in docs.columns
        if c.lower() not in ("n_lines", "n_dropped")
    ]
    n_dropped = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    n_dropped = F.when(F.col(gone).isNull(), F.lit(0).cast("long")).otherwise(n_dropped)
    return joined.select(*columns, n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (
  SELECT k.*, f.key IS NOT NULL AS hit FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hit) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
