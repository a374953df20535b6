"""Substring dedup: repeated word sequences as repeated paths of a De Bruijn graph.

Every ``width`` consecutive words of a document are an edge of the graph, from their first width - 1
words to their last. Edges that occur twice are what is removed, at every place.

1. Edges are dealt by their minimizer, the least hash of ``seed`` consecutive words in them: equal edges
   have the same one. Consecutive edges of a document with the same minimizer are one path, so a document
   of n words has about 2n / (width - seed + 2) paths instead of n edges. Only minimizers that occur
   twice matter. A Bloom filter of them (16 bits each, ``max_bits`` at most: the bound of what is
   broadcast) lets the other paths go without a shuffle; false positives are harmless.
2. Equal paths (128 bits: the minimizer, and a digest over all edges and their distance from it) are compacted
   into one row with the number of places. A path that stands at two places is repeated as a whole.
3. Where a minimizer has several different paths the graph branches: those paths are taken apart into
   their edges, which are counted over all paths of the minimizer (another Bloom filter picks them). A join
   brings the repeated ones back to their path, and a second join brings the repeated runs of each path to
   its source coordinates, where the words are covered.
4. The runs of a document, joined to it, cover the words to remove; runs that touch grow together.

Counting pre-aggregates. Joins on minimizers, edges and paths, which may be hot, have written tables or
exchanges on both sides, so adaptive planning can split them. The texts are shuffled once, by document.

Defined cases: a null or blank text has no words and stays as the empty text. Fewer words than ``width`` have
no edge. Every row is a place of its own, so repeated rows are removed like other copies. Rows that
share id and text share their fate. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestead.llm.arrays import Words, mix, pieces, signed, window_hashes
from lakestead.llm.common import written
from lakestead.llm.exact_dedup import bitmap_places, bits_for, in_bitmap, segment_bitmaps

_U = np.uint64


@dataclass(frozen=True)
class Repeats:
    #: At most 255 + seed words.
    width: int = 35
    seed: int = 8
    max_bits: int = 1 << 30


def _least_places(values: np.ndarray, span: int) -> np.ndarray:
    """For every i the first place of the least of values[i:i + span]."""
    n = len(values) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, place, have = values, np.arange(len(values)), 1
    while have < span:
        step = min(have, span - have)
        left, right = best[:-step], best[step:]
        first = left <= right
        best = np.where(first, left, right)
        place = np.where(first, place[:-step], place[step:])
        have += step
    return place[:n]


def _cut(texts: pa.Array, rules: Repeats) -> tuple[np.ndarray, ...]:
    """Paths of a batch: row, minimizer, first edge in the row, its distance from the minimizer, begin
    and end among all edges of the batch; and the edges' hashes."""
    found = Words(texts, fold=False)
    edges = window_hashes(found.hashes, rules.width)
    seeds = window_hashes(found.hashes, rules.seed)
    place = _least_places(seeds, rules.width - rules.seed + 1)[: len(edges)]
    counts = np.maximum(np.diff(found.first) - rules.width + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    valid = found.first[:-1][row] + at  # among all windows, those that stay inside their row
    place = place[valid]
    starts = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])])) if len(row) else np.zeros(0, np.int64)
    return row[starts], seeds[place[starts]], at[starts], place[starts] - valid[starts], starts, edges[valid]


#: Columns of a path; `edges` are the hashes of its edges in order.
PATH = {
    "id": "long",
    "fp": "long",
    "seed": "long",
    "at": "int",
    "ahead": "int",
    "size": "int",
    "digest": "long",
    "edges": "array<long>",
}


def path_table(docs: DataFrame, rules: Repeats, *columns: str) -> DataFrame:
    """One row per path of docs(id, fp, text), with the named columns of PATH."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            row, seed, at, ahead, starts, edges = _cut(batch.column("text"), rules)
            sizes = np.diff(np.append(starts, len(edges)))
            make = {
                "id": lambda: batch.column("id").take(pa.array(row)),
                "fp": lambda: batch.column("fp").take(pa.array(row)),
                "seed": lambda: pa.array(signed(seed), pa.int64()),
                "at": lambda: pa.array(at.astype(np.int32)),
                "ahead": lambda: pa.array(ahead.astype(np.int32)),
                "size": lambda: pa.array(sizes.astype(np.int32)),
                "digest": lambda: pa.array(signed(digests(edges, starts, sizes, ahead)), pa.int64()),
                "edges": lambda: pa.ListArray.from_arrays(
                    pa.array(np.append(starts, len(edges)).astype(np.int32)), pa.array(signed(edges), pa.int64())
                ),
            }
            yield pa.RecordBatch.from_arrays([make[c]() for c in columns], names=list(columns))

    return docs.mapInArrow(work, ", ".join(f"{c} {PATH[c]}" for c in columns))


def digests(edges: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """One number for all edges of each path with their distances from the minimizer."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    distance = np.repeat(ahead + starts, sizes) - np.arange(len(edges))
    return np.add.reduceat(mix(edges + (distance.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15)), starts)


def _filtered(paths: DataFrame, seeds: DataFrame, rules: Repeats, name: str) -> DataFrame:
    """The paths whose minimizer may be among seeds, by a Bloom filter of bounded size."""
    seeds = written(seeds, name)
    segments = bits_for(seeds.count(), rules.max_bits)
    bloom = written(segment_bitmaps(seeds.select(*bitmap_places("seed", segments)), 1), f"{name}_filter")
    return (
        paths.select("*", *bitmap_places("seed", segments))
        .join(F.broadcast(bloom), "segment")
        .filter(in_bitmap("bit1") & in_bitmap("bit2"))
        .select(*paths.columns)
    )


def repeated_runs(docs: DataFrame, rules: Repeats) -> DataFrame:
    """(id, fp, runs) for docs(id, fp, text): first << 8 | number of repeated edges, in no order."""
    path = ["seed", "digest"]
    seeds = path_table(docs, rules, "seed").groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed")
    places = _filtered(path_table(docs, rules, "id", "fp", "seed", "at", "size", "digest"), seeds, rules, "repeated")
    places = written(places, "places")
    # Compaction: one row per different path, with the number of its places.
    classes = places.groupBy(*path).agg(F.count("*").alias("places"), F.first("size").alias("size"))
    classes = written(classes, "path_classes")
    # Branches: different paths of one minimizer, edge by edge. A path that the filter lets through without
    # need has one place and no other path to share edges with, or is repeated as a whole.
    branching = classes.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed")
    split = (
        _filtered(path_table(docs, rules, "seed", "ahead", "digest", "edges"), branching, rules, "branching")
        .groupBy(*path)
        .agg(F.count("*").alias("places"), F.first("ahead").alias("ahead"), F.first("edges").alias("edges"))
        .select(*path, "places", "ahead", F.posexplode("edges").alias("i", "edge"))
        .select(*path, "places", "i", (F.col("ahead") - F.col("i")).alias("distance"), "edge")
    )
    split = written(split, "edges")
    edge = ["seed", "distance", "edge"]
    repeated = split.groupBy(*edge).agg(F.sum("places").alias("places")).filter("places > 1").select(*edge)
    parts = split.filter("places = 1").join(written(repeated, "repeated_edges"), edge, "left_semi")
    runs = classes.filter("places > 1").select(*path, F.lit(0).alias("first"), "size").unionByName(
        parts.select(*path, F.col("i").alias("first"), F.lit(1).alias("size"))
    )
    run = F.shiftleft((F.col("at") + F.col("first")).cast("long"), 8) + F.col("n")
    return (
        places.select("id", "fp", "at", *path)
        .join(written(runs.withColumnRenamed("size", "n"), "runs"), path)
        .groupBy("id", "fp")
        .agg(F.collect_set(run).alias("runs"))
    )


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: Repeats = Repeats()  # noqa: B008
) -> DataFrame:
    """One row per row of docs: id, the kept words joined by blanks, n_words, n_removed, sha of what is kept."""
    body = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(body).alias("fp"), body.alias("text"))
    runs = repeated_runs(slim, rules).select(F.col("id").alias("r_id"), F.col("fp").alias("r_fp"), "runs")
    width = rules.width

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out: dict[str, list] = {"text": [], "n_words": [], "n_removed": [], "sha": []}
            for i, value in enumerate(batch.column("text")):
                words = value.as_py().encode().split()
                n, found = len(words), batch.column("runs")[i]
                if found.is_valid:
                    cover = np.zeros(n + 1, np.int64)
                    run = np.asarray(found.values)
                    np.add.at(cover, run >> 8, 1)
                    np.add.at(cover, (run >> 8) + (run & 255) + width - 1, -1)
                    stay = np.flatnonzero(np.cumsum(cover[:n]) == 0)
                    words = [words[k] for k in stay.tolist()]
                kept = b" ".join(words)
                out["text"].append(kept.decode())
                out["n_words"].append(n)
                out["n_removed"].append(n - len(words))
                out["sha"].append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(out["text"], pa.string()),
                    pa.array(out["n_words"], pa.int64()),
                    pa.array(out["n_removed"], pa.int64()),
                    pa.array(out["sha"], pa.string()),
                ],
                names=["id", "text", "n_words", "n_removed", "kept_sha256"],
            )

    joined = slim.join(runs.hint("merge"), F.col("id").eqNullSafe(F.col("r_id")) & (F.col("fp") == F.col("r_fp")), "left")
    done = joined.select("id", "text", "runs").mapInArrow(
        work, "id long, text string, n_words long, n_removed long, kept_sha256 string"
    )
    return done.select(F.col("id").alias(id_col), F.col("text").alias("kept_text"), "n_words", "n_removed", "kept_sha256")


ORACLE_SQL = """
WITH worded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM worded),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM worded WHERE len(w) >= 35)),
repeated AS (
  SELECT doc_id, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS pos FROM repeated),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
  FROM words ANTI JOIN removed USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM worded d LEFT JOIN kept USING (doc_id)
"""
