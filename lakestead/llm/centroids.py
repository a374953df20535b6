"""Centroid clustering: Lloyd rounds on integer vectors with equal-average equal-variance search.

Components become integers, so distances, sums and new centroids are exact and do not depend on the order
of the rows. The kept vectors are written once as 4-byte integers. A round is one pass: every batch
finds its nearest centroids and gives one row of sums per centroid; Spark adds them up and the
driver gets k rows.

The search sorts the centroids by component sum. A vector starts at the sum nearest its own and goes outward
on both sides. A squared distance D to centroid c satisfies, in d dimensions,

    d * D >= (S_x - S_c)^2                                   (means)
    d * D >= (S_x - S_c)^2 + (sqrt A_x - sqrt A_c)^2          (means and deviations)

with S the component sum and A = d * sum of squares - S^2. Once the first fails against the best distance so
far, all centroids further out fail too and the vector is done; the second skips single
centroids. Both bounds are lowered by more than the error of their floating-point numbers. What is left is
decided by the distance in integers, and equal distances by the smaller number.

Bounds: k centroids of d components travel with the tasks and k rows of sums come back per round.

Defined cases: rows without a vector of d components, or with one that is null or not finite, are not kept; nor
is one so large that a distance might not fit a long (131,072 for 64 components in steps of 1/1024). Repeated rows are vectors of their own. A null id counts
as the empty text for the starting order; equal hashes are ordered by the vector. With fewer than k
vectors there are that many centroids. No vectors give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestead.llm.common import written

#: Part of a bound that is given up for the rounding of its floating-point numbers.
MARGIN = 1e-9


@dataclass(frozen=True)
class Clusters:
    k: int = 8
    dims: int = 64
    rounds: int = 10
    scale: int = 1024
    salt: str = "3"

    @property
    def most(self) -> float:
        """The greatest absolute value of a component: squared distances stay below 2 ** 62."""
        return math.isqrt((1 << 60) // self.dims) / self.scale


def integers(rows: DataFrame, id_col: str, vector: str, how: Clusters) -> DataFrame:
    """(id, v): the kept vectors as arrays of integers."""
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * how.scale))
    fits = F.forall(
        F.col(vector).cast("array<double>"),
        # NaN is greater than all numbers here; null makes the whole test null.
        lambda x: x.isNotNull() & (F.abs(x) <= F.lit(how.most)),
    )
    kept = rows.filter((F.size(vector) == how.dims) & fits)
    return kept.select(F.col(id_col).alias("id"), scaled.cast("array<int>").alias("v"))


def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


class Search:
    """The centroids in the order of their component sums, ready to be searched."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.centroids, self.sums = centroids[self.number], sums[self.number]
        self.spread = deviations(self.centroids, self.sums)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Per vector: number of the nearest centroid, squared distance; and how many distances were computed."""
        n, d = vectors.shape
        k = len(self.sums)
        sums = vectors.sum(axis=1)
        spread = deviations(vectors, sums)
        best = np.full(n, np.iinfo(np.int64).max)
        found = np.full(n, k)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        active, computed = np.arange(n), 0
        for _ in range(k):
            lo, hi = left[active], right[active]
            below = np.where(lo >= 0, sums[active] - self.sums[np.maximum(lo, 0)], np.inf)
            above = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - sums[active], np.inf)
            go_left = below <= above
            at = np.where(go_left, lo, hi)
            left[active] -= go_left
            right[active] += ~go_left
            limit = np.where(found[active] < k, best[active] * (d * (1 + MARGIN)) + 0.5, np.inf)
            means = np.minimum(below, above) ** 2 * (1 - MARGIN)
            alive = means <= limit
            active, at, means, limit = active[alive], at[alive], means[alive], limit[alive]
            if not len(active):
                break
            apart = np.abs(spread[active] - self.spread[at]) - MARGIN * (spread[active] + self.spread[at])
            near = means + np.maximum(apart, 0) ** 2 <= limit
            rows, at = active[near], at[near]
            computed += len(rows)
            gaps = vectors[rows] - self.centroids[at]
            distance = np.einsum("ij,ij->i", gaps, gaps)
            number = self.number[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < found[rows]))
            best[rows[better]], found[rows[better]] = distance[better], number[better]
        return found, best, computed


def deviations(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """sqrt(d * sum of squares - sum squared), to a relative error far below the margin of the search."""
    mean = sums[:, None] / vectors.shape[1]
    return np.sqrt(((vectors - mean) ** 2).sum(axis=1) * vectors.shape[1])


def partial_sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per centroid and component that the task saw: count and sum."""
    k, dims = centroids.shape
    search = Search(centroids)
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = matrix(batch, dims)
        found, _, _ = search.nearest(vectors)
        counts += np.bincount(found, minlength=k)
        order = np.argsort(found, kind="stable")
        first = np.flatnonzero(np.diff(found[order], prepend=-1))
        sums[found[order][first]] += np.add.reduceat(vectors[order], first)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict(
        {"cluster": pa.array(seen, pa.int32()), "n": counts[seen], "total": sums[seen].tolist()},
        pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]),
    )


def assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    search = Search(centroids)
    for batch in batches:
        found, distance, _ = search.nearest(matrix(batch, centroids.shape[1]))
        out = [batch.column("id"), pa.array(found, pa.int32()), pa.array(distance)]
        yield pa.RecordBatch.from_arrays(out, ["id", "cluster", "distance"])


def starting(vectors: DataFrame, how: Clusters) -> np.ndarray:
    """The k vectors with the least hashes of their ids."""
    mark = F.sha2(F.concat(F.lit(f"{how.salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = vectors.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(how.k).collect()
    return np.array([r.v for r in first], np.int64).reshape(-1, how.dims)


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    found = vectors.select("v").mapInArrow(
        partial(partial_sums, centroids=centroids), "cluster int, n long, total array<long>"
    )
    dims = centroids.shape[1]
    added = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dims)]
    moved = centroids.copy()
    for row in found.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect():  # k rows
        moved[row.cluster] = [row[f"s{i}"] // row.n for i in range(dims)]
    return moved


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(
    rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", how: Clusters = Clusters()
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) per kept vector, and the centroids."""
    spark = rows.sparkSession
    vectors = written(integers(rows, id_col, vector, how), "vectors")
    centroids = starting(vectors, how)
    schema = vectors.select(F.col("id"), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).schema
    if not len(centroids):
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col), centroids
    for _ in range(how.rounds):
        moved = next_centroids(vectors, centroids)
        if np.array_equal(moved, centroids):
            break  # further rounds change nothing
        centroids = moved
    placed = vectors.mapInArrow(partial(assigned, centroids=centroids), schema)
    return placed.withColumnRenamed("id", id_col), centroids


def with_inertia(placed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """placed with cluster_inertia, inertia and centroid_sha256."""
    placed = written(placed, "clusters")
    per_cluster = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    total = sum(r.cluster_inertia for r in per_cluster)
    facts = [(r.cluster, r.cluster_inertia, total, digest(centroids[r.cluster])) for r in per_cluster]
    known = placed.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return placed.join(F.broadcast(known), "cluster")  # k rows


def _sql_assign(name: str, centroids: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT rid, min_by(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT rid, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM vectors, {centroids}) GROUP BY rid)"""


def oracle_sql(how: Clusters = Clusters()) -> str:
    tables = [
        f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) = {how.dims}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {how.dims}),
vectors AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid,
         list_transform(e, lambda x: CAST(floor({how.scale} * x) AS BIGINT)) AS v FROM kept),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY mark, v) - 1 AS INTEGER) AS cluster, v AS c
  FROM (SELECT sha256('{how.salt}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS mark, v FROM vectors
        ORDER BY mark, v LIMIT {how.k}))"""
    ]
    for i in range(how.rounds):
        tables.append(_sql_assign(f"a{i}", f"c{i}"))
        tables.append(f"""
s{i} AS (
  SELECT cluster, dim, sum(x) AS total, count(*) AS n
  FROM (SELECT cluster, unnest(range({how.dims})) AS dim, unnest(v) AS x FROM a{i} JOIN vectors USING (rid))
  GROUP BY cluster, dim),
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.c) AS c FROM c{i} c LEFT JOIN (
    SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS v
    FROM s{i} GROUP BY cluster) m USING (cluster))""")
    last = how.rounds
    tables.append(_sql_assign("placed", f"c{last}"))
    return f"""
WITH {",".join(tables)}
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM placed JOIN vectors USING (rid) JOIN c{last} USING (cluster)
"""
