"""MinHash near-dedup: components of documents whose shingle sets are at least ``percent`` alike.

1. Every text becomes its set of hashed word shingles, a digest of the set, and ``bands`` band keys over
   many universal hash minima (``rows`` minima each). Equal digests are one class; only its smallest id
   goes on, so copies cost one row each however many there are. All this is one pass in numpy over Arrow batches.
2. Band keys that several classes share make buckets. The leader of a bucket is the member that is most
   at home in large buckets, the centre of its group. Every member is paired with the leaders of its
   buckets, never with all members. Pairs are verified by their signatures and then on the full sets.
3. Components of the verified links by alternating large-star and small-star until nothing changes.
4. A bucket whose members are in one component is done. In the others, members of different components
   are compared block against block (``block`` members each), first by signature and then set against set. So a member is sent
   as often as its bucket has blocks. Buckets of more than ``spread`` blocks, as documents of one template make them,
   are dealt by a prefix filter instead: of two linked sets, each ordered by how rare its shingles are
   among all of them, the first ``n - least common + 1`` share one. So their members meet only where different components
   share a rare shingle. Both ways find every link. A block gives links that join components, fewer than it has
   members. With them the components are
   final: a link is missed only if no band key agrees, which has a chance of 7e-8 at 0.85 with 28 bands
   of 5, and of 5e-8 at 0.8 with 32 bands of 4.

Verifying joins signatures first; full sets, which may be long, are joined to the pairs that pass.

Joins on keys that may be hot have exchanges or written tables on both sides; every group is
reduced before it is shuffled. Only documents in shared buckets are looked at again.

Defined cases: ids are integers. A-Z are lower-cased. A text with fewer words than a shingle is one shingle. A text without
words, and a row with a null id, is linked with nothing. Rows that share an id are one
document: their links add up, and the result has one row per row. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestead.llm.arrays import Words, mix, pieces, row_slices, signed, window_hashes
from lakestead.llm.common import written


@dataclass(frozen=True)
class Near:
    shingle: int = 5
    percent: int = 80
    bands: int = 28
    rows: int = 5
    #: Links whose estimate is this many standard errors below the threshold are still verified.
    slack: float = 6.0
    block: int = 512
    spread: int = 16
    seed: int = 7

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.default_rng(self.seed)
        n = self.bands * self.rows
        return (
            (draw.integers(0, 1 << 31, n) * 2 + 1).astype(np.uint32),
            draw.integers(0, 1 << 32, n).astype(np.uint32),
        )

    def least_agreeing(self) -> int:
        """Equal minima that a pair at the threshold has at least, but for chance."""
        n, p = self.bands * self.rows, self.percent / 100
        return max(0, int(n * p - self.slack * (n * p * (1 - p)) ** 0.5))


def shingle_sets(texts: pa.Array, near: Near) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    found = Words(texts, fold=True)
    windows = window_hashes(found.hashes, near.shingle)
    out = []
    for a, b in zip(found.first[:-1], found.first[1:], strict=True):
        n = int(b - a)
        if n >= near.shingle:
            out.append(np.unique(windows[a : b - near.shingle + 1]))
        else:
            out.append(window_hashes(found.hashes[a:b], n) + np.uint64(n) if n else np.zeros(0, np.uint64))
    return out


def minima(sets: list[np.ndarray], near: Near) -> np.ndarray:
    """One row of universal hash minima per set; sets must not be empty."""
    a, b = near.hashes()
    out = np.empty((len(sets), len(a)), np.uint32)
    for part in row_slices(np.array([len(s) for s in sets]), 1 << 16):
        some = sets[part]
        x = (np.concatenate(some) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in some[:-1]])
        scratch = np.empty_like(x)
        for j in range(len(a)):
            np.multiply(x, a[j], out=scratch)
            np.add(scratch, b[j], out=scratch)
            out[part, j] = np.minimum.reduceat(scratch, starts)
    return out


def band_keys(signatures: np.ndarray, near: Near) -> np.ndarray:
    keys = np.zeros((len(signatures), near.bands), np.uint64)
    parts = signatures.reshape(len(signatures), near.bands, near.rows).astype(np.uint64)
    for r in range(near.rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return mix(keys + np.arange(near.bands, dtype=np.uint64))


def features(docs: DataFrame, id_col: str, text: str, near: Near) -> DataFrame:
    """(id, n, d1, d2, keys): set size, 128-bit digest of the set, band keys; keys is empty for an empty set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingle_sets(batch.column(1), near)
            full = [s for s in sets if len(s)]
            keys = band_keys(minima(full, near), near) if full else np.zeros((0, near.bands), np.uint64)
            lengths = np.array([near.bands if len(s) else 0 for s in sets], np.int32)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            digest = [[int(mix(s ^ np.uint64(salt)).sum()) if len(s) else 0 for s in sets] for salt in (1, 1 << 40)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *[pa.array(signed(np.array(d, np.uint64)), pa.int64()) for d in digest],
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(keys.ravel()), pa.int64())),
                ],
                names=["id", "n", "d1", "d2", "keys"],
            )

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    return slim.mapInArrow(work, "id long, n long, d1 long, d2 long, keys array<long>")


def _sets(docs: DataFrame, near: Near) -> DataFrame:
    """(id, sig, hi, lo) of docs(id, text): signature, and upper and lower halves of the sorted set, as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingle_sets(batch.column(1), near)
            rows = [i for i, s in enumerate(sets) if len(s)]
            if not rows:
                continue
            some = [sets[i] for i in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array([s.tobytes() for s in minima(some, near)], pa.binary()),
                    pa.array([(s >> np.uint64(32)).astype(np.uint32).tobytes() for s in some], pa.binary()),
                    pa.array([s.astype(np.uint32).tobytes() for s in some], pa.binary()),
                ],
                names=["id", "sig", "hi", "lo"],
            )

    return docs.mapInArrow(work, "id long, sig binary, hi binary, lo binary")


def _whole(hi: bytes, lo: bytes) -> np.ndarray:
    return (np.frombuffer(hi, np.uint32).astype(np.uint64) << np.uint64(32)) | np.frombuffer(lo, np.uint32)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many minima of signatures agree, row by row."""
    return (a == b).sum(axis=-1)


def signatures(column: pa.Array, near: Near) -> np.ndarray:
    """A binary column of signatures as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, near.bands * near.rows)


def verify(pairs: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, b) that are links: first by signature, then on the full sets."""
    least = near.least_agreeing()

    def by_signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = agreeing(signatures(batch.column("sig_a"), near), signatures(batch.column("sig_b"), near))
            yield batch.select(["a", "b"]).take(pa.array(np.flatnonzero(same >= least)))

    def by_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            keep = [
                i
                for i in range(batch.num_rows)
                if _linked(*(_whole(cols[f"hi_{c}"][i], cols[f"lo_{c}"][i]) for c in "ab"), near.percent)
            ]
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    def joined(pairs: DataFrame, *columns: str) -> DataFrame:
        for c in "ab":
            side = sets.select(F.col("id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in columns])
            pairs = pairs.join(side, c)
        return pairs

    alike = written(joined(pairs, "sig").mapInArrow(by_signature, "a long, b long"), "alike")
    return joined(alike, "hi", "lo").mapInArrow(by_set, "a long, b long")


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether no u of (u, v) has two neighbours v, and none is a v itself."""
    zero, one = F.lit(0), F.lit(1)
    ends = edges.select(F.col("u").alias("x"), one.alias("below"), zero.alias("above")).union(
        edges.select("v", zero, one)
    )
    nodes = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return nodes.filter("below > 1 or (below = 1 and above = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in edges (a, b); component is the smallest id that is reached.

    Alternating large-star and small-star; every round is written, so it survives lost executors. It ends when
    every node either is a root or has one root as its only neighbour.
    """
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = written(ordered.distinct(), "edges")
    while not _is_star_forest(current):
        # Large-star: every larger neighbour of a node is linked to the least of node and neighbours.
        both = current.union(current.select("v", "u")).toDF("u", "v")
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large_star")
        # Small-star: the smaller neighbours of a node, and itself, are linked to the least of them.
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        down = large.join(least, "u")
        small = down.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small_star")
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def _block_links(units: DataFrame, near: Near) -> DataFrame:
    """Links (a, b) that join components, from units (kind, key, i, j, id, blk, comp, sig, hi, lo).

    Each group is block i against block j of one bucket or token. Pairs whose signatures are alike are verified on their sets. Members
    whose components a link of the group has joined are not compared any more, so a group gives fewer links than it
    has members.
    """
    least = near.least_agreeing()

    def work(group: pd.DataFrame) -> pd.DataFrame:
        comp, root = np.unique(group["comp"].to_numpy(), return_inverse=True)
        ids, blk = group["id"].to_numpy(), group["blk"].to_numpy()
        sigs = np.frombuffer(b"".join(group["sig"]), np.uint32).reshape(len(group), -1)
        sets = [_whole(hi, lo) for hi, lo in zip(group["hi"], group["lo"], strict=True)]
        sizes = np.array([len(s) for s in sets])
        same_block = group["i"].iloc[0] == group["j"].iloc[0]
        links = []
        for r in range(len(group) - 1):
            later = np.arange(r + 1, len(group))
            wanted = root[later] != root[r]
            if not same_block:
                wanted &= blk[later] != blk[r]
            wanted &= 100 * np.minimum(sizes[later], sizes[r]) >= near.percent * np.maximum(sizes[later], sizes[r])
            later = later[wanted]
            same = agreeing(sigs[later], sigs[r])
            later, same = later[same >= least], same[same >= least]
            for o in later[np.argsort(-same, kind="stable")].tolist():
                if root[o] != root[r] and _linked(sets[o], sets[r], near.percent):
                    links.append(sorted((ids[o], ids[r])))
                    root[root == root[o]] = root[r]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return units.groupBy("kind", "key", "i", "j").applyInPandas(work, "a long, b long")


#: Shingles are counted by this many bits of their hash to tell rare ones from frequent ones.
RARITY_BITS = 18


def _rarity(members: DataFrame) -> np.ndarray:
    """How many members have a shingle of each of 2^18 classes of hashes; 1 MB."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            for hi in batch.column("hi"):
                part = np.frombuffer(hi.as_buffer(), np.uint32) >> np.uint32(32 - RARITY_BITS)
                counts += np.bincount(part, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["part", "n"])

    found = members.select("hi").mapInArrow(work, "part long, n long").groupBy("part").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << RARITY_BITS, np.int64)
    counts[found["part"].to_numpy()] = found["n"].to_numpy()
    return np.minimum(counts, np.iinfo(np.int32).max).astype(np.int32)


def prefix(tokens: np.ndarray, rarity: np.ndarray, percent: int) -> np.ndarray:
    """The rarest tokens of a set, so many that any linked set has one of them among its own.

    A linked set shares at least ``percent`` of the tokens. All sets are put in the same order: by the rarity
    of a token, then by the token.
    """
    n = len(tokens)
    keep = n - -(-n * percent // 100) + 1
    order = np.lexsort((tokens, rarity[tokens >> np.uint32(32 - RARITY_BITS)]))
    return tokens[order[:keep]]


def _prefixes(members: DataFrame, near: Near) -> DataFrame:
    """(key, id, comp) of members(id, comp, hi). Keys are tokens, 32 bits of a shingle's hash."""
    rarity = members.sparkSession.sparkContext.broadcast(_rarity(members))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One per cent of leeway for shingles that share their 32 bits.
            found = [
                prefix(np.unique(np.frombuffer(hi.as_buffer(), np.uint32)), rarity.value, near.percent - 1)
                for hi in batch.column("hi")
            ]
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            tokens = np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), *[batch.column(c).take(pa.array(row)) for c in ("id", "comp")]],
                names=["key", "id", "comp"],
            )

    return members.select("id", "comp", "hi").mapInArrow(work, "key long, id long, comp long")


def _classes(feats: DataFrame) -> DataFrame:
    """(d1, d2, n, rep): one row per different set; rep is its smallest id."""
    return (
        feats.filter("n > 0 and id is not null").groupBy("d1", "d2", "n").agg(F.min("id").alias("rep"))
    )


def _buckets(reps: DataFrame) -> DataFrame:
    """(key, id, size): the members of the band keys that two or more classes share."""
    banded = reps.select("id", F.explode("keys").alias("key"))
    shared = (
        banded.groupBy("key")
        .agg(F.count("*").alias("size"), F.min("id").alias("lo"), F.max("id").alias("hi"))
        .filter("lo < hi")
        .select("key", "size")
    )
    return banded.join(written(shared, "bucket_sizes"), "key")


def _star_pairs(buckets: DataFrame) -> DataFrame:
    """Every member with the leader of its bucket: the one that most others meet, over all its buckets."""
    met = buckets.groupBy("id").agg(F.sum("size").alias("met"))
    leaders = (
        buckets.join(met, "id")
        .groupBy("key")
        .agg(F.max(F.struct("met", (-F.col("id")).alias("id"))).alias("top"))
        .select("key", (-F.col("top.id")).alias("leader"))
    )
    pairs = buckets.join(written(leaders, "leaders"), "key").filter("id <> leader")
    return pairs.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()


def _groups(members: DataFrame, near: Near) -> DataFrame:
    """(key, blocks) of the groups of members(key, id, comp) with several components; of groups with the same members one."""
    return (
        members.groupBy("key")
        .agg(
            F.min("comp").alias("lo"),
            F.max("comp").alias("hi"),
            F.count("*").alias("m"),
            F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s1"),
            F.sum(F.xxhash64(F.lit(1), "id").cast("decimal(38,0)")).alias("s2"),
        )
        .filter("lo < hi")
        .groupBy("m", "s1", "s2")
        .agg(F.min("key").alias("key"))
        .select("key", "m", F.ceil(F.col("m") / near.block).cast("int").alias("blocks"))
    )


def _dealt(members: DataFrame, kind: int) -> DataFrame:
    """(kind, key, i, j, id, blk, comp) of members(key, blocks, id, comp): each once per pair of blocks it is in."""
    blk = F.pmod(F.xxhash64(F.lit(2), "id"), F.col("blocks").cast("long")).cast("int")
    placed = members.withColumn("blk", blk)
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.lit(kind).alias("kind"), "key", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"),
        "id", "blk", "comp",
    )


def open_units(buckets: DataFrame, labels: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """What is compared in buckets with several components: (kind, key, i, j, id, blk, comp, sig, hi, lo).

    In a bucket of two the leader has met the other one.
    """
    labelled = buckets.join(labels, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("comp")
    )
    lists = written(_groups(labelled, near).filter("m > 2").drop("m"), "open_buckets")
    large = F.col("blocks") > near.spread
    units = _dealt(labelled.join(lists.filter(~large), "key"), 0)
    if not lists.filter(large).isEmpty():
        members = labelled.join(lists.filter(large).select("key"), "key").select("id", "comp").distinct()
        whole = written(members.join(sets.select("id", "hi"), "id"), "open_members")
        tokens = written(_prefixes(whole, near), "prefixes")
        shared = written(_groups(tokens, near).drop("m"), "shared_tokens")
        units = units.unionByName(_dealt(tokens.join(shared, "key"), 1))
    return units.join(sets, "id")


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    near: Near = Near(),  # noqa: B008
) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, kept."""
    feats = written(features(docs, id_col, text, near), "features")
    classes = written(_classes(feats), "classes")
    reps = written(
        feats.join(classes, ["d1", "d2", "n"]).filter("id = rep").select("id", "keys"), "representatives"
    )
    buckets = written(_buckets(reps), "buckets")
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    wanted = buckets.select("id").distinct().hint("merge")
    sets = written(_sets(slim.join(wanted, "id", "left_semi"), near), "sets")
    links = written(verify(_star_pairs(buckets), sets, near), "links")
    labels = written(components(links), "labels")
    more = written(_block_links(open_units(buckets, labels, sets, near), near), "more_links")
    if not more.isEmpty():
        labels = written(_merged(labels, more), "merged_labels")
    member = feats.filter("n > 0 and id is not null").join(classes, ["d1", "d2", "n"]).select("id", "n", "rep")
    found = member.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "id", "n", F.coalesce("component", "rep").alias("component_id")
    )
    alone = feats.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    return found.union(alone).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """The labels after more links: components of the components, which are few."""
    both = more
    for end in ("a", "b"):
        named = labels.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
        both = both.join(named, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    joined = written(components(both.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))), "merges")
    joined = joined.select(F.col("id").alias("old"), F.col("component").alias("new"))
    known = labels.join(joined, F.col("component") == F.col("old"), "left").select(
        "id", F.coalesce("new", "component").alias("component")
    )
    # Documents that had no link before are components of their own.
    fresh = joined.join(labels, F.col("old") == F.col("id"), "left_anti")
    return known.union(fresh.select(F.col("old").alias("id"), F.col("new").alias("component")))


ORACLE_SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(
           CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, b.y FROM reached r JOIN both_ways b ON r.y = b.x),
least AS (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
