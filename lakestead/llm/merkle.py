"""Merkle dataset manifest: a tree of digests per group, its proofs, and their check.

Every row is a leaf: the SHA-256 of its fields, each with its length in front. The leaves of a group stand in
the order of their ids, ``fanout`` consecutive nodes have one parent, and the roots of the groups are the
leaves of a tree of their own.

Levels are built by a slot pivot: the children of a parent are spread into one column per slot by conditional
aggregates; the concatenated columns hash to the parent, and the same without the own slot are the siblings
of a row. Aggregates over a window keep the rows, so every row ends up with its path. A round climbs
``levels`` levels inside blocks of ``fanout ** levels`` neighbours, all on one exchange by (group,
block); its block roots are the next round's leaves. A window holds one block at most, however large
a group is. Paths come down by joining a round's rows with their block's path.

Positions come from a range exchange by (group, id): rows are sorted inside a partition and shifted by the
counts of the partitions before, one small row per partition and group. Rows of a hot group, and
copies of one id, are spread over partitions.

Leaves, positions and every round are written, so a lost executor repeats one step. Nothing is collected
but a group's greatest size.

Defined cases: a null field is ``-``, an empty one ``0:``. A null group is a group and comes first, a null id
comes first in its group; rows equal in group and id follow each other by their digest, and equal
rows are leaves of their own. A run of one node is hashed like a longer one; a group of one row has its leaf as
root; a tree of one row has an empty path. No rows give no rows. Columns that are not named are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestead.llm.common import written

DIGEST = 32  # bytes of a digest


@dataclass(frozen=True)
class Tree:
    fanout: int = 2
    #: Levels per round; a window holds fanout ** levels rows.
    levels: int = 8


def sha(hex_text: Column) -> Column:
    """The digest of a text as 32 bytes."""
    return F.unhex(F.sha2(hex_text, 256))


def as_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: each field as its count of UTF-8 bytes, a colon and its text; null as a dash."""
    texts = [c.cast("string") for c in fields]
    marked = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return sha(F.concat(*[F.coalesce(m, F.lit("-")) for m in marked]))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """rows (grp, id, node and more) with pos, their place in the group, and n, the size of the group."""
    kept = written(rows.withColumn("row", F.monotonically_increasing_id()), f"{name}_leaves")
    order = ["grp", "id", "node", "row"]  # the last spreads copies of a row
    ranged = kept.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.drop("row").withColumn("at", F.monotonically_increasing_id()), f"{name}_sorted")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("grp", "part").agg(F.count("*").alias("size"), F.min("at").alias("first"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("grp").alias("in_grp"),
        F.col("part").alias("in_part"),
        (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("size").over(group).alias("n"),
    )
    same = F.col("grp").eqNullSafe(F.col("in_grp")) & (F.col("part") == F.col("in_part"))
    joined = placed.join(parts, same).withColumn("pos", F.col("at") + F.col("shift"))
    return joined.drop("at", "part", "in_grp", "in_part", "shift")


def climb(nodes: DataFrame, tree: Tree) -> DataFrame:
    """(grp, pos, n, node) with the path to the block's root, and that root: up, up_pos and up_n."""
    f = tree.fanout
    block = F.expr(f"pos div {f**tree.levels}")
    nothing = F.unhex(F.lit(""))
    rows = nodes.select("grp", "pos", "n", "node", block.alias("block")).repartition("grp", "block")
    rows = rows.withColumns(
        {"up": F.col("node"), "up_pos": F.col("pos"), "up_n": F.col("n"), "path": nothing}
    )
    for _ in range(tree.levels):
        rows = rows.withColumn("parent", F.expr(f"up_pos div {f}"))
        run = Window.partitionBy("grp", "block", "parent")
        slot = F.col("up_pos") % f
        slots = [f"slot{j}" for j in range(f)]
        rows = rows.withColumns(
            {s: F.max(F.when(slot == j, F.col("up"))).over(run) for j, s in enumerate(slots)}
        )
        children = F.concat(*[F.coalesce(s, nothing) for s in slots])
        others = F.concat(*[F.when((slot != j) & F.col(s).isNotNull(), F.col(s)).otherwise(nothing)
                            for j, s in enumerate(slots)])
        many = F.col("up_n") > 1
        rows = rows.select(
            "grp", "pos", "n", "node", "block",
            F.when(many, sha(as_text(children))).otherwise(F.col("up")).alias("up"),
            F.when(many, F.col("parent")).otherwise(F.col("up_pos")).alias("up_pos"),
            F.when(many, F.expr(f"(up_n + {f - 1}) div {f}")).otherwise(F.col("up_n")).alias("up_n"),
            F.when(many, F.concat("path", others)).otherwise(F.col("path")).alias("path"),
        )
    return rows.drop("block")


def paths(nodes: DataFrame, tree: Tree, name: str) -> DataFrame:
    """(grp, pos, path, root) of every leaf (grp, pos, n, node)."""
    rounds, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while not rounds or most > 1:
        rounds.append(written(climb(nodes, tree), f"{name}_round{len(rounds)}"))
        most = -(-most // tree.fanout**tree.levels)
        nodes = rounds[-1].groupBy("grp", F.col("up_pos").alias("pos")).agg(
            F.first("up_n").alias("n"), F.first("up").alias("node")
        )
    down = rounds.pop().select("grp", "pos", "path", F.col("up").alias("root"))
    while rounds:
        own = rounds.pop().select("grp", "pos", "up_pos", F.col("path").alias("own"))
        above = down.select(
            F.col("grp").alias("in_grp"), F.col("pos").alias("in_pos"), F.col("path").alias("above"), "root"
        )
        same = F.col("grp").eqNullSafe(F.col("in_grp")) & (F.col("up_pos") == F.col("in_pos"))
        down = own.join(above, same).select("grp", "pos", F.concat("own", "above").alias("path"), "root")
    return down


def manifest(
    docs: DataFrame,
    fields: list[str],
    id_col: str = "doc_id",
    group: str = "lang",
    tampered: dict[str, Column] | None = None,
    tree: Tree = Tree(),
) -> DataFrame:
    """One row per row: id, group, leaf, place and size in both trees, path, subroot and root.

    ``tampered`` gives other values for some fields; ``claimed`` is the leaf with them, null where they are
    all as before. Digests and paths are binary.
    """
    col = lambda c: F.col(f"`{c}`")
    claimed = F.lit(None).cast("binary")
    if tampered:
        now = [tampered.get(c, col(c)) for c in fields]
        differs = ~F.lit(True)
        for c, value in tampered.items():
            differs = differs | ~value.eqNullSafe(col(c))
        claimed = F.when(differs, leaf(now))
    rows = docs.select(
        col(group).alias("grp"), col(id_col).alias("id"), leaf([col(c) for c in fields]).alias("node"),
        claimed.alias("claimed"),
    )
    leaves = written(numbered(rows, "merkle"), "merkle_numbered")
    # One path per place; places are unique in a group.
    below = paths(leaves.select("grp", "pos", "n", "node"), tree, "merkle")
    own = written(_with_paths(leaves, below), "merkle_paths")
    subroots = own.groupBy("grp").agg(F.first("root").alias("node"))
    top = subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("id"), "node")
    groups = written(numbered(top, "merkle_top"), "merkle_top_numbered")
    above = paths(groups.select("grp", "pos", "n", "node"), tree, "merkle_top")
    upper = written(_with_paths(groups, above), "merkle_top_paths").select(
        F.col("id").alias("in_grp"),
        F.col("pos").alias("top_pos"),
        F.col("n").alias("top_n"),
        F.col("path").alias("top_path"),
        F.col("root").alias("top_root"),
    )
    return own.join(upper, F.col("grp").eqNullSafe(F.col("in_grp"))).select(
        F.col("id").alias(id_col), F.col("grp").alias(group), F.col("node").alias("leaf"), "claimed",
        "pos", "n", "top_pos", "top_n", F.concat("path", "top_path").alias("path"),
        F.col("root").alias("subroot"), F.col("top_root").alias("root"),
    )


def _with_paths(leaves: DataFrame, found: DataFrame) -> DataFrame:
    found = found.select(F.col("grp").alias("of_grp"), F.col("pos").alias("of_pos"), "path", "root")
    same = F.col("grp").eqNullSafe(F.col("of_grp")) & (F.col("pos") == F.col("of_pos"))
    return leaves.join(found, same).drop("of_grp", "of_pos")


def folded(start: Column, tree: Tree = Tree()) -> Column:
    """The root that a leaf leads to along the columns path, pos, n, top_pos and top_n of a manifest."""
    f = tree.fanout

    def state(node, at, pos, n) -> Column:
        return F.struct(node.alias("node"), at.alias("at"), pos.alias("pos"), n.alias("n"))

    def step(s: Column, _: Column) -> Column:
        slot = s["pos"] % f
        size = F.least(F.lit(f).cast("long"), s["n"] - s["pos"] + slot)
        left, right = slot * DIGEST, (size - 1 - slot) * DIGEST
        take = lambda start, length: F.substring(F.col("path"), start.cast("int"), length.cast("int"))
        run = F.concat(take(s["at"], left), s["node"], take(s["at"] + left, right))
        return state(
            sha(as_text(run)), s["at"] + left + right,
            F.floor((s["pos"] - slot) / f).cast("long"), F.ceil(s["n"] / f).cast("long"),
        )

    def height(n: Column) -> Column:
        """Levels above n nodes; below 2 ** 53 of them."""
        powers, p = [], 1
        while p < 1 << 53:
            powers.append(F.when(n > p, 1).otherwise(0))
            p *= f
        total = powers[0]
        for one in powers[1:]:
            total = total + one
        return total

    def climb_along(node: Column, at: Column, pos: Column, n: Column) -> Column:
        levels = F.when(n > 1, F.sequence(F.lit(1), height(n))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(levels, state(node, at, pos, n), step)

    whole = [c.cast("long") for c in (F.col("pos"), F.col("n"), F.col("top_pos"), F.col("top_n"))]
    lower = climb_along(start, F.lit(1).cast("long"), whole[0], whole[1])
    bound = F.transform(F.array(lower), lambda s: climb_along(s["node"], s["at"], whole[2], whole[3])["node"])
    return bound[0]


_SQL_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"


def _sql_leaf(n_chars: str) -> str:
    names = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    return f"sha256({' || '.join(_SQL_FIELD.format(n) for n in names)})"


def _sql_climb(name: str, leaves: str) -> str:
    """Tables of a two-fold tree over leaves (grp, pos, node): <name> (grp, lvl, pos, n, node)."""
    return f"""
{name}_lists AS (
  SELECT grp, 0 AS lvl, list(node ORDER BY pos) AS nodes FROM {leaves} GROUP BY grp
  UNION ALL
  SELECT grp, lvl + 1, list_transform(range(0, len(nodes), 2),
                                      lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM {name}_lists WHERE len(nodes) > 1),
{name} AS (
  SELECT grp, lvl, len(nodes) AS n, unnest(range(len(nodes))) AS pos, unnest(nodes) AS node FROM {name}_lists)"""


def _sql_fold(name: str, tree: str, start: str) -> str:
    """Each row of start (rid, grp, pos, node, proof) carried up the tree."""
    return f"""
{name} AS (
  SELECT rid, grp, 0 AS lvl, pos, node, proof FROM {start}
  UNION ALL
  SELECT f.rid, f.grp, f.lvl + 1, f.pos // 2,
         CASE WHEN f.pos % 2 = 0 THEN sha256(f.node || coalesce(s.node, '')) ELSE sha256(s.node || f.node) END,
         f.proof || coalesce(s.node, '')
  FROM {name} f
  JOIN {tree} own ON own.grp = f.grp AND own.lvl = f.lvl AND own.pos = f.pos
  LEFT JOIN {tree} s ON s.grp = f.grp AND s.lvl = f.lvl AND s.pos = xor(f.pos, 1)
  WHERE own.n > 1)"""


ORACLE_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
rows_in AS (
  SELECT *, row_number() OVER () AS rid, CAST(doc_id AS VARCHAR) AS digits FROM documents),
marked AS (
  SELECT rows_in.*, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, len(digits) + 1),
                                            lambda i: CAST(ascii(substr(digits, i, 1)) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 7 = 0 AS hit
  FROM rows_in, crc),
leaves AS (
  SELECT rid, doc_id, coalesce('=' || lang, '') AS grp, {_sql_leaf("n_chars")} AS leaf,
         {_sql_leaf("CASE WHEN hit THEN n_chars + 1 ELSE n_chars END")} AS claimed
  FROM marked),
ranked AS (
  SELECT *, leaf AS node, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves),
{_sql_climb("tree", "ranked")},
subroots AS (SELECT grp AS lang, node AS subroot FROM tree WHERE n = 1),
ordered AS (SELECT 0 AS grp, lang, subroot AS node, row_number() OVER (ORDER BY lang) - 1 AS pos FROM subroots),
{_sql_climb("top", "ordered")},
start AS (SELECT rid, grp, pos, leaf AS node, '' AS proof FROM ranked),
bent AS (SELECT rid, grp, pos, claimed AS node, '' AS proof FROM ranked),
{_sql_fold("up", "tree", "start")},
{_sql_fold("bent_up", "tree", "bent")},
start2 AS (
  SELECT u.rid, 0 AS grp, o.pos, u.node, u.proof FROM up u
  JOIN tree t ON t.grp = u.grp AND t.lvl = u.lvl AND t.n = 1 JOIN ordered o ON o.lang = u.grp),
bent2 AS (
  SELECT u.rid, 0 AS grp, o.pos, u.node, u.proof FROM bent_up u
  JOIN tree t ON t.grp = u.grp AND t.lvl = u.lvl AND t.n = 1 JOIN ordered o ON o.lang = u.grp),
{_sql_fold("up2", "top", "start2")},
{_sql_fold("bent_up2", "top", "bent2")},
summit AS (SELECT lvl, node FROM top WHERE n = 1)
SELECT r.doc_id, r.leaf, s.subroot, summit.node AS root, sha256(u.proof) AS proof_sha256,
       b.node AS folded_root, b.node = summit.node AS verified
FROM ranked r
JOIN subroots s ON s.lang = r.grp
JOIN summit ON true
JOIN up2 u ON u.rid = r.rid AND u.lvl = summit.lvl
JOIN bent_up2 b ON b.rid = r.rid AND b.lvl = summit.lvl
"""
