"""Mixing sources to target weights: budgets down a tree of domain, language and source.

A token budget is handed down level by level in proportion to integer weights. A node never gets more
than its documents can give in ``max_epochs`` passes; what a node cannot take goes to its siblings by
their weights, and only what the whole family cannot take is left to the siblings of their parent. At
each level this is water filling over one row per node: sorted by tokens per weight, the short nodes
are a prefix that two running sums find.

A leaf's budget is used up in epochs. Whole epochs take every document. The last one takes the longest
prefix that fits, in an order seeded by seed, epoch and id (MD5, so ties are repeated
rows, which go in or stay out together). The place where the prefix ends is found by three rounds of
token sums per leaf and two hexadecimal digits of the key, then a running sum inside one bucket of
1/16,777,216 of the key space: no leaf, however large, is sorted in one task.

Only DataFrame functions are used; the result is exact integer arithmetic. The documents themselves
meet only the table of leaves (one row per leaf). If that is too large to broadcast, the join has an
exchange on both sides and adaptive planning can split a hot leaf.

Defined cases: null values of a level are a node of their own. Texts without words have no tokens; they
come with every whole epoch, and with the last one up to where the prefix ends. Without documents the
result is empty. Nodes of weight 0 get nothing. Extra columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestead.llm.common import private, words, written

ROUNDS = 3


@dataclass(frozen=True)
class Mix:
    #: Per level: value -> weight. Values that are not named weigh 1.
    weights: tuple[dict[str, int], ...] = field(default=({}, {}, {}))
    #: The budget as a share of all tokens.
    percent: int = 60
    max_epochs: int = 2
    seed: str = "mix"


def _weight(node: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(F.col(node) == f"1{name}", F.lit(w)).otherwise(out)
    return out.cast("long")


def _wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def water_fill(nodes: DataFrame, family: list[str], node: str) -> DataFrame:
    """Adds budget to nodes: family columns, node, available, weight, family_budget; one row per node."""
    w = Window.partitionBy(*family) if family else Window.partitionBy(F.lit(0))
    ordered = w.orderBy("ratio", node)
    left_over = F.col("family_budget") - F.coalesce("before", F.lit(0))
    short = _wide(F.col("available")) * _wide(F.col("weights_left")) <= _wide(left_over) * _wide(F.col("weight"))
    share = "((cast(family_budget - taken as decimal(19,0)) * cast(weight as decimal(19,0))) div weight_rest)"
    return (
        nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("available") / F.col("weight")).otherwise(0.0))
        .withColumn("before", F.sum("available").over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("weights_left", F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("short", short)
        .withColumn("taken", F.sum(F.when(F.col("short"), F.col("available")).otherwise(0)).over(w))
        .withColumn("weight_rest", F.sum(F.when(F.col("short"), 0).otherwise(F.col("weight"))).over(w))
        .withColumn("budget", F.expr(f"CASE WHEN short THEN available WHEN weight_rest > 0 THEN {share} ELSE 0 END").cast("long"))
        .drop("ratio", "before", "weights_left", "short", "taken", "weight_rest")
    )


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """leaves (nodes, tokens) with budget added; budgets are rounded down."""
    nodes = leaves.columns[:-1]
    live = F.lit(True)
    for node, weights in zip(nodes, mix.weights, strict=True):
        live = live & (_weight(node, weights) > 0)
    available = F.when(live, F.col("tokens") * mix.max_epochs).otherwise(0).cast("long")
    leaves = leaves.withColumn("available", available)
    total = leaves.agg(F.expr(f"cast(coalesce(sum(tokens) * {int(mix.percent)} div 100, 0) as bigint)")).scalar()
    above = None
    for depth, (node, weights) in enumerate(zip(nodes, mix.weights, strict=True)):
        family = nodes[:depth]
        level = leaves.groupBy(*nodes[: depth + 1]).agg(F.sum("available").alias("available"))
        if above is None:
            level = level.withColumn("family_budget", total)
        else:
            level = level.join(above.select(*family, F.col("budget").alias("family_budget")), family)
        above = water_fill(level.withColumn("weight", _weight(node, weights)), family, node)
    return leaves.join(above.select(*nodes, "budget"), nodes).select(*nodes, "tokens", "budget")


def _order_key(seed: str, epoch: Column, row_id: Column) -> Column:
    row_id = F.coalesce(row_id.cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), row_id))


def _prefix_ends(rows: DataFrame, quotas: DataFrame, nodes: list[str], seed: str) -> DataFrame:
    """(nodes, cut): in the last epoch the documents with a key up to cut are taken."""
    keyed = rows.join(quotas.filter("rest > 0"), nodes).withColumn(
        "key", _order_key(seed, F.col("whole"), F.col("id"))
    )
    # A bucket of keys per leaf in which the prefix ends, narrowed by two digits a round.
    ends = quotas.filter("rest > 0").select(*nodes, F.lit("").alias("prefix"), F.col("rest").alias("room"))
    in_order = Window.partitionBy(*nodes).orderBy("bucket")
    for digits in range(2, 2 * ROUNDS + 2, 2):
        inside = keyed.withColumn("prefix", F.substring("key", 1, digits - 2)).join(ends, [*nodes, "prefix"])
        sums = inside.groupBy(*nodes, "room", F.substring("key", 1, digits).alias("bucket")).agg(
            F.sum("n").alias("n")
        )
        upto = sums.withColumn("upto", F.sum("n").over(in_order))
        first = F.min(F.struct(F.col("bucket").alias("prefix"), (F.col("room") - F.col("upto") + F.col("n")).alias("room")))
        ends = (
            upto.filter("upto > room").groupBy(*nodes).agg(first.alias("e")).select(*nodes, "e.prefix", "e.room")
        )
        ends = written(ends, "prefix_ends")
    inside = keyed.withColumn("prefix", F.substring("key", 1, 2 * ROUNDS)).join(ends, [*nodes, "prefix"])
    upto = inside.withColumn("upto", F.sum("n").over(Window.partitionBy(*nodes, "prefix").orderBy("key")))
    last = upto.filter("upto <= room").groupBy(*nodes).agg(F.max("key").alias("last"))
    # Without a last key in the bucket the prefix of the bucket itself sorts before all of it.
    return ends.join(last, nodes, "left").select(*nodes, F.coalesce("last", "prefix").alias("cut"))


def mix_sources(
    docs: DataFrame,
    levels: dict[str, Column],
    mix: Mix,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """docs, each row as often as it is taken, with epoch and n_tokens added.

    levels: name -> value of a document at that level of the tree, from the root down.
    """
    tokens, whole, cut, epoch = private(docs, "n", "whole", "cut", "epoch_no")
    names = private(docs, *[f"node{i}" for i in range(len(levels))])
    sized = docs
    for name, value in zip(names, levels.values(), strict=True):
        value = value.cast("string")
        sized = sized.withColumn(name, F.when(value.isNull(), "0").otherwise(F.concat(F.lit("1"), value)))
    sized = sized.withColumn(tokens, F.size(words(F.col(text))).cast("long"))
    inner = [f"l{i}" for i in range(len(levels))]
    rows = written(
        sized.select(
            F.col(id_col).alias("id"),
            *[F.col(n).alias(i) for n, i in zip(names, inner, strict=True)],
            F.col(tokens).alias("n"),
        ),
        "token_counts",
    )
    leaves = written(rows.groupBy(*inner).agg(F.sum("n").alias("tokens")), "leaves")
    per_epoch = F.greatest(F.col("tokens"), F.lit(1))
    quotas = written(
        leaf_budgets(leaves, mix).select(
            *inner,
            F.expr("budget div greatest(tokens, 1)").alias("whole"),
            (F.col("budget") % per_epoch).alias("rest"),
        ),
        "quotas",
    )
    cuts = quotas.join(_prefix_ends(rows, quotas, inner, mix.seed), inner, "left")
    cuts = written(cuts.select(*inner, "whole", F.coalesce("cut", F.lit("")).alias("cut")), "cuts")
    plan = cuts.select(
        *[F.col(i).alias(n) for n, i in zip(names, inner, strict=True)],
        F.col("whole").alias(whole),
        F.col("cut").alias(cut),
    )
    times = F.col(whole) + (_order_key(mix.seed, F.col(whole), F.col(id_col)) <= F.col(cut)).cast("long")
    taken = (
        sized.join(plan, names)
        .withColumn(epoch, F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("long"), times - 1))))
    )
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("epoch", "n_tokens")]
    return taken.select(*keep, F.col(epoch).cast("int").alias("epoch"), F.col(tokens).alias("n_tokens"))


def oracle_sql(mix: Mix, domain_sql: str) -> str:
    """The same selection in DuckDB SQL, for documents(doc_id, text, lang, source)."""

    def weight(column: str, weights: dict[str, int]) -> str:
        named = "".join(f" WHEN {column} = '{k}' THEN {v}" for k, v in weights.items())
        return f"CASE{named} ELSE 1 END" if named else "1"

    def level(name: str, family: str, column: str, weights: dict[str, int], source: str, budget: str) -> str:
        by = f"PARTITION BY {family}" if family else ""
        keys = f"{family}, {column}" if family else column
        return f"""
{name}_in AS ({source}),
{name}_run AS (
  SELECT *, coalesce(sum(a) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM (SELECT {keys}, a, {weight(column, weights)}::HUGEINT AS w, {budget} AS b FROM {name}_in)
  WINDOW o AS ({by} ORDER BY a::DOUBLE / w, {column})),
{name}_short AS (SELECT *, a * w_left <= (b - before) * w AS short FROM {name}_run),
{name} AS (
  SELECT {keys}, CASE WHEN short THEN a
         ELSE (b - sum(CASE WHEN short THEN a ELSE 0 END) OVER f) * w // sum(CASE WHEN short THEN 0 ELSE w END) OVER f
         END AS budget
  FROM {name}_short WINDOW f AS ({by}))"""

    domain, lang, source = mix.weights
    return f"""
WITH t AS (
  SELECT doc_id, {domain_sql} AS domain, lang, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
  FROM documents),
leaf AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {mix.max_epochs} AS a
  FROM t GROUP BY ALL),
total AS (SELECT sum(tokens) * {mix.percent} // 100 AS b FROM leaf),
{level("d", "", "domain", domain, "SELECT domain, sum(a) AS a FROM leaf GROUP BY ALL", "(SELECT b FROM total)")},
{level("l", "domain", "lang", lang,
       "SELECT domain, lang, sum(leaf.a) AS a, any_value(budget) AS pb FROM leaf JOIN d USING (domain) GROUP BY ALL", "pb")},
{level("s", "domain, lang", "source", source,
       "SELECT domain, lang, source, leaf.a AS a, budget AS pb FROM leaf JOIN l USING (domain, lang)", "pb")},
quota AS (
  SELECT domain, lang, source, (budget // greatest(tokens, 1))::BIGINT AS whole, budget % greatest(tokens, 1) AS rest
  FROM s JOIN leaf USING (domain, lang, source)),
ordered AS (
  SELECT t.*, whole, rest,
         sum(n_tokens) OVER (PARTITION BY domain, lang, source
                             ORDER BY md5('{mix.seed}|' || whole || '|' || doc_id)) AS upto
  FROM t JOIN quota USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens,
       unnest(range(whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END))::INTEGER AS epoch
FROM ordered
"""
