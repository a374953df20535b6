"""Keys and references found in the data, where nothing declares them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StringType

#: Values longer than this are compared by their digest.
LONGEST = 64
#: Relative error of the sketches, and how far below the rows an estimate must be to rule a key out.
SKETCH_ERROR, SKETCH_MARGIN = 0.02, 0.1
#: Sketches that one pass makes.
AT_ONCE = 200
#: Into how many parts the values of a combination are dealt; repeats are looked for in one of them first.
PARTS = 64


# ---- references -----------------------------------------------------------------------------
def value_sets(tables: dict[str, DataFrame], columns: dict[str, list[str]], blank_as_null: bool = True) -> DataFrame:
    """(columns, repeated, n): how many values stand in exactly these columns, in these of them repeatedly.

    All columns are put below each other as (type, value, column) and counted, which combines repeats before the
    shuffle; then one row per value holds the few columns that have it, and equal sets are counted. The result
    has a row per set of columns that share a value, however many values there are.
    """
    numbered = {name: n for n, name in enumerate(f"{t}.{c}" for t in tables for c in columns[t])}

    def long(table: str) -> DataFrame:
        df = tables[table]
        entries = [
            F.struct(
                F.lit(numbered[f"{table}.{c}"]).alias("c"),
                F.lit(kind(df.schema[c].dataType)).alias("kind"),
                _value(df, c, blank_as_null).alias("v"),
            )
            for c in columns[table]
        ]
        return df.select(F.inline(F.array(*entries)))

    rows = reduce(DataFrame.unionByName, [long(t) for t in tables if columns[t]]).filter("v is not null")
    counted = rows.groupBy("kind", "v", "c").agg(F.count("*").alias("n"))
    held = counted.groupBy("kind", "v").agg(
        F.array_sort(F.collect_list(F.struct("c", (F.col("n") > 1).alias("repeated")))).alias("held")
    )
    sets = held.groupBy("held").agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(n) for n in numbered])
    named = F.transform("held", lambda h: F.struct(F.get(names, h["c"]).alias("column"), h["repeated"]))
    return sets.select(named.alias("held"), "n")


def _value(df: DataFrame, column: str, blank_as_null: bool) -> Column:
    text = F.col(f"`{column}`").cast("string")
    if blank_as_null and isinstance(df.schema[column].dataType, StringType):
        text = F.nullif(text, F.lit(""))
    return F.when(F.length(text) > LONGEST, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(text)


def kind(data_type: DataType) -> str:
    """Columns are compared within a kind of types."""
    name = data_type.typeName()
    return {"byte": "integer", "short": "integer", "long": "integer"}.get(name, name)


def worth_comparing(tables: dict[str, DataFrame], columns: dict[str, list[str]], percent: int) -> dict[str, list[str]]:
    """The columns that may be on either side of a reference, from one pass of sketches per table.

    A column can be referred to only by one of its kind that has, up to the error of the sketches, not more than its
    distinct values in the wanted part. Columns that can neither refer nor be referred to are left out.
    """
    sizes: dict[str, tuple[str, str, int]] = {}
    for table, df in tables.items():
        names = columns[table]
        row = df.agg(*[F.approx_count_distinct(f"`{c}`", SKETCH_ERROR).alias(f"n{i}") for i, c in enumerate(names)]).first()
        for i, c in enumerate(names):
            sizes[f"{table}.{c}"] = (table, kind(df.schema[c].dataType), row[i])

    def may_refer(a: str, b: str) -> bool:
        least = sizes[a][2] * (1 - SKETCH_MARGIN) * percent / 100
        return a != b and sizes[a][1] == sizes[b][1] and least <= sizes[b][2] * (1 + SKETCH_MARGIN)

    used = {c for a in sizes for b in sizes if may_refer(a, b) for c in (a, b)}
    return {t: [c for c in names if f"{t}.{c}" in used] for t, names in columns.items()}


def references(
    tables: dict[str, DataFrame],
    columns: dict[str, list[str]] | None = None,
    percent: int = 100,
    blank_as_null: bool = True,
) -> DataFrame:
    """Column pairs where at least ``percent`` of a column's distinct values stand in a unique column.

    (child_table, child_column, parent_table, parent_column, n_values, n_found): candidates for foreign keys. All
    pairs of columns of one kind are looked at; values meet once, not once per pair.
    """
    columns = columns or {t: df.columns for t, df in tables.items()}
    columns = worth_comparing(tables, columns, percent)
    sets = value_sets(tables, columns, blank_as_null)
    column = lambda held: F.transform(held, lambda h: h["column"])
    each = sets.select("n", column("held").alias("all"), F.explode("held").alias("own"))
    facts = each.groupBy(F.col("own.column").alias("column")).agg(
        F.sum("n").alias("n_values"), (~F.bool_or("own.repeated")).alias("is_unique")
    )
    pairs = each.select("n", F.col("own.column").alias("child"), F.explode("all").alias("parent")).filter("child <> parent")
    found = pairs.groupBy("child", "parent").agg(F.sum("n").alias("n_found"))
    child = facts.select(F.col("column").alias("child"), "n_values")
    parent = facts.filter("is_unique").select(F.col("column").alias("parent"))
    hits = found.join(child, "child").join(parent, "parent")
    part = lambda c, n: F.substring_index(c, ".", n)
    return hits.filter(F.col("n_found") * 100 >= F.col("n_values") * percent).select(
        part("child", 1).alias("child_table"),
        part("child", -1).alias("child_column"),
        part("parent", 1).alias("parent_table"),
        part("parent", -1).alias("parent_column"),
        "n_values",
        "n_found",
    )


# ---- keys of several columns ----------------------------------------------------------------
def _candidates(
    columns: list[str], size: int, found: list[tuple[str, ...]], open_: set[tuple[str, ...]]
) -> list[tuple[str, ...]]:
    """Combinations of a size without a key in them, all of whose parts are open."""
    out = []
    for combination in combinations(columns, size):
        inside = any(set(key) <= set(combination) for key in found)
        parts = size == 1 or all(p in open_ for p in combinations(combination, size - 1))
        if parts and not inside:
            out.append(combination)
    return out


def _ruled_in(
    df: DataFrame, candidates: list[tuple[str, ...]], rows: int, sizes: dict[tuple[str, ...], float]
) -> Iterator[tuple[str, ...]]:
    """Candidates that a sketch of their distinct values does not rule out.

    ``sizes`` holds the estimates of earlier levels and takes those of this one. A combination has no more values than
    its parts multiplied, and needs no sketch where that is too few.
    """
    for c in candidates:
        sizes[c] = sizes[c[:-1]] * sizes[c[-1:]] * (1 + SKETCH_MARGIN) if len(c) > 1 else float("inf")
    candidates = [c for c in candidates if sizes[c] >= rows * (1 - SKETCH_MARGIN)]
    for start in range(0, len(candidates), AT_ONCE):
        part = candidates[start : start + AT_ONCE]
        seen = df.agg(
            *[F.approx_count_distinct(F.struct(*c), SKETCH_ERROR).alias(f"n{i}") for i, c in enumerate(part)]
        ).first()
        sizes.update({c: seen[i] for i, c in enumerate(part)})
        yield from (c for i, c in enumerate(part) if seen[i] >= rows * (1 - SKETCH_MARGIN))


def composite_keys(df: DataFrame, columns: list[str] | None = None, most: int = 3) -> list[tuple[str, ...]]:
    """The minimal combinations of at most ``most`` columns that no two rows share, without nulls.

    Level by level: a combination that holds a key is none of the minimal ones. Sketches of all combinations of a level
    come from one pass and rule out those whose distinct values are clearly fewer than the rows; the others
    are grouped exactly. Only names and counts come to the driver.
    """
    columns = columns or df.columns
    known = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]
    counts = df.agg(F.count("*").alias("rows"), *known).first()
    rows = counts[0]
    columns = [c for i, c in enumerate(columns) if counts[i + 1] == rows]
    found: list[tuple[str, ...]] = []
    open_: set[tuple[str, ...]] = set()
    sizes: dict[tuple[str, ...], float] = {}
    for size in range(1, most + 1):
        candidates = _candidates(columns, size, found, open_)
        exact = [c for c in _ruled_in(df, candidates, rows, sizes) if _is_unique(df, c)]
        found += exact
        open_ = set(candidates) - set(exact)
    return found


def _is_unique(df: DataFrame, columns: tuple[str, ...]) -> bool:
    """Whether no two rows share the values. All rows of a value are in one part of its hash, so a repeat in one part
    rules the key out, and the other parts need not move. Without one, all rows are grouped."""
    names = [f"`{c}`" for c in columns]

    def repeats(part: DataFrame) -> bool:
        return not part.groupBy(*names).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()

    return not repeats(df.filter(F.pmod(F.xxhash64(*names), F.lit(PARTS)) == 0)) and not repeats(df)


def key_report(tables: dict[str, DataFrame], most: int = 3) -> DataFrame:
    """(table_name, key_columns, n_columns): the minimal keys of every table."""
    keys = [(t, ",".join(k), len(k)) for t, df in tables.items() for k in composite_keys(df, most=most)]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(keys, "table_name string, key_columns string, n_columns int")
