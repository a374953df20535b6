"""Type 2 slowly changing dimension: one join per snapshot, history kept as half-open intervals."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestead.fixed_values import ETL_USER, REASON_CLOSED, REASON_INITIAL, REASON_UPDATED
from lakestead.operators.dedupe import first_per_key

VERSION_COLUMNS = ("is_active", "is_current", "valid_from", "valid_to", "change_reason", "created_by")


def initial(
    snapshot: DataFrame, key: str, tracked: list[str], as_of: dt.date, compat: bool = False
) -> DataFrame:
    """First load: every known key gets an open version. ``compat=True`` closes a version with a
    NULL tracked value on the same day."""
    today = F.lit(as_of).cast("date")
    shut = reduce(Column.__or__, [F.col(c).isNull() for c in tracked]) & F.lit(compat)
    return snapshot.filter(F.col(key).isNotNull()).select(
        *snapshot.columns,
        F.lit(True).alias("is_active"),
        (~shut).alias("is_current"),
        today.alias("valid_from"),
        F.when(shut, today).alias("valid_to"),
        F.when(shut, REASON_CLOSED).otherwise(REASON_INITIAL).alias("change_reason"),
        F.lit(ETL_USER).alias("created_by"),
    )


def apply(
    existing: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: list[str],
    as_of: dt.date,
    compat: bool = False,
) -> DataFrame:
    """The dimension after a snapshot. ``snapshot`` holds a key at most once.

    A change of a tracked column closes the current version and opens a new one; keys the snapshot
    leaves out stay as they are. By default values compare null-safe, and a second change on the
    day a version was opened replaces that version in place. ``compat=True`` compares with plain
    ``!=``, treats a NULL in the current version as a change, and on the same day closes the
    version without being able to open another.
    """
    attributes = [c for c in snapshot.columns if c != key]
    columns = [key, *attributes, *VERSION_COLUMNS]
    today = F.lit(as_of).cast("date")

    # A key has one current version, so the aggregate keeps one row per key however long its
    # history is; closed versions are passed on untouched and never joined.
    history = existing.filter(~F.col("is_current")).select(*columns)
    version = F.struct(*[c for c in columns if c != key])
    known = existing.groupBy(key).agg(
        F.max(F.when(F.col("is_current"), version)).alias("cur"),
        F.max(F.col("valid_from") == today).alias("opened_today"),
    )
    incoming = snapshot.filter(F.col(key).isNotNull()).select(
        key, F.struct(*attributes).alias("new")
    )
    both = known.withColumn("known", F.lit(True)).join(incoming, key, "full_outer")

    if compat:
        differs = reduce(
            Column.__or__,
            [F.col(f"cur.{c}").isNull() for c in tracked]
            + [F.col(f"cur.{c}") != F.col(f"new.{c}") for c in tracked],
        )
    else:
        differs = reduce(
            Column.__or__, [~F.col(f"cur.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked]
        ) & (F.col("cur.valid_from") <= today)

    has_current, has_new = F.col("cur").isNotNull(), F.col("new").isNotNull()
    is_known = F.coalesce(F.col("known"), F.lit(False))
    changed = has_current & has_new & F.coalesce(differs, F.lit(False))
    opened_today = F.coalesce(F.col("opened_today"), F.lit(False))

    def row(values: dict[str, Column]) -> Column:
        return F.struct(
            F.col(key).alias(key),
            *[
                values.get(c, F.col(f"cur.{c}")).cast(existing.schema[c].dataType).alias(c)
                for c in columns
                if c != key
            ],
        )

    new_attributes = {c: F.col(f"new.{c}") for c in attributes}

    def opened(reason: str) -> Column:
        return row(
            {
                **new_attributes,
                "is_active": F.lit(True),
                "is_current": F.lit(True),
                "valid_from": today,
                "valid_to": F.lit(None),
                "change_reason": F.lit(reason),
                "created_by": F.lit(ETL_USER),
            }
        )

    closed = row(
        {"is_current": F.lit(False), "valid_to": today, "change_reason": F.lit(REASON_CLOSED)}
    )
    kept = row({})
    first = opened(REASON_INITIAL)
    successor = opened(REASON_UPDATED)

    if compat:
        # A first version with a NULL tracked value is closed at once, and its successor clashes
        # with it on (key, valid_from).
        null_first = reduce(Column.__or__, [F.col(f"new.{c}").isNull() for c in tracked])
        first = F.when(
            null_first,
            row(
                {
                    **new_attributes,
                    "is_active": F.lit(True),
                    "is_current": F.lit(False),
                    "valid_from": today,
                    "valid_to": today,
                    "change_reason": F.lit(REASON_CLOSED),
                    "created_by": F.lit(ETL_USER),
                }
            ),
        ).otherwise(first)
        old = F.when(has_current, F.when(changed, closed).otherwise(kept))
        added = F.when(has_new & ~is_known, first).when(
            has_new & is_known & (changed | ~has_current) & ~opened_today, successor
        )
    else:
        in_place = changed & (F.col("cur.valid_from") == today)
        old = F.when(
            has_current,
            F.when(in_place, row(new_attributes)).when(changed, closed).otherwise(kept),
        )
        added = F.when(has_new & ~is_known, first).when(
            has_new & is_known & ((changed & ~in_place) | ~has_current), successor
        )

    versions = both.select(F.explode(F.array_compact(F.array(old, added))).alias("row"))
    return history.unionByName(versions.select(*[f"row.{c}" for c in columns]))


def splice(existing: DataFrame | None, sightings: DataFrame, key: str, tracked: list[str], on: str) -> DataFrame:
    """The dimension after sightings of any days, late ones too.

    ``sightings`` holds a key at most once a day (``on``) and, for each of its keys, all that is known from
    its first day on. Versions and sightings of such a key are put on one time line from that day; where
    a tracked column differs from the neighbour before, a version begins, which ends where the next one
    does. The version in force on the first day is cut or goes on; versions before it, and all other keys, stay
    as they are. So all orders of delivery of the same sightings lead to the same history. A sighting
    replaces a version that begins on its day. A version takes its other columns from the sighting that opens it.
    """
    attributes = [c for c in sightings.columns if c not in (key, on)]
    columns = [key, *attributes, *VERSION_COLUMNS]
    seen = sightings.filter(F.col(key).isNotNull() & F.col(on).isNotNull())
    line = seen.select(
        key, *attributes, F.col(on).alias("valid_from"), F.lit(0).alias("_rank"), F.lit(False).alias("_base"),
        F.lit(False).alias("_first"), F.lit(ETL_USER).alias("created_by"),
    )
    stay = None
    if existing is not None:
        first = seen.groupBy(key).agg(F.min(on).alias("_from"))
        marked = existing.select(*columns).join(first, key, "left")
        before = F.col("valid_from") < F.col("_from")
        of_key = Window.partitionBy(key)
        touched = marked.filter("_from is not null").withColumns(
            {
                "_last": F.max(F.when(before, F.col("valid_from"))).over(of_key),
                "_opened": F.min("valid_from").over(of_key),
            }
        )
        base = F.col("valid_from").eqNullSafe(F.col("_last"))
        stay = marked.filter("_from is null").select(*columns).unionByName(
            touched.filter(F.col("valid_from") < F.col("_last")).select(*columns)
        )
        on_line = touched.filter(F.coalesce(F.col("valid_from") >= F.col("_last"), F.lit(True))).select(
            key, *attributes, "valid_from", F.lit(1).alias("_rank"), base.alias("_base"),
            (base & (F.col("valid_from") == F.col("_opened"))).alias("_first"), "created_by",
        )
        line = first_per_key(line.unionByName(on_line), [key, "valid_from"], [F.asc("_rank")])
    order = Window.partitionBy(key).orderBy("valid_from")
    values = F.struct(*tracked)
    begins = F.lag(values).over(order).isNull() | ~values.eqNullSafe(F.lag(values).over(order))
    # Without an earlier version the first row of the line is the first of its key.
    based = F.max("_base").over(Window.partitionBy(key))
    first_row = F.col("_first") | (~based & (F.row_number().over(order) == 1))
    starts = line.withColumns({"_begins": begins, "_first": first_row}).filter("_begins")
    ends = F.lead("valid_from").over(order)
    rebuilt = starts.withColumn("valid_to", ends).select(
        key,
        *attributes,
        F.lit(True).alias("is_active"),
        F.col("valid_to").isNull().alias("is_current"),
        "valid_from",
        "valid_to",
        F.when(F.col("valid_to").isNotNull(), REASON_CLOSED)
        .when(F.col("_first"), REASON_INITIAL)
        .otherwise(REASON_UPDATED)
        .alias("change_reason"),
        "created_by",
    )
    return rebuilt if stay is None else stay.unionByName(rebuilt)


def current(dimension: DataFrame) -> DataFrame:
    return dimension.filter("is_current")


def history_of(dimension: DataFrame, key: str, value: str) -> DataFrame:
    """All versions of one key, newest first."""
    return dimension.filter(F.col(key) == F.lit(value)).orderBy(F.desc("valid_from"))
