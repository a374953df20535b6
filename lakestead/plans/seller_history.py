"""The seller history, fed with snapshots of any day in any order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from lakestead.operators import scd2
from lakestead.operators.dedupe import first_per_key
from lakestead.operators.surrogate import hash_key
from lakestead.plans.warehouse import SELLER_TRACKED
from lakestead.schemas import conform
from lakestead.sources.files import ZoneStore

KEY = "seller_id"
COLUMNS = ["seller_id", "seller_state", "seller_city", "seller_zip_code_prefix"]


def batch_of(day: dt.date) -> int:
    """The batch number of a load on a day; streamed batches count from 0 and come after all of them."""
    return day.toordinal() - dt.date.max.toordinal() - 1


def log(store: ZoneStore, sellers: DataFrame, day: dt.date, table: str = "dim_seller_scd") -> None:
    """Keep the sellers of a load as sightings of its day."""
    seen = sellers.select(*COLUMNS).withColumn("seen_on", F.lit(day))
    _write_sightings(store, table, seen, "seen_on", batch_of(day), "seller_city")


def deliver(
    store: ZoneStore, snapshots: DataFrame, on: str, batch: int, table: str = "dim_seller_scd", order: str = "seller_city"
) -> DataFrame:
    """Put sellers seen on days (column ``on``) into the history, and return it.

    All sightings are kept, by day and batch. Only those from the earliest day of the batch on are read, and
    of them the sellers of the batch: a snapshot of today reads none but its own. Of several sightings of a seller on
    a day the one of the latest batch counts, within a batch the least by ``order`` and the other columns. A repeated
    batch replaces its own sightings and starts from the history before it, so it changes nothing.
    """
    read = _write_sightings(store, table, snapshots, on, batch, order)
    own = read.filter(F.col("_batch") == batch)
    earliest = own.agg(F.min("_day")).first()[0]
    history = store.versions("warehouse", table)
    if earliest is None and history.state() is not None:
        return history.read()
    first = own.groupBy(KEY).agg(F.min("_day").alias("_from"))
    since = read.filter(F.col("_day") >= F.lit(earliest)).join(first, KEY)
    known = since.filter(F.col("_day") >= F.col("_from")).drop("_from")
    sightings = first_per_key(known, [KEY, "_day"], [F.desc("_batch")]).drop("_batch")
    versions = scd2.splice(history.before(batch), sightings, KEY, SELLER_TRACKED, "_day")
    keyed = versions.withColumn("scd_id", hash_key(KEY, "valid_from"))
    return store.overwrite("warehouse", table, conform(keyed, "warehouse.dim_seller_scd"), tag=batch)


def _write_sightings(
    store: ZoneStore, table: str, snapshots: DataFrame, on: str, batch: int, order: str
) -> DataFrame:
    """Replace the sightings of a batch; returns all that are stored."""
    rest = [c for c in snapshots.columns if c not in (KEY, on, order)]
    given = snapshots.filter(F.col(KEY).isNotNull() & F.col(on).isNotNull())
    given = first_per_key(given, [KEY, on], [F.asc(c) for c in (order, *rest)])
    path = store.path("warehouse", f"{table}_sightings")
    dated = given.withColumns({"_day": F.col(on).cast("date"), "_batch": F.lit(batch)}).drop(on)
    writer = dated.write.mode("overwrite").partitionBy("_day", "_batch")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return store.spark.read.schema(dated.schema).parquet(path)
