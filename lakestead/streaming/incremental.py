"""Incremental loads with Structured Streaming. Each run takes what is new and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakestead.operators.dedupe import first_per_key
from lakestead.plans import seller_history
from lakestead.sources.files import ZoneStore
from lakestead.sources.index import ContentIndex
from lakestead.sources.versions import Folder


def file_stream(
    spark: SparkSession,
    folder: str,
    table_schema: StructType,
    pattern: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(table_schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def ingest_once(
    stream: DataFrame, key: str, event_time: str, target: str, checkpoint: str, across_days: bool = False
) -> None:
    """Append rows to a raw table, each key once however often and however late it is delivered.

    The table is partitioned by day of event time and by batch; rows without a time have a day of their
    own. A batch is compared with the earlier batches of the days that it touches, and reads no other days, so
    nothing is kept in state and no late row is lost; a replayed batch replaces its own partitions.
    A key that comes back with a time on another day is another row, unless ``across_days`` is set: then an index
    of all keys, by hash bucket, is asked, and the first delivery counts.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        _store_new(batch, key, event_time, target, batch_id, across_days)

    _run(stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint))


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a table that ingest_once fills."""
    return spark.read.parquet(target).drop("_day", "_batch")


def load_stats_per_hour(
    stream: DataFrame, key: str, event_time: str, group: str, value: str, base: str, checkpoint: str
) -> None:
    """Rows, sum and latest event per hour of event time, in ``<base>/stats``.

    Rows go to ``<base>/rows`` as in ingest_once; the days that a batch touches are counted again from
    there and replaced. No state grows, and late rows change the hour that they belong to. Rows
    without a time are stored and counted for no hour.
    """
    rows, stats = f"{base}/rows", f"{base}/stats"

    def step(batch: DataFrame, batch_id: int) -> None:
        days = _store_new(batch, key, event_time, rows, batch_id, False)
        touched = of_days(batch.sparkSession.read.parquet(rows), [d for d in days if d is not None])
        counted = hourly_stats(touched.filter(F.col("_batch") <= batch_id), event_time, group, value)
        _write_days(counted.withColumn("_day", F.to_date("hour")), stats, "_day")

    _run(stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint))


def of_days(stored: DataFrame, days: list) -> DataFrame:
    """The partitions of some days; None is the day of rows without a time."""
    wanted = F.col("_day").isin([d for d in days if d is not None])
    return stored.filter(wanted | F.col("_day").isNull() if None in days else wanted)


def unseen(rows: DataFrame, stored: DataFrame, key: str, days: list) -> DataFrame:
    """rows without those whose key is stored for the same day; only partitions of those days are read."""
    earlier = of_days(stored, days).select(F.col(key).alias("_key"), F.col("_day").alias("_stored_day"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_day").eqNullSafe(F.col("_stored_day"))
    return rows.join(earlier, same, "left_anti")


def _store_new(
    batch: DataFrame, key: str, event_time: str, target: str, batch_id: int, across_days: bool
) -> list:
    """Write the rows of a batch that are not stored yet; returns the days that the batch touches."""
    spark = batch.sparkSession
    unique = [key] if across_days else [key, "_day"]
    rows = batch.withColumn("_day", F.to_date(event_time))
    rows = first_per_key(rows, unique, [F.asc_nulls_last(event_time)])
    # The days of one batch: dates, of which there are few.
    days = [r[0] for r in batch.select(F.to_date(event_time)).distinct().collect()]
    if across_days:
        index = ContentIndex(ZoneStore(spark, f"{target}_index"), "keys", "events")
        named = rows.withColumns(
            {"load_id": F.lit(str(batch_id)), "_content": F.coalesce(F.col(key).cast("string"), F.lit(""))}
        )
        index.enter(named.select(F.col("_content").alias("content")), str(batch_id))
        rows = index.fresh(named, "_content").drop("load_id", "_content")
    elif Folder(spark, target).has_files():
        stored = spark.read.parquet(target).filter(F.col("_batch") < batch_id)
        rows = unseen(rows, stored, key, days)
    _write_days(rows.withColumn("_batch", F.lit(batch_id)), target, "_day", "_batch")
    return days


def _write_days(rows: DataFrame, path: str, *partitions: str) -> None:
    """Replace the partitions that rows belong to."""
    writer = rows.write.mode("overwrite").partitionBy(*partitions)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def hourly_stats(events: DataFrame, event_time: str, group: str, value: str) -> DataFrame:
    """The same statistics on a batch or a stream."""
    hour = F.window(event_time, "1 hour")
    return (
        events.groupBy(hour.alias("w"), group)
        .agg(
            F.count("*").alias("n_events"),
            F.sum(F.col(value).cast("decimal(18,2)")).cast("decimal(18,2)").alias("total_value"),
            F.max(event_time).alias("last_event"),
        )
        .select(F.col("w.start").alias("hour"), group, "n_events", "total_value", "last_event")
    )


def apply_seller_snapshots(
    stream: DataFrame, store: ZoneStore, table: str, snapshot_date: str, checkpoint: str, order: str = "seller_city"
) -> None:
    """Feed seller snapshots into the seller history, a version of the table per batch.

    A batch may hold several days, late ones too, and a seller several times on a day. A replayed
    batch changes nothing; one without rows (an empty delivery) neither.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            seller_history.deliver(store, batch, snapshot_date, batch_id, table, order)

    _run(stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint))


def _run(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()
