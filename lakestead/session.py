"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Runtime settings every job relies on; none depends on the size of the cluster.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs the next operator an extra exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task that writes a few partitions keeps a file open for each instead of sorting, and spilling, its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Digests and documents take about half the room that the default codec leaves them.
    "spark.sql.parquet.compression.codec": "zstd",
    "parquet.compression.codec.zstd.level": "9",
    # Ascending keys are stored as differences.
    "parquet.writer.version": "PARQUET_2_0",
}

_scratch: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "lakestead", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {"spark.sql.session.timeZone": "UTC", **(conf or {})}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def name_scratch(spark: SparkSession, root: str) -> None:
    """The scratch root of sessions that have no ``spark.checkpoint.dir``, as in tests on one machine."""
    _scratch[spark.sparkContext.applicationId] = root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one named by ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _scratch.get(spark.sparkContext.applicationId)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{root.rstrip('/')}/lakestead/{name}-{uuid.uuid4().hex}"
    owner = _owner.get()
    if owner is not None:
        owner.paths.append(path)
    return path


class Scratch:
    """Scratch folders made within a ``with`` block, which are removed at its end.

    Whatever reads them must be done or written by then. What is made in ``outside()`` belongs to the block around
    it, or to nobody.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        self._before = _owner.get()
        self._token = _owner.set(self)
        return self

    def __exit__(self, *error: object) -> None:
        _owner.reset(self._token)
        for path in self.paths:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    @contextmanager
    def outside(self) -> Iterator[None]:
        token = _owner.set(self._before)
        try:
            yield
        finally:
            _owner.reset(token)


_owner: ContextVar[Scratch | None] = ContextVar("scratch", default=None)
