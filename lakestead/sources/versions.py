"""Tables whose content is switched by one small pointer.

A write goes to a folder of its own, ``<table>/_v=<n>/``. The pointer ``<table>/_current`` names the folders
that make up the table and is replaced in one rename when they are complete. So a write that
fails leaves the table as it was, and a reader keeps the files that it opened until ``vacuum`` removes them. Where a write
replaces some partitions only, the pointer names the partitions of several folders. It holds
one line per partition at most, and the schema, so that an empty table has one.

Only the pointer and folder names pass through the driver, by the file system of the path.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructType

POINTER, FOLDER = "_current", "_v"
#: A partition with more files than that, of less than so many bytes in the mean, is put together when it is replaced.
MOST_FILES, SMALL_FILE = 8, 16 << 20


def partition_folder(column: str, value: object) -> str:
    """The folder of a partition by a date, a number or a plain word."""
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


@dataclass(frozen=True)
class State:
    """What a table consists of: folders below it, and the state before."""

    version: int
    paths: tuple[str, ...]
    schema: str
    partition_by: tuple[str, ...] = ()
    tag: int | None = None
    previous: State | None = None

    def to_json(self) -> str:
        own = {**self.__dict__, "previous": None}
        if self.previous:
            # One step back is kept: a repeated batch starts there.
            own["previous"] = {**self.previous.__dict__, "previous": None}
        return json.dumps(own)

    @staticmethod
    def from_json(text: str) -> State:
        def state(d: dict) -> State:
            before = d.pop("previous", None)
            d["paths"], d["partition_by"] = tuple(d["paths"]), tuple(d["partition_by"])
            return State(**d, previous=state(before) if before else None)

        return state(json.loads(text))


@dataclass(frozen=True)
class Folder:
    """A folder of a Hadoop file system: names, small texts and deletion."""

    spark: SparkSession
    path: str
    _fs: object = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "_fs", self._at("").getFileSystem(self.spark._jsc.hadoopConfiguration()))

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def folders(self, name: str = "") -> dict[str, int]:
        """Names of folders and when they were last changed, in milliseconds."""
        if not self.exists(name):
            return {}
        found = self._fs.listStatus(self._at(name))
        return {s.getPath().getName(): s.getModificationTime() for s in found if s.isDirectory()}

    def has_files(self) -> bool:
        """Whether a data file lies in the folder, or below it."""
        if not self.exists():
            return False
        files = self._fs.listFiles(self._at(""), True)
        while files.hasNext():
            if not files.next().getPath().getName().startswith(("_", ".")):
                return True
        return False

    def size(self, name: str) -> tuple[int, int]:
        """Number and bytes of the files in a folder."""
        found = [s for s in self._fs.listStatus(self._at(name)) if s.isFile()]
        return len(found), sum(s.getLen() for s in found)

    def text(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a text aside, and rename it over the one that is there."""
        aside = self._at(f".{name}-{uuid.uuid4().hex}")
        stream = self._fs.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        over = self.spark.sparkContext._gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        target = self._fs.makeQualified(self._at(name))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
        context.rename(self._fs.makeQualified(aside), target, over)

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.folder = Folder(spark, self.path)

    def state(self) -> State | None:
        text = self.folder.text(POINTER)
        return State.from_json(text) if text else None

    def read(self, state: State | None = None, paths: tuple[str, ...] | None = None) -> DataFrame:
        """The table as it is now, in a given state, or some of its folders."""
        state = state or self.state()
        if state is None:
            raise FileNotFoundError(f"no table at {self.path}")
        wanted = StructType.fromJson(json.loads(state.schema))
        paths = state.paths if paths is None else paths
        if not paths:
            return self.spark.createDataFrame([], wanted)
        given = StructType(list(wanted)).add(FOLDER, IntegerType())
        reader = self.spark.read.schema(given).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{p}" for p in paths]).select(*wanted.names)

    def write(
        self,
        df: DataFrame,
        partition_by: tuple[str, ...] = (),
        replaced: set[str] | None = None,
        tag: int | None = None,
        check: Callable[[], None] | None = None,
    ) -> DataFrame:
        """Write a new version and switch to it. ``check`` runs in between, and can raise to keep the old one.

        ``replaced`` names the partition folders (``column=value``, of the first partition column) that the rows
        stand for, with or without rows; those that have rows are always replaced, all others stay. None
        replaces the whole table. A write with the tag of the current version takes that version's place.
        """
        now = self.state()
        before = now.previous if now and tag is not None and now.tag == tag else now
        version = 1 + max([int(n.split("=")[1]) for n in self.folder.folders() if n.startswith(f"{FOLDER}=")] or [0])
        own = f"{FOLDER}={version}"
        df.write.partitionBy(*partition_by).parquet(f"{self.path}/{own}")
        paths: tuple[str, ...] = (own,)
        if replaced is not None:
            mine = [n for n in self.folder.folders(own) if "=" in n]
            gone = set(mine) | replaced
            kept = [p for p in self._by_partition(before) if p.split("/")[1] not in gone]
            paths = (*kept, *(f"{own}/{n}" for n in mine))
        if check:
            check()
        state = State(version, paths, df.schema.json(), tuple(partition_by), tag, before)
        self.folder.put(POINTER, state.to_json())
        return self.read(state)

    def _by_partition(self, state: State | None) -> list[str]:
        if state is None:
            return []
        out = []
        for path in state.paths:
            whole = "/" not in path
            out += [f"{path}/{n}" for n in self.folder.folders(path) if "=" in n] if whole else [path]
        return sorted(out)

    def crowded(self, values: list) -> list:
        """Those values of the first partition column whose folders hold more than a few files that are small."""
        state = self.state()
        paths = {p.split("/")[1]: p for p in self._by_partition(state)}
        out = []
        for value in values:
            path = paths.get(partition_folder(state.partition_by[0], value))
            n, size = self.folder.size(path) if path else (0, 0)
            if n > MOST_FILES and size < n * SMALL_FILE:
                out.append(value)
        return out

    def before(self, tag: int) -> DataFrame | None:
        """The table as it was before the write with that tag; None when there was none."""
        state = self.state()
        if state is not None and state.tag == tag:
            state = state.previous
        return None if state is None else self.read(state)

    def between(self, old: State | None, new: State) -> tuple[DataFrame, DataFrame]:
        """The rows of the folders that only one of two states has: those gone, and those that came.

        Partitions that both states share are not read.
        """
        if not new.partition_by:
            was, now = set(old.paths) if old else set(), set(new.paths)
        else:
            was, now = set(self._by_partition(old)), set(self._by_partition(new))
        return self.read(old or new, tuple(sorted(was - now))), self.read(new, tuple(sorted(now - was)))

    def vacuum(self, before: dt.datetime) -> list[str]:
        """Remove folders last written before a moment that neither the table nor its last state needs."""
        state = self.state()
        used = set()
        for s in (state, state.previous if state else None):
            used |= {p.split("/")[0] for p in s.paths} if s else set()
        found = self.folder.folders()
        old = [n for n, t in found.items() if n.startswith(f"{FOLDER}=") and t < before.timestamp() * 1000]
        gone = sorted(n for n in old if n not in used)
        for name in gone:
            self.folder.delete(name)
        return gone
