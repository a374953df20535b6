"""CSV folders in, CSV and Parquet tables out."""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakestead.sources.versions import Folder, VersionedTable, partition_folder

# Blanks around a value are part of it; a quote in a quoted value is doubled.
_CSV = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "quote": '"',
    "escape": '"',
}
CORRUPT = "_corrupt_record"


def scan_csv(
    spark: SparkSession, path: str, table_schema: StructType, multi_line: bool = False, corrupt: bool = False
) -> DataFrame:
    """A CSV file or folder with a header row; a byte-order mark and CRLF are handled.

    ``multi_line`` allows line breaks in quoted values; such a file is read by one task and not split.
    ``corrupt`` adds the text of lines that do not fit the schema, NULL for those that do.
    """
    if corrupt:
        table_schema = StructType([*table_schema, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(table_schema).options(**_CSV, multiLine=str(multi_line).lower())
    return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def csv_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Path per table of a folder: ``<stem>.csv``, a file or a folder of part files. Only names are read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    inside = F.regexp_extract("path", r"([^/]+\.csv)(?:/[^/]*)?$", 1)
    names = found.select(inside.alias("name")).filter("name <> ''").distinct().orderBy("name").collect()
    return {r.name.removesuffix(".csv"): posixpath.join(folder, r.name) for r in names}


def text_schema(spark: SparkSession, path: str) -> StructType:
    """The header's columns, all as text."""
    return spark.read.options(**_CSV, inferSchema="false").csv(path).schema


def scan_csv_folder(
    spark: SparkSession, folder: str, schemas: dict[str, StructType]
) -> dict[str, DataFrame]:
    """One frame per ``<stem>.csv`` of the folder for which a schema is given."""
    return {
        stem: scan_csv(spark, posixpath.join(folder, f"{stem}.csv"), table_schema)
        for stem, table_schema in schemas.items()
    }


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """A folder of part files, one per task. Readers tell ``compression`` by the names of the files."""
    df.write.mode("overwrite").options(**_CSV, compression=compression).csv(path)


class ZoneStore:
    """Zones as folders of Parquet tables: ``<root>/<zone>/<table>``.

    Tables that are written whole, or by partition, are versioned: a pointer switches to what was
    written. Raw loads and quarantined rows are plain partitions that replace themselves.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, zone: str, table: str) -> str:
        return f"{self.root}/{zone}/{table}"

    def versions(self, zone: str, table: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(zone, table))

    def exists(self, zone: str, table: str) -> bool:
        return self.versions(zone, table).state() is not None or Folder(
            self.spark, self.path(zone, table)
        ).has_files()

    def read(self, zone: str, table: str) -> DataFrame:
        versions = self.versions(zone, table)
        state = versions.state()
        return versions.read(state) if state else self.spark.read.parquet(self.path(zone, table))

    def read_if_there(self, zone: str, table: str) -> DataFrame | None:
        return self.read(zone, table) if self.exists(zone, table) else None

    def tables(self, zone: str) -> list[str]:
        """Names of the tables of a zone."""
        return sorted(Folder(self.spark, f"{self.root}/{zone}").folders())

    def overwrite(
        self,
        zone: str,
        table: str,
        df: DataFrame,
        partition_by: str | None = None,
        only_touched: bool = False,
        emptied: list[object] = (),
        tag: int | None = None,
        check: Callable[[], None] | None = None,
        balance: bool = True,
    ) -> DataFrame:
        """Write the whole table, or with ``only_touched`` the partitions present in ``df`` and those
        named by ``emptied``, which may have no rows left.

        Rows are rebalanced by the partition column: small values share a file, a hot value is
        spread over several tasks. Rows that are all of one partition, or balanced before, need no ``balance``. The table may be
        made from itself. ``check`` runs before the table is switched to the new rows.
        """
        if partition_by and balance:
            df = df.hint("rebalance", partition_by)
        replaced = {partition_folder(partition_by, v) for v in emptied} if only_touched else None
        partitions = (partition_by,) if partition_by else ()
        return self.versions(zone, table).write(df, partitions, replaced, tag, check)
