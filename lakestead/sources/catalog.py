"""Zones as catalog databases, and what the catalog and the data say about a table.

Stored tables are registered as external tables of a database per zone, with their partitions where they lie and
statistics of all columns. Facts about them are then answered from the catalog without reading a file.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakestead.schemas import DEFAULTS, NOT_NULL
from lakestead.sources.files import ZoneStore
from lakestead.sources.versions import Folder


def create_zone(spark: SparkSession, zone: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{zone}`{where}")


def drop_zone(spark: SparkSession, zone: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{zone}` CASCADE")


def zones(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def tables(spark: SparkSession, zone: str) -> list[str]:
    """Tables and views of a zone; temporary views belong to the session, not to a zone."""
    return sorted(t.name for t in spark.catalog.listTables(zone) if not t.isTemporary)


# ---- stored zones ---------------------------------------------------------------------------
def register(store: ZoneStore, zone: str, database: str, tables: list[str] | None = None) -> None:
    """Make the stored tables of a zone known as external tables of a database, as they are now.

    Dropping an external table removes no data. A partition may lie in the folder of any version.
    """
    create_zone(store.spark, database)
    for table in store.tables(zone) if tables is None else tables:
        _register_table(store, zone, table, f"`{database}`.`{table}`")


def _register_table(store: ZoneStore, zone: str, table: str, name: str) -> None:
    spark, versions = store.spark, store.versions(zone, table)
    state = versions.state()
    if state is None:
        columns, partitions = store.read(zone, table).schema, _partition_columns(store, zone, table)
    else:
        columns, partitions = StructType.fromJson(json.loads(state.schema)), list(state.partition_by)
    root = versions.path if state is None or not state.paths else f"{versions.path}/{state.paths[0].split('/')[0]}"
    declared = f"{zone}.{table}"

    def column(field) -> str:
        default = DEFAULTS.get(declared, {}).get(field.name)
        return f"`{field.name}` {field.dataType.simpleString()}" + (f" DEFAULT {default}" if default else "")

    by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)})" if partitions else ""
    # Spark reads every column of a file source as nullable; what is declared goes along as a property.
    must = ",".join(NOT_NULL.get(declared, ()))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(column(f) for f in columns)}) USING parquet{by}"
        f" LOCATION {_quoted(root)} TBLPROPERTIES ('not_null' = {_quoted(must)})"
    )
    if partitions and (state is None or all("/" not in p for p in state.paths)):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    elif partitions:
        for path in (leaf for p in state.paths for leaf in _leaves(versions.folder, p, len(partitions))):
            values = [_partition_value(part) for part in path.split("/")[1:]]
            place = _quoted(f"{versions.path}/{path}")
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({', '.join(values)}) LOCATION {place}")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def _leaves(folder: Folder, path: str, levels: int) -> list[str]:
    """The partitions of all levels below a folder of a version."""
    if path.count("/") == levels:
        return [path]
    return [leaf for n in folder.folders(path) if "=" in n for leaf in _leaves(folder, f"{path}/{n}", levels)]


def _partition_columns(store: ZoneStore, zone: str, table: str) -> list[str]:
    found, path = [], ""
    while True:
        inner = [n for n in Folder(store.spark, store.path(zone, table)).folders(path) if "=" in n]
        if not inner:
            return found
        found.append(inner[0].split("=")[0])
        path = f"{path}/{inner[0]}".strip("/")


def _partition_value(part: str) -> str:
    name, value = part.split("=", 1)
    if value == "__HIVE_DEFAULT_PARTITION__":
        return f"`{name}` = NULL"
    return f"`{name}` = {_quoted(value)}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _described(spark: SparkSession, database: str) -> dict[str, dict]:
    """What the catalog says of every table of a database."""
    text = lambda t: spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{t}` AS JSON").first()[0]
    return {t: json.loads(text(t)) for t in tables(spark, database)}


def zone_tables(spark: SparkSession, databases: dict[str, str]) -> DataFrame:
    """Per table of the zones (zone -> database): rows, columns and partition columns, as of its registration."""
    rows = []
    for zone, database in databases.items():
        for name, facts in _described(spark, database).items():
            by = ",".join(facts.get("partition_columns", []))
            rows.append((zone, name, facts["statistics"]["num_rows"], len(facts["columns"]), by))
    return spark.createDataFrame(
        rows, "zone string, table_name string, n_rows bigint, n_columns int, partitioned_by string"
    )


def zone_columns(spark: SparkSession, databases: dict[str, str]) -> DataFrame:
    """Per column of the zones' tables: position, type, whether it may be NULL, default, and NULLs counted by ANALYZE."""
    rows = []
    for zone, database in databases.items():
        for name, facts in _described(spark, database).items():
            types = spark.table(f"`{database}`.`{name}`").schema
            must = facts.get("table_properties", {}).get("not_null", "").split(",")
            for n, column in enumerate(facts["columns"], 1):
                c = column["name"]
                nulls = spark.sql(f"DESCRIBE EXTENDED `{database}`.`{name}` `{c}`").filter("info_name = 'num_nulls'").first()
                rows.append(
                    (zone, name, n, c, types[c].dataType.simpleString(), c not in must, column.get("default"),
                     int(nulls[1]) if nulls and nulls[1] != "NULL" else None)
                )
    return spark.createDataFrame(
        rows,
        "zone string, table_name string, ordinal_position int, column_name string, data_type string,"
        " is_nullable boolean, column_default string, n_nulls bigint",
    )


# ---- any frames -----------------------------------------------------------------------------
def table_columns(frames: dict[str, DataFrame]) -> DataFrame:
    """Per column: position, type, rows and NULLs found in the data."""

    def profile(name: str, df: DataFrame) -> DataFrame:
        counts = df.agg(
            F.count("*").alias("n_rows"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(df.columns)]
        )
        described = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f.name).alias("column_name"),
                        F.lit(i + 1).alias("ordinal_position"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col("n_rows"),
                        (F.col("n_rows") - F.col(f"n_{i}")).alias("n_nulls"),
                    )
                    for i, f in enumerate(df.schema)
                ]
            )
        )
        return counts.select(F.lit(name).alias("table_name"), described.alias("c")).select(
            "table_name", "c.*"
        )

    return reduce(DataFrame.unionByName, [profile(n, d) for n, d in frames.items()])
