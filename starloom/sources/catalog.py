"""Namespaces and tables in the session catalog, declared from the same schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_namespace(
    spark: SparkSession,
    name: str,
    location: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> None:
    parts = [f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT {_quoted(comment)} LOCATION {_quoted(location)}"]
    if properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        parts.append(f"WITH DBPROPERTIES ({pairs})")
    spark.sql(" ".join(parts))


def table_ddl(
    name: str,
    schema: T.StructType,
    location: str,
    partition_by: Sequence[str] = (),
    comment: str = "",
    fmt: str = "parquet",
) -> str:
    """CREATE TABLE text with column comments taken from the schema's metadata."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()} COMMENT {_quoted((f.metadata or {}).get('comment', ''))}"
        for f in schema.fields
    )
    partitions = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)}) " if partition_by else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} {partitions}"
        f"LOCATION {_quoted(location)} COMMENT {_quoted(comment)}"
    )


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    partition_by: Sequence[str] = (),
    comment: str = "",
    fmt: str = "parquet",
) -> None:
    spark.sql(table_ddl(name, schema, location, partition_by, comment, fmt))


def reset_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    fresh_location: str,
    partition_by: Sequence[str] = (),
    comment: str = "",
    fmt: str = "parquet",
) -> None:
    """Start a table anew at a location not used before; files of the old one are left alone."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(spark, name, schema, fresh_location, partition_by, comment, fmt)


def reset_bucketed(
    spark: SparkSession, name: str, schema: T.StructType, root: str, folders: Sequence[str], column: str, comment: str = ""
) -> None:
    """A table over folders that need not lie together: each is declared as a partition with its own location."""
    declared = T.StructType([*schema.fields, T.StructField(column, T.IntegerType(), True, {"comment": "Bucket of the key hash"})])
    reset_table(spark, name, declared, root, [column], comment)
    for start in range(0, len(folders), 500):
        parts = [f"PARTITION (`{column}` = {start + i}) LOCATION {_quoted(f)}" for i, f in enumerate(folders[start : start + 500])]
        spark.sql(f"ALTER TABLE {name} ADD " + " ".join(parts))
    spark.catalog.refreshTable(name)


def refresh_table(spark: SparkSession, name: str, partitioned: bool) -> None:
    """Let the catalog see what was written to the table's path."""
    if partitioned:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """Column name, type, comment and whether it partitions the table."""
    rows = [(c.name, c.dataType, c.description, c.isPartition) for c in spark.catalog.listColumns(name)]
    schema = "column_name string, data_type string, comment string, is_partition boolean"
    return spark.createDataFrame(rows, schema)
