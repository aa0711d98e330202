"""Tables addressed by path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """A write would change the declared schema of a table."""


def lock_schema(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` in declared column order; raises unless names and types match exactly."""
    declared = {f.name: f.dataType.simpleString() for f in schema.fields}
    given = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    if declared != given or len(rows.columns) != len(schema.fields):
        odd = sorted(set(declared.items()) ^ set(given.items()))
        raise SchemaMismatch(f"columns differ from the declared schema: {odd}")
    return rows.select(*schema.names)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table with its declared schema.

    The schema is never inferred: Spark would read the partition value ``202508`` as a
    number and lose leading zeros. An empty-string partition value reads back as NULL.
    """
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        reader = reader.schema(schema)
    return reader.load(path).select(*schema.names)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a table has been written at ``path``."""
    try:
        spark.read.format(fmt).schema("_any string").load(path) if fmt == "parquet" else spark.read.format(fmt).load(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "DELTA_TABLE_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE"):
            return False
        raise
    return True


#: Files one task keeps open while it writes to many folders; rows of further folders are sorted first.
OPEN_FILES = "64"


def spare_sort(spark: SparkSession) -> None:
    """Write rows to the folders they belong to as they come, unless the session says how.

    By default a task sorts all its rows by folder first. A scan task holds some ten million rows of a
    well compressed table, whose whole texts then spill; open files hold them encoded.
    """
    if spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0":
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)


#: Tasks of a large step for each core: with as few tasks as cores, most cores wait for the longest one.
TASKS_PER_CORE = 4


def even_tasks(spark: SparkSession) -> None:
    """Deal scans and gathered rows to several tasks a core, unless the session says how many.

    Spark aims at one task a core, up to 128 MB of a file, which is some ten million rows of a well
    compressed table. Small files and shuffles stay together as before: 4 MB and 1 MB at least.
    """
    wanted = str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    for name in ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum"):
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, wanted)


def create_if_absent(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """An empty table with the declared schema, unless the path already holds one."""
    empty = spark.createDataFrame([], schema).write.format(fmt).mode("ignore")
    (empty.partitionBy(*partition_by) if partition_by else empty).save(path)


def only_periods(rows: DataFrame, period: str, periods: Sequence[str] | None) -> DataFrame:
    """Keep the given periods; on a table partitioned by period this prunes the scan.

    Blanks around a raw period are ignored, as cleaning will remove them: a clean
    partition must never be replaced by part of the raw rows that belong to it.
    """
    return rows if periods is None else rows.where(F.trim(F.col(period)).isin(list(periods)))


def overwrite_partitions(
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    fmt: str = "parquet",
    gather: bool = False,
) -> int:
    """Replace exactly the partitions present in ``rows``; return the rows written.

    Rows that already arrive clustered (one shard or one table partition per scan task)
    are written without any shuffle. ``gather=True`` is for scattered rows: REBALANCE
    brings each partition into few files, and AQE splits a partition that holds a large
    share of all rows over several tasks instead of giving it to one.

    The count rides on the write. It is taken in the last stage, where a task's metrics
    are counted once even if executors are lost and earlier stages run again.
    """
    out = lock_schema(rows, schema)
    if gather:
        out = out.hint("rebalance", *partition_by)
    spare_sort(rows.sparkSession)
    even_tasks(rows.sparkSession)
    seen = Observation()
    (
        out.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("overwriteSchema", "false")
        .partitionBy(*partition_by)
        .save(path)
    )
    return seen.get["rows"]
