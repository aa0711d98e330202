"""Delimited text shards."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.tables import even_tasks, spare_sort
from starloom.specs import Source


def read_shards(spark: SparkSession, source: Source, folder: str) -> DataFrame:
    """All shards under ``folder`` as one all-text frame, columns taken by position.

    Raises FileNotFoundError when no shard matches, before any job runs.
    """
    pattern = f"{folder}/{source.shards}"
    try:
        return (
            spark.read.format("csv")
            .options(header=True, sep=source.sep, quote=source.quote, escape=source.escape, encoding=source.encoding)
            .schema(source.file_schema)
            .load(pattern)
        )
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no shard matches {pattern}") from missing
        raise


def list_shards(spark: SparkSession, source: Source, folder: str) -> DataFrame:
    """The matching shard files with size and age; file contents are not read.

    Raises FileNotFoundError when no shard matches.
    """
    pattern = f"{folder}/{source.shards}"
    try:
        files = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no shard matches {pattern}") from missing
        raise
    return (
        files
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at"))
    )


def write_shards(rows: DataFrame, source: Source, folder: str, gather: bool = True) -> None:
    """Lay rows out as shards, one folder per partition of the source.

    Blanks are kept: the CSV writer would strip them by default. REBALANCE gathers a
    partition's rows into few files and lets AQE split a partition that is too large;
    rows that arrive clustered can do without (``gather=False``).
    """
    shard = F.concat_ws("-", *[F.coalesce(F.col(c), F.lit("none")) for c in source.partition_by])
    _write(rows.select(*source.file_schema.names, shard.alias("shard")), source, folder, gather)


def write_mixed_shards(rows: DataFrame, source: Source, folder: str, n: int) -> None:
    """Lay rows out as ``n`` shards, each with rows of many partitions."""
    texts = rows.select(*source.file_schema.names)
    _write(texts.withColumn("shard", F.pmod(F.xxhash64(*texts.columns), F.lit(n)).cast("string")), source, folder)


def _write(rows: DataFrame, source: Source, folder: str, gather: bool = True) -> None:
    spare_sort(rows.sparkSession)
    even_tasks(rows.sparkSession)
    (
        (rows.hint("rebalance", "shard") if gather else rows)
        .write.format("csv")
        .options(header=True, sep=source.sep, quote=source.quote, escape=source.escape, encoding=source.encoding)
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .partitionBy("shard")
        .mode("overwrite")
        .save(folder)
    )
