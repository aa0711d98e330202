"""Delimited shards read line by line, with rows that do not fit told apart from rows that do.

The plain reader takes columns by position: a short row is filled with NULLs, a long one loses fields
and a file with its columns in another order shifts them, all without a word. Here each line keeps its
file and text, and gets a fault or none:

``header``   the file's first line does not name the declared columns in their order (letter case and
             blanks aside); every other line of the file gets this fault, since columns cannot be trusted
``short``    fewer fields than columns
``long``     more fields than columns

Blank lines and lines equal to their file's first line are no rows, and a file of one line has none.
A field whose quote is not closed before the line ends is taken as the plain reader takes it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.lookup import Side, left_lookup
from starloom.specs import Source

FILE, LINE, FAULT = "shard_file", "shard_line", "fault"
HEADER, SHORT, LONG = "header", "short", "long"
_MISFIT = "_misfit"


def _lines(spark: SparkSession, source: Source, folder: str) -> DataFrame:
    """(file, line, whether the split starts the file, position in the task) of every line."""
    pattern = f"{folder}/{source.shards}"
    try:
        texts = spark.read.format("text").load(pattern)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no shard matches {pattern}") from missing
        raise
    line = F.col("value")
    if source.encoding.upper().replace("-", "") != "UTF8":
        line = F.decode(line.cast("binary"), source.encoding)
    return texts.select(
        F.col("_metadata.file_path").alias(FILE),
        line.alias(LINE),
        (F.col("_metadata.file_block_start") == 0).alias("_starts"),
        F.monotonically_increasing_id().alias("_at"),
    )


def headers(spark: SparkSession, source: Source, folder: str) -> DataFrame:
    """(file, its first line, whether that names the declared columns): a row per file that holds a line.

    The lines of a split come in order, so each task keeps one line per file it starts.
    """
    first = _lines(spark, source, folder).where("_starts").groupBy(FILE).agg(F.min_by(LINE, "_at").alias("_first"))
    plain = F.lower(F.regexp_replace(F.regexp_replace("_first", f"[\\uFEFF{source.quote}]", ""), "\\s", ""))
    declared = source.sep.join(c.lower() for c in source.file_schema.names)
    return first.withColumn("_fits", plain == declared)


def _unquoted_fields(source: Source) -> Column:
    """Fields of a line, quoted text left out of the count. It only names the fault of a line that misfits."""
    q = source.quote
    bare = F.regexp_replace(F.col(LINE), f"{q}[^{q}]*+{q}", "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(source.sep), F.lit(""))) + 1


def screened(spark: SparkSession, source: Source, folder: str) -> DataFrame:
    """The declared columns with file, line and fault of every row.

    One pass finds the headers, one reads the rows; headers number as many as files and are broadcast
    while their measured size allows.
    """
    first = headers(spark, source, folder)
    lines = _lines(spark, source, folder).select(FILE, LINE).where(F.length(F.trim(LINE)) > 0)
    rows = left_lookup(lines, Side(first, hot=None), FILE).where(F.col(LINE) != F.col("_first"))
    parsed = T.StructType([*source.file_schema.fields, T.StructField(_MISFIT, T.StringType())])
    options = {"sep": source.sep, "quote": source.quote, "escape": source.escape, "columnNameOfCorruptRecord": _MISFIT}
    fields = F.from_csv(LINE, _ddl(parsed), options)
    rows = rows.withColumn("_row", fields)
    misfit = F.when(_unquoted_fields(source) < len(source.columns), SHORT).otherwise(LONG)
    fault = F.when(~F.col("_fits"), HEADER).when(F.col(f"_row.{_MISFIT}").isNotNull(), misfit)
    return rows.select(*[F.col(f"_row.{c}").alias(c) for c in source.file_schema.names], FILE, LINE, fault.alias(FAULT))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` string" for f in schema.fields)
