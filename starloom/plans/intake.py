"""Ways of taking shards in besides loading a whole folder: with a quarantine, and new shards only."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.plans.loads import Layout, StepReport, land
from starloom.sources.screening import FAULT, FILE, HEADER, LINE, LONG, SHORT, headers, screened
from starloom.sources.tables import create_if_absent, overwrite_partitions, read_table

FAULTS = (HEADER, SHORT, LONG)
SHARD = "shard_digest"


def quarantine_path(layout: Layout) -> str:
    return f"{layout.root}/bronze/{layout.star.source.raw_table}_rejected"


def _quarantine_schema(layout: Layout) -> T.StructType:
    texts = [T.StructField(c, T.StringType()) for c in (FILE, LINE, FAULT, "delivery", SHARD)]
    return T.StructType([*texts, T.StructField(layout.star.loaded_at, T.TimestampType())])


def read_quarantine(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rejected lines with file, fault and delivery; those of each file's last delivery."""
    stored = read_table(spark, quarantine_path(layout), _quarantine_schema(layout))
    return stored.drop(SHARD).where(F.col(FAULT).isNotNull())


def ingest_screened(
    spark: SparkSession, layout: Layout, shards: str, run_ts: Column | None = None, gather: bool = False
) -> tuple[StepReport, dict[str, int]]:
    """Rows that fit into the raw table, all others into the quarantine; returns the count of each fault.

    Good rows replace their partitions as ``ingest`` does. The quarantine has a partition for each file
    with rejects. A file that is delivered again replaces its partition: where nothing of it is rejected
    any more, with a mark that takes the old rejects away. While good rows are written it is only noticed
    whether there are faults; if so, lines are read again for the quarantine.
    """
    schema, delivery, seen = _quarantine_schema(layout), uuid.uuid4().hex, Observation()
    rows = screened(spark, layout.star.source, shards)
    watched = rows.observe(seen, F.max(F.col(FAULT).isNotNull()).alias("faulty"))
    report = land(watched.where(F.col(FAULT).isNull()).drop(FILE, LINE, FAULT), layout, run_ts, gather)
    create_if_absent(spark, quarantine_path(layout), schema, [SHARD])
    stored = read_table(spark, quarantine_path(layout), schema)
    shard = F.substring(F.sha2(F.col(FILE), 256), 1, 32)
    held = [r[0] for r in stored.select(SHARD).distinct().collect()]  # faulty files, fewer than those listed
    if seen.get["faulty"] or held:
        bad = rows.where(F.col(FAULT).isNotNull()).select(FILE, LINE, FAULT)
        none = F.lit(None).cast("string")
        known = spark.createDataFrame([(h,) for h in held], "_held string")
        files = headers(spark, layout.star.source, shards).select(FILE).join(known, shard == F.col("_held"), "left_semi")
        marks = files.select(FILE, none.alias(LINE), none.alias(FAULT))
        stamp = F.current_timestamp() if run_ts is None else run_ts
        out = bad.union(marks).withColumn("delivery", F.lit(delivery)).withColumn(SHARD, shard)
        overwrite_partitions(out.withColumn(layout.star.loaded_at, stamp), quarantine_path(layout), schema, [SHARD], gather=True)
    rejected = read_quarantine(spark, layout).where(F.col("delivery") == delivery).groupBy(FAULT).count()
    faults = dict.fromkeys(FAULTS, 0) | dict(rejected.collect())
    return replace(report, rows_read=report.rows_written + sum(faults.values())), faults


def ingest_new(
    spark: SparkSession,
    layout: Layout,
    shards: str,
    checkpoint: str | None = None,
    run_ts: Column | None = None,
    gather: bool = True,
) -> list[StepReport]:
    """Shards not taken in before, through a file stream that ends once it has seen them all.

    The stream's checkpoint remembers the files. All new shards make one batch, which replaces the
    partitions it holds, so a batch that is repeated after a failure changes nothing. As with
    ``ingest``, a partition comes whole: a shard that brings more rows of a partition loaded by an
    earlier run replaces that partition. Files are known by path; one rewritten in place stays unread.
    """
    source, reports = layout.star.source, []

    def replace_partitions(batch: DataFrame, number: int) -> None:
        seen = Observation()
        watched = batch.observe(seen, F.size(F.collect_set("_file")).alias("files"))
        report = land(watched.drop("_file"), layout, run_ts, gather)
        reports.append(replace(report, files_loaded=seen.get["files"]))

    stream = (
        spark.readStream.format("csv")
        .options(header=True, sep=source.sep, quote=source.quote, escape=source.escape, encoding=source.encoding)
        .schema(source.file_schema)
        .load(f"{shards}/{source.shards}")
        .withColumn("_file", F.col("_metadata.file_path"))
    )
    query = (
        stream.writeStream.foreachBatch(replace_partitions)
        .option("checkpointLocation", checkpoint or f"{layout.root}/bronze/{source.raw_table}_intake")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return reports

