"""Run scopes: ingest shards, transform what was ingested, or both.

Every step reads tables and writes tables, so each can be rerun alone and nothing is
computed through more than one step. Partitioned tables are replaced by partition and
dimensions are merged by key: running a step twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.keys import ALL_BITS, surrogate_key
from starloom.operators.clean import clean
from starloom.operators.clustering import clustered, fact_files
from starloom.operators.dimensions import dimension_rows, distinct_members, latest_members
from starloom.operators.fact import fact_rows
from starloom.operators.lookup import BROADCAST_BYTES, HOT_FRACTION, Side, shares_of
from starloom.operators.star import Mart, star_view
from starloom.sources.commits import BUCKET_BYTES, REKEY, DimensionStore
from starloom.sources.delimited import list_shards, read_shards
from starloom.sources.tables import (
    create_if_absent,
    only_periods,
    overwrite_partitions,
    read_table,
    table_exists,
)
from starloom.specs import Dimension, Rollup, Star

SUCCESS, NO_DATA = "success", "no data"


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


#: Per period: rows of every key with over 1/1000 of them, and of the period (name NULL).
HOT_KEYS = _fields(name=T.StringType(), key=T.StringType(), n=T.LongType(), sk=T.LongType())
#: Which dimension versions the fact's periods were built with; a NULL period stands for all of them.
BUILDS = _fields(built_at=T.TimestampType(), period=T.StringType(), dimension=T.StringType(), version=T.LongType())


@dataclass(frozen=True)
class Layout:
    """Paths of one star's tables below a root folder."""

    root: str
    star: Star
    fmt: str = "parquet"
    bucket_bytes: int = BUCKET_BYTES

    @property
    def raw(self) -> str:
        return f"{self.root}/bronze/{self.star.source.raw_table}"

    @property
    def clean(self) -> str:
        return f"{self.root}/silver/{self.star.source.clean_table}"

    @property
    def fact(self) -> str:
        return f"{self.root}/gold/{self.star.fact_table}"

    @property
    def hot_keys(self) -> str:
        return f"{self.root}/gold/{self.star.fact_table}_hot_keys"

    @property
    def hot_keys_schema(self) -> T.StructType:
        return T.StructType([*HOT_KEYS.fields, T.StructField(self.star.period, T.StringType())])

    @property
    def builds(self) -> str:
        return f"{self.root}/gold/{self.star.fact_table}_builds"

    def rollup(self, rollup: Rollup) -> str:
        return f"{self.root}/gold/{self.star.fact_table}_by_{rollup.name}"

    def read_rollup(self, spark: SparkSession, rollup: Rollup) -> DataFrame:
        return read_table(spark, self.rollup(rollup), self.star.rollup_schema(rollup), self.fmt)

    def members(self, dim: Dimension) -> str:
        return f"{self.root}/silver/members_{dim.name}"

    def members_schema(self, dim: Dimension) -> T.StructType:
        names = dict.fromkeys([dim.bk, *dim.attributes, self.star.period])
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    def read_raw(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.raw, self.star.source.raw_schema, self.fmt)

    def read_clean(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.clean, self.star.source.clean_schema, self.fmt)

    def read_fact(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.fact, self.star.fact_schema, self.fmt)

    def dimensions(self, spark: SparkSession) -> DimensionStore:
        return DimensionStore(spark, f"{self.root}/gold", self.fmt, self.bucket_bytes)

    def create_tables(self, spark: SparkSession) -> None:
        """Empty raw, clean and fact tables where there are none, so that steps find something to read."""
        source, star = self.star.source, self.star
        for path, schema in (
            (self.raw, source.raw_schema),
            (self.clean, source.clean_schema),
            (self.fact, star.fact_schema),
        ):
            create_if_absent(spark, path, schema, star.partition_by, self.fmt)


@dataclass(frozen=True)
class StepReport:
    """What one step read and wrote. Counts that do not apply to a step are None."""

    step: str
    target: str
    status: str
    rows_read: int | None = None
    rows_written: int | None = None
    rows_inserted: int | None = None
    rows_updated: int | None = None
    files_loaded: int | None = None
    partition_by: str = ""
    table_schema: str = ""
    rows_rekeyed: int | None = None


REPORT_COLUMNS = (
    "step string, target string, status string, rows_read bigint, rows_written bigint, rows_inserted bigint, "
    "rows_updated bigint, files_loaded bigint, partition_by string, table_schema string, rows_rekeyed bigint"
)


def report_frame(spark: SparkSession, reports: Sequence[StepReport]) -> DataFrame:
    return spark.createDataFrame([astuple(r) for r in reports], REPORT_COLUMNS)


def land(rows: DataFrame, layout: Layout, run_ts: Column | None = None, gather: bool = True) -> StepReport:
    """Raw rows of any origin into the raw table, stamped with the load time."""
    source = layout.star.source
    stamped = rows.withColumn(source.loaded_at, F.current_timestamp() if run_ts is None else run_ts)
    written = overwrite_partitions(
        stamped, layout.raw, source.raw_schema, source.partition_by, layout.fmt, gather
    )
    return StepReport(
        step=source.raw_table,
        target=layout.raw,
        status=SUCCESS,
        rows_written=written,
        partition_by=",".join(source.partition_by),
        table_schema=stamped.schema.simpleString(),
    )


def ingest(
    spark: SparkSession, layout: Layout, shards: str, run_ts: Column | None = None, gather: bool = False
) -> StepReport:
    """Shards into the raw table, in one pass over the text.

    A shard that holds one partition needs no shuffle. ``gather=True`` is for shards that mix
    many: without it every task would write a file for each partition it meets.
    """
    rows = read_shards(spark, layout.star.source, shards)
    files = list_shards(spark, layout.star.source, shards).count()
    return replace(land(rows, layout, run_ts, gather), files_loaded=files)


def clean_step(
    spark: SparkSession,
    layout: Layout,
    run_ts: Column | None = None,
    periods: Sequence[str] | None = None,
) -> StepReport:
    """Raw table to clean table, partition by partition: a map-only job.

    ``periods`` limits the run to those raw partitions; by default everything is redone.
    """
    source = layout.star.source
    raw = only_periods(layout.read_raw(spark), layout.star.period, periods)
    found = raw.count()  # no column is read: answered from file footers
    report = StepReport(source.clean_table, layout.clean, NO_DATA, rows_read=found, rows_written=0)
    if found == 0:
        return report
    rows = clean(raw, source, run_ts)
    written = overwrite_partitions(rows, layout.clean, source.clean_schema, source.partition_by, layout.fmt)
    return replace(
        report,
        status=SUCCESS,
        rows_written=written,
        partition_by=",".join(source.partition_by),
        table_schema=rows.schema.simpleString(),
    )


def refresh_members(
    spark: SparkSession, layout: Layout, dim: Dimension, periods: Sequence[str] | None = None
) -> DataFrame:
    """The members table of one dimension: distinct members per period, ``periods`` of it renewed.

    A table that does not exist yet is built from all periods.
    """
    path, schema, period = layout.members(dim), layout.members_schema(dim), layout.star.period
    if periods is not None and not table_exists(spark, path, layout.fmt):
        periods = None
    seen = distinct_members(only_periods(layout.read_clean(spark), period, periods), dim, period)
    overwrite_partitions(seen.select(*schema.names), path, schema, [period], layout.fmt, gather=True)
    return read_table(spark, path, schema, layout.fmt)


def upsert_dimension(
    spark: SparkSession,
    layout: Layout,
    dim: Dimension,
    run_ts: Column | None = None,
    null_safe: bool = True,
    periods: Sequence[str] | None = None,
) -> StepReport:
    """Merge the members of all periods into one dimension, reading the clean rows of ``periods`` only.

    The latest period wins no matter in which order periods are loaded: what each period says
    of its members is kept in a table of its own, and a run renews the periods it loads there.
    """
    members = latest_members(refresh_members(spark, layout, dim, periods), dim, layout.star.period)
    source = dimension_rows(members, dim, run_ts)
    commit = layout.dimensions(spark).upsert(dim, source, run_ts, null_safe, known_unique=True)
    return StepReport(
        step=dim.name,
        target=commit["path"],
        status=SUCCESS,
        rows_read=commit["rows_source"],
        rows_written=commit["rows_inserted"] + commit["rows_updated"],
        rows_inserted=commit["rows_inserted"],
        rows_updated=commit["rows_updated"],
        rows_rekeyed=commit["rows_rekeyed"],
        table_schema=source.schema.simpleString(),
    )


def upsert_dimensions(
    spark: SparkSession,
    layout: Layout,
    run_ts: Column | None = None,
    null_safe: bool = True,
    periods: Sequence[str] | None = None,
) -> list[StepReport]:
    """All dimensions. They do not depend on one another, so their jobs share the cluster."""
    dims = layout.star.dimensions
    if not dims:
        return []
    with ThreadPoolExecutor(len(dims)) as pool:
        return list(pool.map(lambda dim: upsert_dimension(spark, layout, dim, run_ts, null_safe, periods), dims))


def record_hot_keys(layout: Layout, rows: DataFrame) -> dict[str, dict[str, dict[object, float]]]:
    """Which keys hold over 1/1000 of a period's ``rows`` each, found in one pass and stored beside the fact.

    Only the periods found in ``rows`` are renewed. A key with over 1/1000 of all rows has that share
    of some period too. Hot keys only steer how joins are dealt out: one whose surrogate key has moved
    since it was stored is joined like any other key.
    """
    star, spark = layout.star, rows.sparkSession
    if not star.dimensions:
        return {}
    found = shares_of(rows, {d.name: F.col(d.bk) for d in star.dimensions}, star.period)
    sk = F.lit(None).cast("long")
    for dim in star.dimensions:
        sk = F.when(F.col("name") == dim.name, surrogate_key(F.col("key"), dim.key_bits)).otherwise(sk)
    found = found.withColumn("sk", sk)
    for dim in star.dimensions:
        if dim.key_bits < ALL_BITS:  # else exceptions are too few to be hot
            moved = layout.dimensions(spark).exceptions(dim).select(F.lit(dim.name).alias("_n"), F.col(dim.bk).alias("_bk"), F.col(dim.sk).alias("_moved"))
            joined = found.join(moved, (F.col("name") == F.col("_n")) & (F.col("key") == F.col("_bk")), "left")
            found = joined.withColumn("sk", F.coalesce("_moved", "sk")).drop("_n", "_bk", "_moved")
    schema = layout.hot_keys_schema
    overwrite_partitions(found.select(*schema.names), layout.hot_keys, schema, [star.period], layout.fmt, gather=True)
    return known_hot_keys(spark, layout)


def known_hot_keys(spark: SparkSession, layout: Layout) -> dict[str, dict[str, dict[object, float]]]:
    """The stored hot keys of all periods together: fewer than 1000 per dimension. Empty where no fact was built yet.

    By dimension, then by business and surrogate key.
    """
    if not table_exists(spark, layout.hot_keys, layout.fmt):
        return {}
    out = {d.name: {d.bk: {}, d.sk: {}} for d in layout.star.dimensions}
    stored = read_table(spark, layout.hot_keys, layout.hot_keys_schema, layout.fmt)
    counted = stored.groupBy("name", "key").agg(F.sum("n").alias("n"), F.max("sk").alias("sk"))
    # the total comes first, and keys with over 1/1000 of it number fewer than 1000 per dimension
    first = counted.orderBy(F.col("name").isNotNull(), F.desc("n")).limit(1 + HOT_FRACTION * len(out)).collect()
    total = first[0]["n"] if first and first[0]["name"] is None else 0
    for row in first[1:]:
        if row["n"] * HOT_FRACTION > total:
            dim = layout.star.dimension(row["name"])
            out[dim.name][dim.bk][row["key"]] = out[dim.name][dim.sk][row["sk"]] = row["n"] / total
    return out


def with_hot_keys(
    members: Mapping[str, Side], hot: Mapping[str, Mapping[str, Mapping[object, float]]]
) -> dict[str, Side]:
    return {name: replace(side, hot=hot.get(name)) for name, side in members.items()}


def build_fact(
    spark: SparkSession,
    layout: Layout,
    run_ts: Column | None = None,
    periods: Sequence[str] | None = None,
    limit: int = BROADCAST_BYTES,
    gather: bool | None = None,
) -> StepReport:
    """Clean table and dimensions to the fact table and its rollups.

    Broadcast lookups leave rows in the clean table's partitions, so nothing is shuffled;
    a shuffled lookup scatters them and they are gathered again. ``gather`` overrides
    this, say to write fewer and larger files; a star with ``cluster_by`` has its rows dealt by range. Periods whose surrogate keys have moved since
    they were built are built again, besides ``periods``.
    """
    star, store = layout.star, layout.dimensions(spark)
    if periods is not None:
        periods = sorted({*periods, *stale_periods(spark, layout)})
    rows = only_periods(layout.read_clean(spark), star.period, periods)
    found = rows.count()
    report = StepReport(star.fact_table, layout.fact, NO_DATA, rows_read=found, rows_written=0)
    if found == 0:
        return report
    versions = store.last_commits(star.dimensions) if layout.fmt == "parquet" and star.dimensions else {}
    members = with_hot_keys(store.sides(star.dimensions), record_hot_keys(layout, rows))
    fact = fact_rows(rows, star, members, run_ts, limit)
    if star.cluster_by:
        files = fact_files(found, star.fact_schema, star.partition_by, star.file_bytes)
        fact, gather = clustered(fact, star.partition_by, [star.dimension(d) for d in star.cluster_by], files), False
    if gather is None:
        gather = not all(side.fits(limit) for side in members.values())
    written = overwrite_partitions(fact, layout.fact, star.fact_schema, star.partition_by, layout.fmt, gather)
    refresh_rollups(spark, layout, periods)
    _log_build(spark, layout, {name: last["version"] for name, last in versions.items()}, periods)
    return replace(
        report,
        status=SUCCESS,
        rows_written=written,
        partition_by=",".join(star.partition_by),
        table_schema=fact.schema.simpleString(),
    )


def _log_build(spark: SparkSession, layout: Layout, versions: Mapping[str, int], periods: Sequence[str] | None) -> None:
    if versions:
        built = [(p, d, v) for p in (periods or [None]) for d, v in versions.items()]
        rows = spark.createDataFrame(built, "period string, dimension string, version bigint")
        rows.select(F.current_timestamp().alias("built_at"), "*").coalesce(1).write.mode("append").parquet(layout.builds)


def stale_periods(spark: SparkSession, layout: Layout) -> list[str]:
    """Periods of the fact with a business key whose surrogate key has moved since they were built.

    Nearly always none: the commits say whether a key ever moved. Otherwise the moved keys, a
    handful, are looked up in the clean table's key column.
    """
    star = layout.star
    if layout.fmt != "parquet" or not star.dimensions or not table_exists(spark, layout.builds):
        return []
    store, stale = layout.dimensions(spark), set()
    last = store.last_commits(star.dimensions)
    builds = read_table(spark, layout.builds, BUILDS)
    for dim in star.dimensions:
        if last[dim.name]["rekeyed_in"] is None:
            continue
        moved = store.changes(dim).where(F.col("operation") == REKEY).groupBy(F.col(f"after.{dim.bk}").alias(dim.bk))
        moved = moved.agg(F.max("version").alias("moved_in"))
        rows = layout.read_clean(spark).select(dim.bk, star.period).join(moved, dim.bk)
        held = rows.groupBy(star.period).agg(F.max("moved_in").alias("moved_in")).collect()
        mine = builds.where(F.col("dimension") == dim.name)
        every = mine.where("period is null").agg(F.max("version")).first()[0] or 0
        built = dict(mine.where("period is not null").groupBy("period").agg(F.max("version")).collect())
        stale |= {r[star.period] for r in held if max(every, built.get(r[star.period], 0)) < r["moved_in"]}
    return sorted(p for p in stale if p is not None)


def refresh_rollups(spark: SparkSession, layout: Layout, periods: Sequence[str] | None = None) -> dict[str, int]:
    """The star's rollups of ``periods`` summed anew from the fact, those of other periods left as they are.

    A fact partition is summed inside the tasks that read it; what is shuffled is a row per key set and task.
    """
    star, rows = layout.star, {}
    for rollup in star.rollups:
        schema = star.rollup_schema(rollup)
        fact = only_periods(layout.read_fact(spark), star.period, periods)
        keys = dict.fromkeys([star.period, *rollup.own, *[star.dimension(d).sk for d in rollup.dimensions]])
        sums = [F.sum(m).cast("long").alias(m) for m in star.measures]
        summed = fact.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias("n_rows"))
        rows[rollup.name] = overwrite_partitions(summed, layout.rollup(rollup), schema, [star.period], layout.fmt, gather=True)
    return rows


def transform(
    spark: SparkSession,
    layout: Layout,
    run_ts: Column | None = None,
    periods: Sequence[str] | None = None,
    null_safe: bool = True,
    limit: int = BROADCAST_BYTES,
    gather: bool | None = None,
) -> list[StepReport]:
    """Raw table to clean table, dimensions, fact and rollups.

    ``periods`` limits what is read of the raw and clean tables, and what is written, to those
    partitions. Keys are hashes of business keys, so fact rows of other periods stay valid; where a
    hash was shared and a key had to move, the periods that hold it are built again.
    ``limit`` (bytes up to which a dimension is broadcast) and ``gather`` are ``build_fact``'s.
    """
    cleaned = clean_step(spark, layout, run_ts, periods)
    if cleaned.status == NO_DATA:
        return [cleaned]
    dims = upsert_dimensions(spark, layout, run_ts, null_safe, periods)
    return [cleaned, *dims, build_fact(spark, layout, run_ts, periods, limit, gather)]


def full_load(
    spark: SparkSession,
    layout: Layout,
    shards: str,
    run_ts: Column | None = None,
    null_safe: bool = True,
    limit: int = BROADCAST_BYTES,
    gather: bool = False,
) -> list[StepReport]:
    """Everything: shards to fact. ``gather=True`` is for shards that mix many partitions."""
    loaded = ingest(spark, layout, shards, run_ts, gather)
    return [loaded, *transform(spark, layout, run_ts, None, null_safe, limit)]


def open_mart(spark: SparkSession, layout: Layout, limit: int = BROADCAST_BYTES) -> Mart:
    """The loaded star, ready for views and rankings."""
    members = with_hot_keys(layout.dimensions(spark).sides(layout.star.dimensions), known_hot_keys(spark, layout))
    rollups = {r.name: layout.read_rollup(spark, r) for r in layout.star.rollups if table_exists(spark, layout.rollup(r), layout.fmt)}
    return Mart(layout.star, layout.read_fact(spark), members, limit, rollups)


def publish_views(spark: SparkSession, layout: Layout, prefix: str = "") -> Mart:
    """Temp views over all tables of the star, and the star view itself, for SQL users.

    The fact table and the star view have names of their own. Publish again after a load.
    """
    star, mart = layout.star, open_mart(spark, layout)
    frames = {star.source.raw_table: layout.read_raw(spark), star.source.clean_table: layout.read_clean(spark)}
    frames |= {d.name: mart.members[d.name].frame for d in star.dimensions}
    frames |= {star.fact_table: mart.fact, star.view: star_view(mart)}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(prefix + name)
    return mart
