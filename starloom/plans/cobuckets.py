"""A fact and its largest dimension stored in the same buckets, so that reading them together shuffles neither.

A dimension too large to broadcast makes every star view and ranking shuffle the fact. Here that
shuffle is paid once per period, when the period is stored: fact rows and members are kept in Spark
bucketed tables with equal bucket counts on the surrogate key, and Spark joins bucket with bucket.

A bucket is read by one task, so a hot key must not sit in one. Keys with more than a quarter of an
average bucket (fewer than four per bucket, by that definition) and the unknown key go to a table of
their own that is not bucketed, and meet their own few members there.

Every run appends a build and then names, in one commit, the periods it stands for. Readers take the
last committed build of each period, so a run that fails or is repeated leaves unread files only.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from starloom.functions.keys import UNKNOWN_KEY
from starloom.operators.lookup import BROADCAST_BYTES, Side, row_bytes
from starloom.operators.star import CoBucketed, Mart
from starloom.plans.loads import Layout, open_mart
from starloom.sources.catalog import _quoted, create_namespace
from starloom.sources.tables import only_periods, read_table, table_exists
from starloom.specs import Dimension

BUILD = "build"
BUCKET_TARGET_BYTES = 512 * 1024 * 1024
HOT_PARTS = 4


class _Paths:
    def __init__(self, layout: Layout, dim: Dimension):
        self.root = f"{layout.root}/gold/{layout.star.fact_table}_cobuckets_{dim.name}"
        self.rows, self.hot_rows, self.hot_keys, self.log = (f"{self.root}/{n}" for n in ("rows", "hot_rows", "hot_keys", "log"))

    def members(self, folder: str) -> str:
        return f"{self.root}/members/{folder}"


def _built(layout: Layout) -> T.StructType:
    return T.StructType([*layout.star.fact_schema.fields, T.StructField(BUILD, T.StringType())])


def _stored(layout: Layout) -> T.StructType:
    """The bucketed fact's columns, those that partition it last."""
    parts, fields = (layout.star.period, BUILD), _built(layout).fields
    return T.StructType([*[f for f in fields if f.name not in parts], *[f for f in fields if f.name in parts]])


def _log_schema(layout: Layout) -> T.StructType:
    period = layout.star.fact_schema[layout.star.period]
    names = [("committed_at", T.TimestampType()), (BUILD, T.StringType()), ("buckets", T.IntegerType()), ("members", T.StringType()), ("version", T.LongType())]
    return T.StructType([*[T.StructField(n, t) for n, t in names], T.StructField("period", period.dataType)])


def _bucketed_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str, key: str, buckets: int, partition_by: Sequence[str] = ()
) -> None:
    """Declare the bucketed table over its files, new ones included."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)}) " if partition_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet {parts}"
        f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION {_quoted(path)}"
    )
    if partition_by and table_exists(spark, path):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def _names(layout: Layout, dim: Dimension, namespace: str) -> tuple[str, str]:
    """Table names that no other warehouse folder of the session shares."""
    mark = uuid.uuid5(uuid.NAMESPACE_URL, layout.root).hex[:12]
    return f"{namespace}.{layout.star.fact_table}_{dim.name}_{mark}", f"{namespace}.{dim.name}_{mark}"


def _log(spark: SparkSession, layout: Layout, paths: _Paths) -> DataFrame | None:
    return read_table(spark, paths.log, _log_schema(layout)) if table_exists(spark, paths.log) else None


def _hot_keys(spark: SparkSession, paths: _Paths, dim: Dimension) -> DataFrame:
    schema = T.StructType([T.StructField(dim.sk, T.LongType()), T.StructField(BUILD, T.StringType())])
    return read_table(spark, paths.hot_keys, schema)


def bucket_count(rows: DataFrame, target: int = BUCKET_TARGET_BYTES) -> int:
    """A power of two with about ``target`` bytes in memory per bucket."""
    size = rows.agg(F.coalesce(F.sum(row_bytes(rows)), F.lit(0))).first()[0]
    return 2 ** max(0, math.ceil(math.log2(max(1, size) / target)))


def store_cobuckets(
    spark: SparkSession,
    layout: Layout,
    dimension: str,
    periods: Sequence[str] | None = None,
    buckets: int | None = None,
    namespace: str = "cobuckets",
    bucket_bytes: int = BUCKET_TARGET_BYTES,
) -> int:
    """Store the fact's ``periods`` (by default all) and the dimension in equal buckets; return the bucket count.

    Members are written again only if the dimension has a new version. The bucket count stays what the
    first run chose; another one, or the first run, stores all periods. An empty fact stores no period.
    ``buckets`` asks for at least so many: a bucket is one task's work, so a fact that is large for them gets more.
    """
    star = layout.star
    dim, paths = star.dimension(dimension), _Paths(layout, star.dimension(dimension))
    create_namespace(spark, namespace, f"{layout.root}/{namespace}")
    log = _log(spark, layout, paths)
    last = log.orderBy(F.desc("committed_at"), F.desc(BUILD)).first() if log is not None else None
    if last is None or buckets is not None:
        buckets = max(buckets or 1, bucket_count(layout.read_fact(spark), bucket_bytes))
    else:
        buckets = last["buckets"]
    if last is None or last["buckets"] != buckets:
        periods = None
    fact_name, dim_name = _names(layout, dim, namespace)

    version = layout.dimensions(spark).last_commit(dim)["version"]
    folder = last["members"] if last and (last["version"], last["buckets"]) == (version, buckets) else f"v{version}-{uuid.uuid4().hex}"
    if last is None or folder != last["members"]:
        _bucketed_table(spark, dim_name, dim.schema, paths.members(folder), dim.sk, buckets)
        layout.dimensions(spark).read(dim).repartition(buckets, dim.sk).write.insertInto(dim_name)

    build = uuid.uuid4().hex
    rows = only_periods(layout.read_fact(spark), star.period, periods)
    counted = rows.groupBy(star.period, dim.sk).agg(F.count(F.lit(1)).alias("_n"))
    per_period = rows.groupBy(star.period).agg(F.count(F.lit(1)).alias("_all"))
    loaded = [r[0] for r in per_period.select(star.period).collect()]  # as many as there are periods
    total = rows.count()
    per_key = counted.groupBy(dim.sk).agg(F.sum("_n").alias("_n"))
    hot = per_key.where((F.col("_n") * (HOT_PARTS * buckets) > total) | (F.col(dim.sk) == UNKNOWN_KEY)).select(dim.sk)
    hot.withColumn(BUILD, F.lit(build)).write.mode("append").partitionBy(BUILD).parquet(paths.hot_keys)
    keys = _hot_keys(spark, paths, dim)
    keys = F.broadcast(keys.where(F.col(BUILD) == build).select(dim.sk))  # fewer than HOT_PARTS * buckets + 1
    stamped = rows.withColumn(BUILD, F.lit(build))

    stamped.join(keys, dim.sk, "left_semi").select(*_built(layout).names).write.mode("append").partitionBy(star.period, BUILD).parquet(paths.hot_rows)
    parts, stored = [star.period, BUILD], _stored(layout)
    _bucketed_table(spark, fact_name, stored, paths.rows, dim.sk, buckets, parts)
    stamped.join(keys, dim.sk, "left_anti").repartition(buckets, dim.sk).select(*stored.names).write.insertInto(fact_name)

    commit = spark.createDataFrame([(build, buckets, folder, version, p) for p in loaded], _log_schema(layout)[1:])
    stamp = commit.select(F.current_timestamp().alias("committed_at"), "*")
    stamp.coalesce(1).write.mode("append").parquet(paths.log)
    return buckets


def _current(log: DataFrame, period: str, buckets: int) -> Column:
    """Rows of each period's last committed build; the list has an entry per period."""
    newest = Window.partitionBy("period").orderBy(F.desc("committed_at"), F.desc(BUILD))
    live = log.where(F.col("buckets") == buckets).withColumn("_rn", F.row_number().over(newest)).where("_rn = 1")
    holds = F.lit(False)
    for row in live.groupBy(BUILD).agg(F.collect_set("period").alias("periods"), F.max(F.col("period").isNull()).alias("nulls")).collect():
        here = F.col(period).isin(row["periods"]) if row["periods"] else F.lit(False)
        if row["nulls"]:
            here = here | F.col(period).isNull()
        holds = holds | ((F.col(BUILD) == row[BUILD]) & F.coalesce(here, F.lit(False)))
    return holds


def open_cobuckets(
    spark: SparkSession, layout: Layout, dimension: str, limit: int = BROADCAST_BYTES, namespace: str = "cobuckets"
) -> Mart:
    """The loaded star whose views and rankings read the stored buckets wherever they need that dimension."""
    star = layout.star
    dim, paths = star.dimension(dimension), _Paths(layout, star.dimension(dimension))
    log = _log(spark, layout, paths)
    if log is None:
        raise FileNotFoundError(f"no buckets of {dimension} are stored")
    last = log.orderBy(F.desc("committed_at"), F.desc(BUILD)).first()
    create_namespace(spark, namespace, f"{layout.root}/{namespace}")
    fact_name, dim_name = _names(layout, dim, namespace)
    parts, stored = [star.period, BUILD], _stored(layout)
    _bucketed_table(spark, fact_name, stored, paths.rows, dim.sk, last["buckets"], parts)
    _bucketed_table(spark, dim_name, dim.schema, paths.members(last["members"]), dim.sk, last["buckets"])
    current = _current(log, star.period, last["buckets"])
    hot_rows = read_table(spark, paths.hot_rows, _built(layout)).where(current).select(*star.fact_schema.names)
    keys = _hot_keys(spark, paths, dim)
    members = spark.table(dim_name)
    hot_members = members.join(keys.select(dim.sk).distinct(), dim.sk, "left_semi")
    co = CoBucketed(
        dim.name,
        spark.table(fact_name).where(current).select(*star.fact_schema.names),
        members,
        hot_rows,
        Side(hot_members),
    )
    mart = open_mart(spark, layout, limit)
    return Mart(mart.star, mart.fact, mart.members, mart.limit, mart.rollups, co)
