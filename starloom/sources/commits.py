"""Dimension tables in versions, kept in buckets by key hash, and the log of their commits.

A commit names a folder for each bucket of a dimension. A merge first finds the rows it inserts and
changes, which is a join and writes those rows only; then it writes anew the buckets they fall in, to
folders of its own, and takes over the other buckets' folders from the commit before. A merge that
changes nothing writes no bucket. A version becomes current when its commit is appended to the log; a
run that dies before that leaves the previous version current. One writer per dimension.

The rows a merge inserts or changes stay beside it as a change feed: before and after images with
operation and version. Replaying the feed gives any version.

Surrogate keys are hashes of business keys. Where several business keys share one, all but the
smallest get a probed key (``operators.probing``); the exceptions are kept with the commit. A key that has
to move because a smaller business key came later is a change with operation ``rekey``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import surrogate_key
from starloom.operators.dimensions import FROM_SOURCE, INSERTED, UPDATED, changes_type1, merge_statement, require_unique
from starloom.operators.lookup import Side, row_bytes
from starloom.operators.probing import final_key, moved_keys, shared_keys
from starloom.sources.tables import create_if_absent, read_table
from starloom.specs import Dimension

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("rows_source", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("rows_rekeyed", T.LongType()),
        T.StructField("rows_total", T.LongType()),
        T.StructField("bytes_total", T.LongType()),
        T.StructField("buckets_rewritten", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("path", T.StringType()),
        T.StructField("buckets", T.ArrayType(T.StringType())),
        T.StructField("changes", T.StringType()),
        T.StructField("exceptions", T.StringType()),
        T.StructField("rekeyed_in", T.LongType()),
    ]
)
#: Bytes of members (as ``row_bytes`` counts them) that a bucket holds on average before there are more.
BUCKET_BYTES = 64 * 1024 * 1024
BUCKET = "key_bucket"
INSERT, UPDATE, REKEY = "insert", "update", "rekey"


def bucket_of(bk: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(bk), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class DimensionStore:
    """Where the versions of all dimensions of one star live.

    ``fmt="parquet"`` keeps versions and a log as described above. Any other format is
    taken to support MERGE and table history itself, as Delta does. ``bucket_bytes`` sets into
    how many buckets a growing dimension is cut; their number doubles, never shrinks.
    """

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    bucket_bytes: int = BUCKET_BYTES

    def _log_path(self, dim: Dimension) -> str:
        return f"{self.root}/{dim.name}/commits"

    def log(self, dim: Dimension) -> DataFrame:
        """Every commit of one dimension."""
        return read_table(self.spark, self._log_path(dim), COMMIT_SCHEMA)

    def last_commit(self, dim: Dimension) -> Row | None:
        return self.log(dim).agg(F.max_by(F.struct("*"), "version").alias("last")).first()["last"]

    def last_commits(self, dims: Sequence[Dimension]) -> dict[str, Row]:
        """The last commit of each dimension, one row per dimension, in one job."""
        logs = self.spark.read.schema(COMMIT_SCHEMA).parquet(*[self._log_path(d) for d in dims])
        last = logs.groupBy("table_name").agg(F.max_by(F.struct("*"), "version").alias("last"))
        return {row["table_name"]: row["last"] for row in last.collect()}

    def locations(self, dim: Dimension) -> list[str]:
        """Folders of the current version's buckets, in order."""
        return list(self.last_commit(dim)["buckets"]) if self.fmt == "parquet" else [f"{self.root}/{dim.name}"]

    def _rows(self, dim: Dimension, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], dim.schema)
        return self.spark.read.schema(dim.schema).parquet(*folders).select(*dim.columns)

    def sides(self, dims: Sequence[Dimension]) -> dict[str, Side]:
        """The current versions by name, with their sizes as known from the commits."""
        if self.fmt != "parquet":
            return {d.name: Side(read_table(self.spark, f"{self.root}/{d.name}", d.schema, self.fmt)) for d in dims}
        last = self.last_commits(dims)
        return {d.name: Side(self._rows(d, last[d.name]["buckets"]), last[d.name]["bytes_total"]) for d in dims}

    def read(self, dim: Dimension, version: int | None = None) -> DataFrame:
        """The current version of one dimension, or an earlier one."""
        if version is None or self.fmt != "parquet":
            return self.sides([dim])[dim.name].frame
        return self._rows(dim, self.log(dim).where(F.col("version") == version).first()["buckets"])

    def exceptions(self, dim: Dimension) -> DataFrame:
        """(bk, sk, probe): the business keys whose surrogate key is not their plain hash."""
        schema = T.StructType([*(dim.schema[c] for c in (dim.bk, dim.sk)), T.StructField("probe", T.IntegerType())])
        last = self.last_commit(dim) if self.fmt == "parquet" else None
        if last is None or last["exceptions"] is None:
            return self.spark.createDataFrame([], schema)
        return read_table(self.spark, last["exceptions"], schema)

    def changes(self, dim: Dimension) -> DataFrame:
        """The change feed: version, operation, and the row before and after, of all versions."""
        schema = _feed_schema(dim)
        feeds = self.spark.createDataFrame([], T.StructType([T.StructField("version", T.LongType()), *schema.fields]))
        row = T.StructType([T.StructField(c, dim.schema[c].dataType) for c in dim.columns])
        for commit in self.log(dim).select("version", "changes", "buckets").orderBy("version").collect():
            if commit["changes"] is not None:
                rows = read_table(self.spark, commit["changes"], schema)
            elif commit["version"] == 1:  # everything a first version holds was inserted by it
                rows = self._rows(dim, commit["buckets"]).select(
                    F.lit(INSERT).alias("operation"), F.lit(None).cast(row).alias("before"), F.struct(*dim.columns).alias("after")
                )
            else:
                continue
            feeds = feeds.union(rows.select(F.lit(commit["version"]).cast("long").alias("version"), "operation", "before", "after"))
        return feeds

    def replayed(self, dim: Dimension, version: int) -> DataFrame:
        """The rows of a version, from the feed alone: the last image of every business key (of NULL, every one)."""
        feed = self.changes(dim).where(F.col("version") <= version)
        key = F.col(f"after.{dim.bk}")
        apart = F.when(key.isNull(), F.col(f"after.{dim.created_at}"))
        order = F.struct("version", (F.col("operation") == REKEY).alias("late"))
        last = feed.groupBy(key.alias("_bk"), apart.alias("_apart")).agg(F.max_by("after", order).alias("row"))
        return last.select("row.*")

    def upsert(
        self,
        dim: Dimension,
        source: DataFrame,
        run_ts: Column | None = None,
        null_safe: bool = True,
        known_unique: bool = False,
    ) -> Row:
        """Merge ``source`` into the dimension, creating it if need be; return the commit.

        Fails without a commit when a business key repeats in ``source``; ``known_unique``
        says that it cannot and spares the check.
        """
        if not known_unique:
            source = require_unique(source, dim)
        if self.fmt != "parquet":
            return self._upsert_in_place(dim, source, null_safe)
        create_if_absent(self.spark, self._log_path(dim), COMMIT_SCHEMA)
        last = self.last_commit(dim)
        if last is None:
            return self._first(dim, source, run_ts)
        return self._next(dim, source, last, run_ts, null_safe)

    # --- the steps of a merge

    def _folder(self, dim: Dimension, label: str) -> str:
        """A folder of this attempt alone: what a run that died left behind is never in the way."""
        return f"{self.root}/{dim.name}/{label}-{uuid4().hex[:12]}"

    def _stored(self, dim: Dimension):
        def stored(rows: DataFrame, label: str) -> DataFrame:
            folder = self._folder(dim, f"work-{label}")
            rows.write.parquet(folder)
            return self.spark.read.schema(rows.schema).parquet(folder)

        return stored

    def _write_buckets(self, dim: Dimension, rows: DataFrame, version: int, buckets: int, seen: Observation | None = None) -> dict[int, str]:
        """``rows`` written by bucket; the folder of each. The rows of a bucket must all be there."""
        path = self._folder(dim, f"version={version}")
        out = rows.select(*dim.columns)
        if seen is not None:
            size = F.coalesce(F.sum(row_bytes(out)), F.lit(0))
            out = out.observe(seen, F.count(F.lit(1)).alias("rows_total"), size.alias("bytes_total"))
        if buckets == 1:
            out.write.parquet(f"{path}/{BUCKET}=0")
        else:
            keyed = out.withColumn(BUCKET, bucket_of(dim.bk, buckets)).hint("rebalance", BUCKET)
            keyed.write.partitionBy(BUCKET).parquet(path)
        return {b: f"{path}/{BUCKET}={b}" for b in range(buckets)}

    def _first(self, dim: Dimension, source: DataFrame, run_ts: Column | None) -> Row:
        seen = Observation()
        folders = self._write_buckets(dim, source, 1, 1, seen)
        entry = {"rows_rekeyed": 0, "exceptions": None, **seen.get}
        rows = self._rows(dim, [folders[0]])
        if not shared_keys(rows, dim.bk, dim.sk).isEmpty():
            entry["exceptions"] = self._resolved(dim, rows)
            folders = self._write_buckets(dim, self._with_final_keys(dim, rows, entry["exceptions"]), 1, 1)
        n = entry["rows_total"]
        entry |= {"rows_source": n, "rows_inserted": n, "rows_updated": 0, "buckets_rewritten": 1, "changes": None, "rekeyed_in": None}
        return self._commit(dim, {"version": 1, "path": folders[0], "buckets": [folders[0]], **entry}, run_ts)

    def _next(self, dim: Dimension, source: DataFrame, last: Row, run_ts: Column | None, null_safe: bool) -> Row:
        version, target = last["version"] + 1, self._rows(dim, last["buckets"])
        flagged = changes_type1(target, source, dim, run_ts, null_safe)
        inserted, updated = F.col(INSERTED), F.col(UPDATED)
        grown = F.when(inserted | updated, _bytes(dim, "after")).otherwise(0) - F.when(updated, _bytes(dim, "before")).otherwise(0)
        seen, feed = Observation(), self._folder(dim, f"changes={version}")
        observed = flagged.observe(
            seen,
            F.count_if(FROM_SOURCE).alias("rows_source"),
            F.count_if(inserted).alias("rows_inserted"),
            F.count_if(updated).alias("rows_updated"),
            F.coalesce(F.sum(grown), F.lit(0)).alias("grown"),
        )
        operation = F.when(inserted, INSERT).otherwise(UPDATE).alias("operation")
        observed.where(inserted | updated).select(operation, "before", "after").write.parquet(feed)
        counts = dict(seen.get)
        grown_by = counts.pop("grown")
        entry = {
            **counts, "version": version, "rows_rekeyed": 0, "rows_total": last["rows_total"] + counts["rows_inserted"],
            "bytes_total": last["bytes_total"] + grown_by, "buckets_rewritten": 0, "path": last["path"], "buckets": list(last["buckets"]),
            "changes": None, "exceptions": last["exceptions"], "rekeyed_in": last["rekeyed_in"],
        }
        if not counts["rows_inserted"] and not counts["rows_updated"]:
            return self._commit(dim, entry, run_ts)
        changes = read_table(self.spark, feed, _feed_schema(dim))
        if counts["rows_inserted"] and self._must_resolve(dim, target, changes, last):
            feed, entry["exceptions"], entry["rows_rekeyed"] = self._rekeyed(dim, target, changes, version, run_ts)
            changes = read_table(self.spark, feed, _feed_schema(dim))
            entry["rekeyed_in"] = version if entry["rows_rekeyed"] else entry["rekeyed_in"]
        entry["changes"] = feed
        return self._commit(dim, entry | self._rewritten(dim, last, changes, entry, null_safe), run_ts)

    def _rewritten(self, dim: Dimension, last: Row, changes: DataFrame, entry: dict, null_safe: bool) -> dict:
        """The buckets that ``changes`` fall in, written anew; all of them when there have to be more."""
        buckets, folders = len(last["buckets"]), list(last["buckets"])
        wanted = 2 ** math.ceil(math.log2(max(1, entry["bytes_total"] / self.bucket_bytes)))
        grows = wanted > buckets
        buckets = max(buckets, wanted)
        after = changes.select("operation", "after.*")
        # of a row that was updated and got another key, the image with that key is the last
        order = F.col("operation") == REKEY
        if entry["rows_rekeyed"]:
            twice = after.where(~order).join(after.where(order).select(dim.bk), dim.bk, "left_anti")
            after = twice.unionByName(after.where(order))
        after = after.withColumn(BUCKET, bucket_of(dim.bk, buckets))
        touched = range(buckets) if grows else sorted(r[0] for r in after.select(BUCKET).distinct().collect())
        old = self._rows(dim, folders if grows else [folders[b] for b in touched])
        gone = changes.where(F.col("before").isNotNull()).select(F.col(f"before.{dim.bk}").alias("_gone")).distinct()
        same = F.col(dim.bk).eqNullSafe(F.col("_gone")) if null_safe else F.col(dim.bk) == F.col("_gone")
        kept = old.join(gone, same, "left_anti")
        written = self._write_buckets(dim, kept.unionByName(after.select(*dim.columns)), entry["version"], buckets)
        new = [written[b] if b in touched else folders[b] for b in range(buckets)]
        if grows:  # a bucket without rows has no folder, which no reader would accept
            root = written[0].removesuffix(f"/{BUCKET}=0")
            filled = {r[0] for r in self.spark.read.parquet(root).select(BUCKET).distinct().collect()}
            for b in set(touched) - filled:
                create_if_absent(self.spark, new[b], dim.schema)
        return {"buckets": new, "buckets_rewritten": len(touched), "path": written[touched[0]]}

    def _must_resolve(self, dim: Dimension, target: DataFrame, changes: DataFrame, last: Row) -> bool:
        """Whether a key is shared, or may now be free for one that had to move."""
        if last["exceptions"] is not None:
            return True
        new = changes.where(F.col("operation") == INSERT).select(f"after.{dim.bk}", f"after.{dim.sk}")
        return not shared_keys(target.select(dim.bk, dim.sk).union(new), dim.bk, dim.sk).isEmpty()

    def _resolved(self, dim: Dimension, rows: DataFrame) -> str | None:
        """The path of the exceptions among all ``rows``, None without any."""
        members = self._stored(dim)(rows.select(dim.bk).distinct(), "members")
        moved = moved_keys(members.withColumn(dim.sk, F.lit(0).cast("long")), dim.bk, dim.sk, self._stored(dim), dim.key_bits)
        if moved.isEmpty():
            return None
        path = self._folder(dim, "exceptions")
        moved.write.parquet(path)
        return path

    def _with_final_keys(self, dim: Dimension, rows: DataFrame, exceptions: str | None) -> DataFrame:
        if exceptions is None:
            return rows.withColumn(dim.sk, surrogate_key(F.col(dim.bk), dim.key_bits))
        moved = self.spark.read.parquet(exceptions).select(F.col(dim.bk).alias("_bk"), F.col(dim.sk).alias("_moved"))
        joined = rows.join(moved, F.col(dim.bk) == F.col("_bk"), "left")
        return joined.withColumn(dim.sk, final_key(dim.bk, "_moved", dim.key_bits)).select(*rows.columns)

    def _rekeyed(self, dim: Dimension, target: DataFrame, changes: DataFrame, version: int, run_ts: Column | None) -> tuple[str, str | None, int]:
        """Changes with final keys, and those of rows whose key moves: path of the feed, of the exceptions, rows moved."""
        now = F.current_timestamp() if run_ts is None else run_ts
        new = changes.where(F.col("operation") == INSERT).select("after.*")
        exceptions = self._resolved(dim, target.select(dim.bk).union(new.select(dim.bk)))
        inserts = self._with_final_keys(dim, new, exceptions).select(
            F.lit(INSERT).alias("operation"), F.lit(None).cast(_row_type(dim)).alias("before"), F.struct(*dim.columns).alias("after")
        )
        updates = changes.where(F.col("operation") == UPDATE).select("operation", "before", "after")
        # a row that this merge updates moves from its new image
        images = updates.select(F.col(f"before.{dim.bk}").alias("_key"), F.col("after").alias("_image"))
        current = target.join(images, F.col(dim.bk).eqNullSafe(F.col("_key")), "left")
        current = current.select(*[F.when(F.col("_image").isNotNull(), F.col(f"_image.{c}")).otherwise(F.col(c)).alias(c) for c in dim.columns])
        final = self._with_final_keys(dim, current.withColumn("_old", F.struct(*dim.columns)), exceptions)
        moved = final.where(F.col(dim.sk) != F.col(f"_old.{dim.sk}")).withColumn(dim.updated_at, now)
        moved = self._stored(dim)(moved.select(F.lit(REKEY).alias("operation"), F.col("_old").alias("before"), F.struct(*dim.columns).alias("after")), "moved")
        feed = self._folder(dim, f"changes={version}")
        schema = _feed_schema(dim)
        inserts.union(updates).union(moved).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.parquet(feed)
        return feed, exceptions, moved.count()

    def _commit(self, dim: Dimension, entry: dict, run_ts: Column | None = None) -> Row:
        entry = {"table_name": dim.name, "operation": "MERGE", **entry}
        plain = [f for f in COMMIT_SCHEMA.fields if f.name != "committed_at"]
        row = self.spark.createDataFrame([tuple(entry[f.name] for f in plain)], T.StructType(plain))
        now = F.current_timestamp() if run_ts is None else run_ts
        stamped = row.withColumn("committed_at", now.cast("timestamp")).select(*COMMIT_SCHEMA.names)
        stamped.coalesce(1).write.mode("append").parquet(self._log_path(dim))
        return Row(**entry)

    def _upsert_in_place(self, dim: Dimension, source: DataFrame, null_safe: bool) -> Row:
        path = f"{self.root}/{dim.name}"
        create_if_absent(self.spark, path, dim.schema, fmt=self.fmt)
        view = f"merge_source_{dim.name}"
        source.createOrReplaceTempView(view)
        target = f"{self.fmt}.`{path}`"
        self.spark.sql(merge_statement(dim, target, view, null_safe))
        last = self.spark.sql(f"DESCRIBE HISTORY {target}").orderBy(F.desc("version")).first()
        metrics = last["operationMetrics"]
        return Row(
            table_name=dim.name,
            version=last["version"],
            operation=last["operation"],
            path=path,
            rows_source=int(metrics.get("numSourceRows", 0)),
            rows_inserted=int(metrics.get("numTargetRowsInserted", 0)),
            rows_updated=int(metrics.get("numTargetRowsUpdated", 0)),
            rows_rekeyed=0,
        )


def _row_type(dim: Dimension) -> T.StructType:
    return T.StructType([T.StructField(c, dim.schema[c].dataType) for c in dim.columns])


def _feed_schema(dim: Dimension) -> T.StructType:
    row = _row_type(dim)
    return T.StructType([T.StructField("operation", T.StringType()), T.StructField("before", row), T.StructField("after", row)])


def _bytes(dim: Dimension, image: str) -> Column:
    """``row_bytes`` of an image."""
    texts = [F.col(f"{image}.{f.name}") for f in dim.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = F.lit(16 * len(dim.columns)).cast("long")
    return sum((F.coalesce(F.octet_length(t), F.lit(0)).cast("long") for t in texts), fixed)
