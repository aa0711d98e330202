"""Dimension rows and their type-1 upsert."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import surrogate_key
from starloom.specs import Dimension

INSERTED, UPDATED, FROM_SOURCE = "_inserted", "_updated", "_from_source"


def distinct_members(rows: DataFrame, dim: Dimension, period: str) -> DataFrame:
    """Every member as each period shows it, once.

    The test on the count is always true; without it Catalyst drops the aggregate below
    another one as redundant.
    """
    names = dict.fromkeys([dim.bk, *dim.attributes, period])
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 0").drop("_rows")


def latest_members(rows: DataFrame, dim: Dimension, period: str) -> DataFrame:
    """One row per business key: the latest period wins, then the greatest attributes.

    Rows are first reduced to distinct members per period: a hash aggregate inside each
    scan task that cuts a key holding a third of all rows down to a few rows per task
    before anything is shuffled. Only those reach the maximum over structs, which Spark
    can only compute by sorting. NULL is a key like any other here.
    """
    seen = distinct_members(rows, dim, period)
    best = F.max(F.struct(F.col(period).alias("_period"), *dim.attributes)).alias("_best")
    return seen.groupBy(dim.bk).agg(best).select(dim.bk, *[F.col(f"_best.{a}").alias(a) for a in dim.attributes])


def dimension_rows(members: DataFrame, dim: Dimension, run_ts: Column | None = None) -> DataFrame:
    """Members with surrogate key and audit timestamps, in the dimension's column order."""
    now = F.current_timestamp() if run_ts is None else run_ts
    return members.select(
        surrogate_key(F.col(dim.bk), dim.key_bits).alias(dim.sk),
        dim.bk,
        *dim.attributes,
        now.alias(dim.created_at),
        now.alias(dim.updated_at),
    )


def require_unique(rows: DataFrame, dim: Dimension) -> DataFrame:
    """The same rows, failing at run time when a business key repeats.

    A grouped count with map-side combine: no task ever holds all copies of a key.
    """
    others = [c for c in rows.columns if c != dim.bk]
    return (
        rows.groupBy(dim.bk)
        .agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(*others)).alias("_row"))
        .where(F.assert_true(F.col("_n") == 1, f"{dim.name}: {dim.bk} repeats in the merge source").isNull())
        .select(*[F.col(dim.bk) if c == dim.bk else F.col(f"_row.{c}").alias(c) for c in rows.columns])
    )


def _matches(name: str, null_safe: bool) -> Column:
    old, new = F.col(f"t.{name}"), F.col(f"s.{name}")
    return old.eqNullSafe(new) if null_safe else old == new


def changes_type1(
    target: DataFrame,
    source: DataFrame,
    dim: Dimension,
    run_ts: Column | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """What upserting ``source`` does: a row per source row, flagged, with its image before and after.

    Matched rows keep surrogate key and creation time; attributes and update time change
    only when an attribute differs. Unmatched source rows are inserted as they are. Target
    rows without a source row stay and do not show. ``source`` must not repeat a business key.

    ``null_safe=False`` uses plain SQL comparison throughout: a NULL key matches nothing, so
    each run inserts it again, and NULL on one side of an attribute is no change.
    """
    now = F.current_timestamp() if run_ts is None else run_ts
    t = target.select(F.struct(*dim.columns).alias("t"))
    s = source.select(F.struct(*dim.columns).alias("s"))
    # Whether the target took part is told by its struct, which is NULL only for a missing side.
    joined = s.join(t, _matches(dim.bk, null_safe), "left")
    in_target = F.col("t").isNotNull()
    differs = reduce(or_, [~_matches(a, null_safe) for a in dim.attributes])

    def changed(name: str) -> Column:
        if name == dim.updated_at:
            return now.cast("timestamp").alias(name)
        return F.col(f"s.{name}" if name in dim.attributes else f"t.{name}").alias(name)

    after = F.when(in_target, F.struct(*[changed(c) for c in dim.columns])).otherwise(F.col("s"))
    return joined.select(
        F.col("t").alias("before"),
        after.alias("after"),
        (~in_target).alias(INSERTED),
        F.coalesce(in_target & differs, F.lit(False)).alias(UPDATED),
        F.lit(True).alias(FROM_SOURCE),
    )


def merge_type1(
    target: DataFrame,
    source: DataFrame,
    dim: Dimension,
    run_ts: Column | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """The whole dimension after upserting ``source`` as ``changes_type1`` says, with its flags on each row."""
    now = F.current_timestamp() if run_ts is None else run_ts
    t = target.select(F.struct(*dim.columns).alias("t"))
    s = source.select(F.struct(*dim.columns).alias("s"))
    joined = t.join(s, _matches(dim.bk, null_safe), "full_outer")
    in_target, in_source = F.col("t").isNotNull(), F.col("s").isNotNull()
    differs = reduce(or_, [~_matches(a, null_safe) for a in dim.attributes])
    flagged = joined.select(
        "t",
        "s",
        (~in_target).alias(INSERTED),
        F.coalesce(in_target & in_source & differs, F.lit(False)).alias(UPDATED),
        in_source.alias(FROM_SOURCE),
    )
    inserted, updated = F.col(INSERTED), F.col(UPDATED)

    def pick(name: str) -> Column:
        old, new = F.col(f"t.{name}"), F.col(f"s.{name}")
        if name == dim.updated_at:
            return F.when(inserted, new).when(updated, now).otherwise(old)
        takes_new = inserted | updated if name in dim.attributes else inserted
        return F.when(takes_new, new).otherwise(old)

    return flagged.select(*[pick(c).alias(c) for c in dim.columns], INSERTED, UPDATED, FROM_SOURCE)


def merge_statement(dim: Dimension, target: str, source: str, null_safe: bool = True) -> str:
    """The same upsert as MERGE text, for table formats that take row-level changes."""
    same = "<=>" if null_safe else "="
    differs = " OR ".join(
        f"NOT (t.`{a}` <=> s.`{a}`)" if null_safe else f"t.`{a}` <> s.`{a}`" for a in dim.attributes
    )
    changes = ", ".join(
        [f"t.`{a}` = s.`{a}`" for a in dim.attributes] + [f"t.`{dim.updated_at}` = s.`{dim.updated_at}`"]
    )
    return (
        f"MERGE INTO {target} t USING {source} s ON t.`{dim.bk}` {same} s.`{dim.bk}` "
        f"WHEN MATCHED AND ({differs}) THEN UPDATE SET {changes} "
        f"WHEN NOT MATCHED THEN INSERT *"
    )
