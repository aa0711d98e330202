"""Places in a global order without a window over all rows in one task.

Rows are dealt out by range of the measure and their other columns, so that even many rows with one
total spread. Each range numbers its own rows; a row per range says how many rows and different totals
it holds and where the ties at its ends begin, and running sums over those few rows shift the numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Stored = Callable[[DataFrame, str], DataFrame]


def numbered(rows: DataFrame, total: str, ties: Sequence[str], stored: Stored, ranges: int | None = None) -> DataFrame:
    """``rows`` with place (by ``total``, greatest first, then ``ties``), rank, dense_rank and share of the sum.

    NULL totals come last and are equal to one another. The share of a NULL total is NULL.
    ``stored`` writes a table and reads it back.
    """
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc_nulls_last(total), *[F.asc_nulls_last(c) for c in ties]]
    dealt = rows.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range").orderBy(*order)
    level = Window.partitionBy("_range").orderBy(F.desc_nulls_last(total))
    own = dealt.select(
        "*", F.row_number().over(inside).alias("_place"), F.rank().over(level).alias("_rank"), F.dense_rank().over(level).alias("_dense")
    )
    own = stored(own, "ranges")

    # one row per range, in the order of ranges
    first, last = F.min_by(F.struct(total), "_place"), F.max_by(F.struct(total), "_place")
    ends = own.groupBy("_range").agg(
        F.count(F.lit(1)).alias("n"), F.max("_dense").alias("levels"), F.max("_rank").alias("last_rank"), F.sum(total).alias("part"),
        first.alias("first"), last.alias("last"),
    )
    along = Window.orderBy("_range")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("goes_on", F.coalesce(F.lag("last").over(along).eqNullSafe(F.col("first")) & (F.lag("n").over(along) > 0), F.lit(False)))
    ends = ends.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    levels = F.col("levels") - F.col("goes_on").cast("int")
    ends = ends.withColumn("levels_before", F.coalesce(F.sum(levels).over(earlier), F.lit(0)) - F.col("goes_on").cast("int"))
    # where the tie at a range's end begins, if it begins in that range
    begins = F.when((F.col("levels") > 1) | ~F.col("goes_on"), F.col("before") + F.col("last_rank"))
    ends = ends.withColumn("tie_rank", F.last(begins, ignorenulls=True).over(earlier)).withColumn("all", F.sum("part").over(Window.partitionBy()))
    ends = ends.select("_range", "before", "levels_before", "goes_on", "tie_rank", "all")
    found = own.join(F.broadcast(ends), "_range")  # as many rows as ranges
    rank = F.when(F.col("goes_on") & (F.col("_dense") == 1), F.col("tie_rank")).otherwise(F.col("before") + F.col("_rank"))
    return found.select(
        *rows.columns,
        (F.col("before") + F.col("_place")).alias("place"),
        rank.alias("rank"),
        (F.col("levels_before") + F.col("_dense")).alias("dense_rank"),
        (F.col(total) / F.col("all")).alias("share"),
    )
