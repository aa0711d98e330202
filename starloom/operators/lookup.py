"""Left join of many rows to one dimension-sized table, whatever size that turns out to be."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_FRACTION = 1000
PARTS_PER_PARTITION = 4
FIXED_WIDTH = 16


def row_bytes(frame: DataFrame) -> Column:
    """Size of a row in memory: the length of its texts plus a fixed width per column."""
    texts = [F.octet_length(f.name) for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
    lengths = [F.coalesce(n, F.lit(0)).cast("long") for n in texts]
    return sum(lengths, F.lit(FIXED_WIDTH * len(frame.columns)).cast("long"))


def measured_bytes(frame: DataFrame) -> int:
    return frame.agg(F.coalesce(F.sum(row_bytes(frame)), F.lit(0))).first()[0]


@dataclass(frozen=True)
class Side:
    """The small side of a lookup, its size, and the hot keys of the rows it is joined to.

    ``hot`` holds shares by key column. What is not known is measured when a plan needs it,
    with a job of its own.
    """

    frame: DataFrame
    size: int | None = None
    hot: Mapping[str, Mapping[object, float]] | None = None

    def select(self, *columns: str) -> Side:
        return Side(self.frame.select(*columns), self.size, self.hot)

    def fits(self, limit: int) -> bool:
        size = measured_bytes(self.frame) if self.size is None else self.size
        return size <= limit


def hot_keys(rows: DataFrame, key: str) -> dict[object, float]:
    """Share of all rows per key, for keys with more than 1/1000: by that definition fewer than 1000."""
    total = rows.count()
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counted.where(F.col("_n") * HOT_FRACTION > total).select(key, "_n").collect()
    return {k: n / total for k, n in hot}


def shares_of(rows: DataFrame, keys: Mapping[str, Column], period: str) -> DataFrame:
    """(name, key, n, period): rows of every hot value of each named key in each period, in one pass over ``rows``.

    A row with a NULL name holds a period's total.
    """
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.alias("key")) for n, c in keys.items()]))
    counted = rows.select(period, each.alias("k")).select(period, "k.*").where("key is not null").groupBy(period, "name", "key")
    counted = counted.agg(F.count(F.lit(1)).alias("n"))
    # no column but the period is read, and there are as many rows as periods
    totals = rows.groupBy(period).agg(F.count(F.lit(1)).alias("_all"))
    named = totals.select(F.col(period).alias("_period"), "_all")
    hot = counted.join(F.broadcast(named), F.col(period).eqNullSafe(F.col("_period"))).where(F.col("n") * HOT_FRACTION > F.col("_all"))
    none = F.lit(None).cast("string")
    return hot.select("name", "key", "n", period).union(totals.select(none.alias("name"), none.alias("key"), F.col("_all").alias("n"), period))


def salts_per_key(shares: Mapping[object, float], partitions: int) -> dict[int, list]:
    """How many parts each hot key is cut into, as part count -> keys.

    Enough parts that one is about a quarter of an average shuffle partition, rounded up to
    a power of two so that there are few different counts. All parts together number at
    most eight times the partitions, besides two per hot key.
    """
    counts: dict[int, list] = {}
    for key, share in shares.items():
        parts = 2 ** max(1, math.ceil(math.log2(PARTS_PER_PARTITION * share * partitions)))
        counts.setdefault(parts, []).append(key)
    return counts


def join_spread(rows: DataFrame, side: DataFrame, key: str, shares: Mapping[object, float]) -> DataFrame:
    """Shuffled left join in which no hot key and no NULL key meets in one task.

    Rows with a hot key get a salt, and only the side's rows for those keys are copied
    once per salt. NULL keys match nothing and are salted too. A row meets exactly the
    side rows it would meet without salts.

    The salt mixes the row's content with the number of the task that reads it: different
    rows of one task part, and so do copies of one row in different tasks. It does not
    depend on row order, so a task that runs again sends its rows to the same places.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = F.lit(1)
    for count, keys in salts_per_key(shares, partitions).items():
        parts = F.when(F.col(key).isin(keys), count).otherwise(parts)
    mixed = F.xxhash64(*rows.columns, F.spark_partition_id())
    own_parts = F.when(F.col(key).isNull(), PARTS_PER_PARTITION * partitions).otherwise(parts)
    salted = rows.withColumn("_parts", own_parts).withColumn(
        "_salt", F.when(F.col("_parts") > 1, F.pmod(mixed, F.col("_parts")).cast("int")).otherwise(0)
    )
    copies = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).hint("merge")
    return salted.drop("_parts").join(copies, [key, "_salt"], "left").drop("_salt")


def left_lookup(
    rows: DataFrame,
    side: Side,
    key: str,
    hot_from: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``rows`` left-joined to ``side`` on ``key``.

    A side of at most ``limit`` bytes is broadcast, so ``rows`` are not shuffled. A larger
    one is joined by shuffle with hot keys spread. Where the side does not know them,
    ``hot_from`` may name an equivalent, cheaper frame to find them in, such as the stored
    table ``rows`` come from.
    """
    if side.fits(limit):
        return rows.join(F.broadcast(side.frame), key, "left")
    shares = None if side.hot is None else side.hot.get(key, {})
    if shares is None:
        shares = hot_keys(rows if hot_from is None else hot_from, key)
    return join_spread(rows, side.frame, key, shares)
