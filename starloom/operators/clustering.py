"""Rows of a partition laid out so that a filter on any one of several keys meets few of its files."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.keys import ALL_BITS
from starloom.specs import Dimension

KEY_BITS = 32


def space_filling(dims: Sequence[Dimension]) -> Column:
    """Place of a row on the Z curve through its surrogate keys, a pure column expression.

    The leading bits of the keys take turns, 32 in all. Surrogate keys are hashes, spread evenly
    over their range, so no quantiles have to be found first. The unknown key counts as 0.
    """
    each = KEY_BITS // len(dims)
    place = F.lit(0).cast("long")
    for turn, dim in enumerate(dims):
        width = min(dim.key_bits, ALL_BITS - 1)
        bits = min(each, width)
        lead = F.shiftright(F.greatest(F.col(dim.sk), F.lit(0)), width - bits)
        for bit in range(bits):
            one = F.shiftright(lead, bits - 1 - bit).bitwiseAND(F.lit(1).cast("long"))
            place = place + F.shiftleft(one, KEY_BITS - 1 - (bit * len(dims) + turn))
    return place


def fact_files(n_rows: int, schema: T.StructType, partition_by: Sequence[str], target: int) -> int:
    """How many files of about ``target`` bytes hold the rows uncompressed: fixed-width columns only."""
    widths = {T.IntegerType(): 4, T.DateType(): 4}
    width = sum(widths.get(f.dataType, 8) for f in schema.fields if f.name not in partition_by)
    return max(1, math.ceil(n_rows * width / target))


def clustered(rows: DataFrame, partition_by: Sequence[str], dims: Sequence[Dimension], files: int) -> DataFrame:
    """Rows dealt by range into ``files`` tasks, each a stretch of the curve inside one partition or few.

    Ranges are cut where the rows are, so a large partition gets many files. A digest of the row and
    of the task that read it comes last in the order, so that rows of one key set, and even equal rows,
    are cut like any others. It does not depend on row order: a task that runs again deals alike.
    """
    tasked = rows.withColumn("_task", F.spark_partition_id())
    order = [*[F.col(c) for c in partition_by], space_filling(dims), F.xxhash64(*tasked.columns)]
    return tasked.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_task")
