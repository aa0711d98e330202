"""What the clean table's columns hold, kept per period as sketches that add up.

One pass over the loaded periods summarises every column; a period delivered again replaces its own
summaries, and a profile of any set of periods merges a few kilobytes per period and column without
reading the table.

========== ===================================================== ==================================
summary    of                                                    error
========== ===================================================== ==================================
counts     rows, values, least and greatest number               none
distinct   values (HyperLogLog, 2^14 registers)                  0.8 % standard, 2.5 % stated
quantiles  numbers, days since 1970, or lengths of texts (KLL)   2 % of the values in rank
top        values as text (frequent items, 1,024 tracked)        1/256 of the values in a count
========== ===================================================== ==================================

Values that do not stand out by more than that error are not listed among the top ones. A column
without a value has 0 distinct values, NULL quantiles and no top values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.plans.loads import Layout
from starloom.sources.tables import only_periods, overwrite_partitions, read_table

REGISTERS, QUANTILE_K, TRACKED = 14, 400, 1024
DISTINCT_ERROR, RANK_ERROR, TOP_ERROR = 0.025, 0.02, 1 / 256

_TOP = "struct<sketch:binary,maxItemsTracked:int,itemDataType:string,itemDataTypeDDL:string>"
_SUMMARY = (
    f"column_name string, n_rows bigint, n_values bigint, least bigint, greatest bigint, "
    f"distinct_sketch binary, quantile_sketch binary, top_sketch {_TOP}"
)


def profile_path(layout: Layout) -> str:
    return f"{layout.clean}_profile"


def _schema(layout: Layout) -> T.StructType:
    return T.StructType([*T._parse_datatype_string(_SUMMARY).fields, T.StructField(layout.star.period, T.StringType())])


def as_number(field: T.StructField) -> Column:
    """The number whose quantiles are kept: the value itself, days since 1970, or a text's length."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.length(value).cast("long")
    return F.unix_date(value).cast("long") if isinstance(field.dataType, T.DateType) else value.cast("long")


def _summary(field: T.StructField) -> Column:
    """One column's summaries as a struct, all taken while rows stream by."""
    value, number = F.col(field.name), as_number(field)
    return F.struct(
        F.lit(field.name).alias("column_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_values"),
        F.min(number).alias("least"),
        F.max(number).alias("greatest"),
        F.hll_sketch_agg(value.cast("string"), F.lit(REGISTERS)).alias("distinct_sketch"),
        F.kll_sketch_agg_bigint(number, F.lit(QUANTILE_K)).alias("quantile_sketch"),
        F.call_function("approx_top_k_accumulate", value.cast("string"), F.lit(TRACKED)).alias("top_sketch"),
    )


def profiled_fields(layout: Layout) -> list[T.StructField]:
    source = layout.star.source
    return [f for f in source.clean_schema.fields if f.name != source.loaded_at]


def refresh_profile(spark: SparkSession, layout: Layout, periods: Sequence[str] | None = None) -> int:
    """Summaries of ``periods`` taken anew, those of other periods left alone; rows written.

    Tasks sum up their own rows, so a period with a third of all rows is shuffled as a row per task.
    """
    rows = only_periods(layout.read_clean(spark), layout.star.period, periods).withColumn("_period", F.col(layout.star.period))
    summed = rows.groupBy("_period").agg(F.array(*[_summary(f) for f in profiled_fields(layout)]).alias("_all"))
    each = summed.select(F.col("_period"), F.explode("_all").alias("_one")).select("_one.*", F.col("_period").alias(layout.star.period))
    return overwrite_partitions(each, profile_path(layout), _schema(layout), [layout.star.period], layout.fmt, gather=True)


def stored_profile(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_table(spark, profile_path(layout), _schema(layout), layout.fmt)


def profile(
    spark: SparkSession, layout: Layout, periods: Sequence[str] | None = None, top: int = 5, shares: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """A row per column, merged over ``periods`` (by default all): counts, distinct values, quantiles, top values."""
    stored = only_periods(stored_profile(spark, layout), layout.star.period, periods)
    merged = stored.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
        F.kll_merge_agg_bigint("quantile_sketch").alias("_quantiles"),
        F.call_function("approx_top_k_estimate", F.call_function("approx_top_k_combine", F.col("top_sketch"), F.lit(TRACKED)), F.lit(top)).alias("_top"),
    )
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    return merged.select(
        "column_name", "n_rows", "n_values", "least", "greatest", "n_distinct",
        F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_bigint("_quantiles", wanted)).alias("quantiles"),
        F.filter("_top", lambda one: one["item"].isNotNull()).alias("top"),
    )
