"""Fact rows from clean rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import key_or_unknown
from starloom.operators.lookup import BROADCAST_BYTES, Side, left_lookup
from starloom.specs import Star


def fact_rows(
    clean: DataFrame,
    star: Star,
    members: Mapping[str, Side],
    run_ts: Column | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Business keys replaced by surrogate keys, one fact row per clean row.

    ``members`` maps a dimension's name to its rows. A key without a member, NULL
    included, becomes -1. With all dimensions under ``limit`` this is a map-only plan.
    """
    loaded = F.current_timestamp() if run_ts is None else run_ts
    codes = [d.bk for d in star.dimensions if d.bk not in star.partition_by]
    resolved = clean.select(*star.partition_by, *codes, *star.measures)
    for dim in star.dimensions:
        side = members[dim.name].select(dim.bk, dim.sk)
        resolved = left_lookup(resolved, side, dim.bk, hot_from=clean, limit=limit)
    return resolved.select(
        *star.partition_by,
        *[key_or_unknown(F.col(d.sk)).alias(d.sk) for d in star.dimensions],
        *star.measures,
        loaded.alias(star.loaded_at),
    )
