"""The star view and rankings over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookup import BROADCAST_BYTES, Side, left_lookup
from starloom.specs import Dimension, Rollup, Star


@dataclass(frozen=True)
class CoBucketed:
    """Fact rows and one dimension's members in equal buckets; rows of hot keys apart, with their members."""

    dimension: str
    rows: DataFrame
    members: DataFrame
    hot_rows: DataFrame
    hot_members: Side


@dataclass(frozen=True)
class Mart:
    """A loaded star: its spec, the fact, the dimension members and the rollups by name."""

    star: Star
    fact: DataFrame
    members: Mapping[str, Side]
    limit: int = BROADCAST_BYTES
    rollups: Mapping[str, DataFrame] = field(default_factory=dict)
    cobucketed: CoBucketed | None = None


def _needed(mart: Mart, columns: Sequence[str]) -> list[tuple[Dimension, list[str]]]:
    """The dimensions that supply ``columns``, each with the columns taken from it."""
    wanted: dict[str, list[str]] = {}
    for column in columns:
        dim = mart.star.dimension_of(column)
        if dim is not None:
            wanted.setdefault(dim.name, []).append(column)
    return [(mart.star.dimension(name), taken) for name, taken in wanted.items()]


def _with_members(rows: DataFrame, mart: Mart, columns: Sequence[str], summed: bool = False) -> DataFrame:
    """``summed`` rows have few rows per key by construction: AQE is enough for what skew is left.

    Dimensions that supply most columns are joined last, so that shuffles carry few texts.
    """
    joined = rows
    for dim, taken in sorted(_needed(mart, columns), key=lambda one: len(one[1])):
        side = mart.members[dim.name].select(dim.sk, *taken)
        if summed:
            side = replace(side, hot={})
        joined = left_lookup(joined, side, dim.sk, hot_from=rows, limit=mart.limit)
    return joined


def _by_bucket(mart: Mart, rows: DataFrame, hot_rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both parts of the fact with the co-bucketed members: bucket with bucket, hot keys by lookup."""
    co = mart.cobucketed
    sk, taken = next((d.sk, taken) for d, taken in _needed(mart, columns) if d.name == co.dimension)
    joined = rows.join(co.members.select(sk, *taken).hint("merge"), sk, "left")
    return joined.unionByName(left_lookup(hot_rows, co.hot_members.select(sk, *taken), sk, limit=mart.limit))


def _bucketed_columns(mart: Mart, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that come from the co-bucketed dimension."""
    name = mart.cobucketed.dimension if mart.cobucketed else None
    return [c for dim, taken in _needed(mart, columns) if dim.name == name for c in taken]


def star_view(mart: Mart, columns: Sequence[str] | None = None) -> DataFrame:
    """Fact rows with dimension members in place of surrogate keys.

    Unknown members show as NULL. Given ``columns``, dimensions that supply none of them
    are not joined; with unique surrogate keys that leaves the rows unchanged.
    """
    chosen = mart.star.view_columns if columns is None else list(columns)
    near = _bucketed_columns(mart, chosen)
    if near:
        rows = _by_bucket(mart, mart.cobucketed.rows, mart.cobucketed.hot_rows, chosen)
        return _with_members(rows, mart, [c for c in chosen if c not in near]).select(*chosen)
    return _with_members(mart.fact, mart, chosen).select(*chosen)


def covering_rollup(mart: Mart, own: Sequence[str], dims: Sequence[Dimension]) -> Rollup | None:
    """The stored rollup with the fewest keys from which sums by these columns and dimensions can be taken."""
    needed = {d.name for d in dims}
    fits = [
        r for r in mart.star.rollups
        if r.name in mart.rollups and needed <= set(r.dimensions) and set(own) <= {mart.star.period, *r.own}
    ]
    return min(fits, key=lambda r: (len(r.dimensions) + len(r.own), r.name), default=None)


def ranking(
    mart: Mart,
    by: Sequence[str],
    measure: str,
    total: str = "total",
    limit: int | None = None,
) -> DataFrame:
    """Totals of a measure per group of star-view columns, greatest first.

    The fact is summed per surrogate key before any dimension is joined, so the shuffle
    carries one row per key and task however hot a key is. Summing those sums per member
    gives what summing the joined rows would: a join multiplies a sum and its rows alike.
    Where the star keeps a rollup with these keys, its sums are taken instead of the fact's rows.
    Ties are broken by the group columns; NULL groups stay and come last.
    """
    dims = [dim for dim, _ in _needed(mart, by)]
    own = [c for c in by if mart.star.dimension_of(c) is None]
    rollup = covering_rollup(mart, own, dims) if measure in mart.star.measures else None
    rows = mart.fact if rollup is None else mart.rollups[rollup.name]

    def summed(part: DataFrame) -> DataFrame:
        return part.groupBy(*own, *[d.sk for d in dims]).agg(F.sum(measure).alias("_part"))

    near = _bucketed_columns(mart, by) if rollup is None else []
    if near:
        per_key = _by_bucket(mart, summed(mart.cobucketed.rows), summed(mart.cobucketed.hot_rows), by)
    else:
        per_key = summed(rows)
    rest = [c for c in by if c not in near]
    totals = _with_members(per_key, mart, rest, summed=True).groupBy(*by).agg(F.sum("_part").alias(total))
    ordered = totals.orderBy(F.desc_nulls_last(total), *[F.asc_nulls_last(c) for c in by])
    return ordered if limit is None else ordered.limit(limit)
