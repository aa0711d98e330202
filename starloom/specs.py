"""Declarations that drive every step: columns, source files, dimensions, fact, star.

A spec only says what a table looks like. The operators read the spec and build
ordinary DataFrame plans from it, so adding a column or a dimension never means
adding code.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

CLEAN_TYPES = {
    "text": T.StringType(),
    "int": T.IntegerType(),
    "legacy_int": T.IntegerType(),
    "date": T.DateType(),
}


def _field(name: str, dtype: T.DataType, comment: str = "") -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": comment} if comment else None)


@dataclass(frozen=True)
class Column:
    """One source column and the type it takes once cleaned.

    ``kind`` is ``text`` (trimmed), ``int`` (bad text becomes NULL), ``legacy_int``
    (as ``int``, but decimals are cut off the way Spark's non-ANSI cast does) or ``date``.
    """

    name: str
    kind: str = "text"
    comment: str = ""

    def __post_init__(self):
        if self.kind not in CLEAN_TYPES:
            raise ValueError(f"column {self.name}: unknown kind {self.kind!r}")


@dataclass(frozen=True)
class Source:
    """Delimited text shards and the raw / clean tables loaded from them."""

    columns: tuple[Column, ...]
    partition_by: tuple[str, ...]
    shards: str
    raw_table: str
    clean_table: str
    loaded_at: str = "loaded_at"
    raw_comment: str = "Rows as delivered, all text"
    clean_comment: str = "Trimmed and typed rows"
    sep: str = ";"
    quote: str = '"'
    escape: str = "\\"
    encoding: str = "UTF-8"

    @property
    def comments(self) -> dict[str, str]:
        return {c.name: c.comment for c in self.columns}

    @property
    def file_schema(self) -> T.StructType:
        return T.StructType([_field(c.name, T.StringType(), c.comment) for c in self.columns])

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([*self.file_schema.fields, self._loaded_field])

    @property
    def clean_schema(self) -> T.StructType:
        typed = [_field(c.name, CLEAN_TYPES[c.kind], c.comment) for c in self.columns]
        return T.StructType([*typed, self._loaded_field])

    @property
    def _loaded_field(self) -> T.StructField:
        return _field(self.loaded_at, T.TimestampType(), "When the row was written")


@dataclass(frozen=True)
class Dimension:
    """Type-1 dimension: surrogate key, business key, attributes, audit timestamps.

    ``key_bits`` is the width of the hash its surrogate keys are taken from.
    """

    name: str
    sk: str
    bk: str
    attributes: tuple[str, ...]
    created_at: str = "created_at"
    updated_at: str = "updated_at"
    comments: dict[str, str] = field(default_factory=dict, hash=False)
    comment: str = ""
    key_bits: int = 64

    def comment_of(self, column: str) -> str:
        own = {
            self.sk: f"Hash of {self.bk}",
            self.created_at: "When the member was inserted",
            self.updated_at: "When an attribute last changed",
        }
        return self.comments.get(column, own.get(column, ""))

    @property
    def columns(self) -> list[str]:
        return [self.sk, self.bk, *self.attributes, self.created_at, self.updated_at]

    @property
    def schema(self) -> T.StructType:
        types = {self.sk: T.LongType(), self.created_at: T.TimestampType(), self.updated_at: T.TimestampType()}
        return T.StructType(
            [_field(c, types.get(c, T.StringType()), self.comment_of(c)) for c in self.columns]
        )


@dataclass(frozen=True)
class Layer:
    """Comment and properties of a namespace."""

    comment: str
    properties: Mapping[str, str] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Rollup:
    """Sums of all measures kept per period, some of the fact's own columns and some dimensions' keys."""

    name: str
    dimensions: tuple[str, ...] = ()
    own: tuple[str, ...] = ()


@dataclass(frozen=True)
class Star:
    """A source, its dimensions, and the fact that ties them together.

    ``cluster_by`` names dimensions whose keys the fact is filtered by: inside its partitions rows
    are then laid out along a space-filling curve, in files of about ``file_bytes`` before compression.
    """

    source: Source
    dimensions: tuple[Dimension, ...]
    fact_table: str
    measures: tuple[str, ...]
    period: str
    view: str = "star"
    fact_comment: str = "One row per clean row, with surrogate keys"
    rollups: tuple[Rollup, ...] = ()
    cluster_by: tuple[str, ...] = ()
    file_bytes: int = 1024 * 1024 * 1024

    @property
    def partition_by(self) -> tuple[str, ...]:
        return self.source.partition_by

    @property
    def loaded_at(self) -> str:
        return self.source.loaded_at

    @property
    def fact_schema(self) -> T.StructType:
        clean = {f.name: f for f in self.source.clean_schema.fields}
        return T.StructType(
            [clean[c] for c in self.partition_by]
            + [_field(d.sk, T.LongType(), f"Points to {d.name}, -1 when unknown") for d in self.dimensions]
            + [clean[m] for m in self.measures]
            + [clean[self.loaded_at]]
        )

    def rollup_schema(self, rollup: Rollup) -> T.StructType:
        fact = {f.name: f for f in self.fact_schema.fields}
        own = [fact[c] for c in dict.fromkeys([self.period, *rollup.own])]
        keys = [fact[self.dimension(d).sk] for d in rollup.dimensions]
        sums = [_field(m, T.LongType(), f"Sum of {m}") for m in self.measures]
        return T.StructType([*own, *keys, *sums, _field("n_rows", T.LongType(), "Fact rows summed")])

    def dimension(self, name: str) -> Dimension:
        for dim in self.dimensions:
            if dim.name == name:
                return dim
        raise KeyError(name)

    def dimension_of(self, column: str) -> Dimension | None:
        """The dimension that supplies a star-view column; None when the fact has it."""
        if column in self.fact_schema.names:
            return None
        for dim in self.dimensions:
            if column == dim.bk or column in dim.attributes:
                return dim
        raise KeyError(column)

    @property
    def view_columns(self) -> list[str]:
        """Fact partition keys, dimension members, measures, load time.

        A name that the fact and a dimension share comes from the fact, once.
        """
        names = list(self.partition_by)
        for dim in self.dimensions:
            names += [c for c in (dim.bk, *dim.attributes) if c not in names]
        return [*names, *self.measures, self.loaded_at]
