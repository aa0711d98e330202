"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import functions as F

UNKNOWN_KEY = -1
SMALLEST_LONG = -(2**63)
ALL_BITS = 64


def without_sign(number: SparkColumn) -> SparkColumn:
    """Absolute value; the smallest LONG has no positive counterpart and stays as it is.

    Under ANSI, plain ``abs`` would fail on it.
    """
    return F.when(number == SMALLEST_LONG, number).otherwise(F.abs(number))


def surrogate_key(bk: SparkColumn, bits: int = ALL_BITS, probe: int = 0) -> SparkColumn:
    """Deterministic key over a business key; never meets ``UNKNOWN_KEY``.

    ``probe`` above 0 gives the keys to try where the plain one is taken. ``bits`` below 64
    narrows the key, which makes business keys share one sooner.
    """
    key = without_sign(F.xxhash64(bk) if probe == 0 else F.xxhash64(bk, F.lit(probe)))
    return key if bits >= ALL_BITS else key.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def key_or_unknown(sk: SparkColumn) -> SparkColumn:
    return F.coalesce(sk, F.lit(UNKNOWN_KEY).cast("long"))
