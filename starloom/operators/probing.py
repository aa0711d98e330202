"""Surrogate keys without collisions: keys that hashes share are moved by deterministic probing.

Of the business keys whose plain hash is the same, the smallest (NULL first) keeps it. Every other
one tries salted hashes in turn and takes the first that no plain hash and no earlier probe has;
of those that want one key in the same round the smallest gets it. Keys so depend on the set of
business keys and on nothing else, neither on the order of rows nor on that of loads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.keys import ALL_BITS, surrogate_key

Stored = Callable[[DataFrame, str], DataFrame]


class KeySpaceTooSmall(ValueError):
    """More than half of all possible surrogate keys would be taken."""


def shared_keys(rows: DataFrame, bk: str, sk: str) -> DataFrame:
    """(sk) of the surrogate keys that several business keys have; NULL counts as one, however often it stands."""
    named = F.count(bk) + F.max(F.col(bk).isNull().cast("int"))
    return rows.groupBy(sk).agg(named.alias("_named")).where("_named > 1").select(sk)


def moved_keys(members: DataFrame, bk: str, sk: str, stored: Stored, bits: int = ALL_BITS) -> DataFrame:
    """(bk, sk, probe) of the business keys that do not keep their plain hash.

    ``members`` must be a stored table in which no business key but NULL repeats. ``stored`` writes a
    table and reads it back; rounds go on until every key has its place. Only keys that share
    a hash take part: with 64 bits those are none or a handful, whatever the size of the table.
    """
    plain = members.select(bk, surrogate_key(F.col(bk), bits).alias(sk))
    rank = F.struct(F.col(bk).isNotNull().alias("_named"), bk)
    shared = plain.join(shared_keys(plain, bk, sk), sk, "left_semi")
    first = shared.groupBy(sk).agg(F.min(rank).alias("_first"))
    waiting = shared.join(first, sk).where(rank != F.col("_first")).select(bk).distinct()
    waiting = stored(waiting, "probe-0")
    placed = None
    if bits < ALL_BITS and not waiting.isEmpty() and members.count() * 2 > 1 << bits:
        raise KeySpaceTooSmall(f"{bk}: {bits} bits are too few for this many keys")
    probe = 0
    while not waiting.isEmpty():
        probe += 1
        tried = waiting.select(bk, surrogate_key(F.col(bk), bits, probe).alias(sk))
        tried = stored(tried, f"tried-{probe}")
        free = tried.join(plain.select(sk), sk, "left_anti")
        free = free if placed is None else free.join(placed.select(sk), sk, "left_anti")
        won = free.groupBy(sk).agg(F.min(bk).alias(bk)).select(bk, sk, F.lit(probe).alias("probe"))
        won = stored(won, f"won-{probe}")
        placed = won if placed is None else stored(placed.union(won), f"placed-{probe}")
        waiting = stored(waiting.join(won.select(bk), bk, "left_anti"), f"probe-{probe}")
    if placed is None:
        return members.select(bk, F.col(sk), F.lit(0).alias("probe")).where("false")
    return placed


def final_key(bk: str, moved: str, bits: int = ALL_BITS):
    """The key of a row joined with its entry of ``moved_keys`` (``moved``, NULL where there is none)."""
    return F.coalesce(F.col(moved), surrogate_key(F.col(bk), bits))
