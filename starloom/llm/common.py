"""Helpers that several operators share: written tables, Arrow blocks, word hashes, skewed joins."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.workspace import new_folder

#: Rows of one Arrow batch: texts vary in length a thousandfold, so batches are cut by rows
#: first and gathered by size (``blocks``) afterwards.
BATCH_ROWS = 256
#: Characters of text that one numpy pass holds.
BLOCK_CHARS = 1_500_000
#: Characters that are hashed at a time: several numbers of 8 bytes are held for each.
HASHED_CHARS = 1 << 18

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows: the default of 10,000 long texts does not fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def written(rows: DataFrame, label: str, **options: str) -> DataFrame:
    """``rows`` written to a fresh table in the shared folder and read back: lineage ends there."""
    folder = new_folder(rows.sparkSession, label)
    rows.write.parquet(folder, **options)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def with_row_ids(docs: DataFrame, name: str) -> DataFrame:
    """A stored copy of ``docs`` with column ``name``, a number for each row.

    Rows are told apart by it where doc_ids repeat or are null. The copy is written, so that
    whoever reads it, and however often a lost task runs again, finds the same numbers. It holds
    whole texts and stays until the job ends, a copy for each stage, so it is compressed well.
    """
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "rows", compression="zstd")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- joins against groups that were counted


def with_group(rows: DataFrame, groups: DataFrame, key: str, size: str, shuffled: bool = False) -> DataFrame:
    """``rows`` left-joined with ``groups`` (one row per key, ``size`` = its rows), hot keys apart.

    Keys with over a thousandth of all grouped rows are fewer than a thousand by definition,
    so broadcasting them is bounded. Their rows never meet in one shuffle partition: for the
    shuffle join they take a scattered key that matches nothing. ``shuffled`` says that the
    groups grow with the rows, so that no size of them is worth a broadcast.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    extra = [c for c in groups.columns if c != key]
    hot = groups.where(F.col(size) > F.lit(max(total // 1000, 1000)))
    hot_side = F.broadcast(hot.select(F.col(key).alias("_hk"), F.struct(*extra).alias("_hot")))
    cold_side = groups.select(F.col(key).alias("_ck"), F.struct(*extra).alias("_cold"))
    both = rows.join(hot_side, F.col(key) == F.col("_hk"), "left")
    # any columns that differ among a key's rows will do; texts are not worth hashing
    scattered = F.xxhash64(F.lit("scattered"), *[F.col(c) for c, t in rows.dtypes if t in ("bigint", "int")])
    cold_side = cold_side.hint("merge") if shuffled else cold_side
    kind = dict(groups.dtypes)[key]
    other = F.concat(F.lit("~"), scattered.cast("string")) if kind == "string" else scattered
    both = both.withColumn("_jk", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(other))
    joined = both.join(cold_side, F.col("_jk") == F.col("_ck"), "left")
    found = F.coalesce(F.when(F.col("_hot").isNull(), F.col("_cold")), F.col("_hot"))
    return joined.select(*rows.columns, *[found[c].alias(c) for c in extra])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an undirected graph; the root is the smallest node of its component.

    Alternating large-star and small-star steps: each is a grouped minimum and a join, the
    edges of a round are written, and rounds go on until a round changes no edge.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    now, before = written(_oriented(ends), "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before:
            break
        before = mark
        now = written(_oriented(_small_star(_oriented(_large_star(now)))), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(now.select(F.col("a"), F.col("a"))).distinct()


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, smaller end in ``a``."""
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
    near = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u")
    return near.select(F.col("m").alias("a"), F.col("v").alias("b")).union(least.select("m", "u"))


# --- Arrow blocks


def blocks(batches: Iterable[pa.RecordBatch], text: str, chars: int = BLOCK_CHARS) -> Iterator[pa.Table]:
    """Batches gathered (and cut between rows) into tables of about ``chars`` bytes of ``text``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(text)).nbytes
        if size >= chars:
            yield from _cut(pa.Table.from_batches(held), text, chars)
            held, size = [], 0
            give_back()
    if held:
        yield from _cut(pa.Table.from_batches(held), text, chars)
        held = []
    give_back()


def give_back() -> None:
    """Freed memory back to the system: workers outlive their tasks, and what they keep adds to the next stage's."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


@functools.cache
def _trim():
    """The C library's call that returns freed memory, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None


def _cut(rows: pa.Table, text: str, chars: int) -> Iterator[pa.Table]:
    nbytes = rows.column(text).nbytes
    if nbytes <= 2 * chars or rows.num_rows == 1:
        yield rows.combine_chunks()
        return
    half = rows.num_rows // 2
    yield from _cut(rows.slice(0, half), text, chars)
    yield from _cut(rows.slice(half), text, chars)


def groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Runs of equal keys from a stream sorted by them, several whole runs at a time."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        last = 0
        arrays = [rows.column(k).to_numpy() for k in keys]
        changes = np.zeros(rows.num_rows, bool)
        for x in arrays:
            changes[1:] |= x[1:] != x[:-1]
        at = np.flatnonzero(changes)
        if len(at):
            last = int(at[-1])
            yield rows.slice(0, last).combine_chunks()
        rest = rows.slice(last)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def runs(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Bounds of the runs of equal keys: n + 1 row numbers."""
    changes = np.ones(rows.num_rows + 1, bool)
    changes[1:-1] = False
    for k in keys:
        x = rows.column(k).to_numpy()
        changes[1:-1] |= x[1:] != x[:-1]
    return np.flatnonzero(changes)


# --- words of texts as numpy arrays


class Words:
    """Words of a list of texts: code points, spans and owners.

    ``plain`` words are runs of anything but blanks (U+0020, U+0009 to U+000D); otherwise words
    also end at ASCII characters that are neither letters nor digits.
    """

    def __init__(self, texts: Sequence[str | None], plain: bool = True):
        self.texts = [t or "" for t in texts]
        joined = "\n".join(self.texts)
        self.chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.bounds = np.concatenate([[0], np.cumsum(lengths + 1)])  # text i is chars[bounds[i]:bounds[i + 1] - 1]
        inside = np.zeros(len(self.chars) + 2, bool)
        inside[1:-1] = ~_stops(plain)[np.minimum(self.chars, 128)]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.owner = np.searchsorted(self.bounds, self.starts, "right") - 1
        self.count = np.bincount(self.owner, minlength=len(self.texts))[: len(self.texts)]
        self.first = np.concatenate([[0], np.cumsum(self.count)])  # words of text i: first[i]:first[i + 1]

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's characters."""
        out = np.empty(len(self.starts), U64)
        step, done = HASHED_CHARS, 0
        while done < len(out):  # a stretch of text at a time: the running sums take 8 bytes a character
            base = self.starts[done]
            upto = max(int(np.searchsorted(self.ends, base + step, "right")), done + 1)
            s, e = self.starts[done:upto] - base, self.ends[done:upto] - base
            sums = np.zeros(int(e[-1]) + 1, U64)
            powers, inverse = _powers(int(e[-1]))
            np.cumsum((self.chars[base : base + int(e[-1])].astype(U64) + U64(1)) * powers, out=sums[1:])
            out[done:upto] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U64))
            done = upto
        return out

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, owner) of every window of ``n`` words inside a text, in order."""
        h = self.hashes
        if len(h) < n:
            return np.empty(0, U64), np.empty(0, np.int64)
        last = len(h) - n + 1
        out = np.zeros(last, U64)
        for k in range(n):
            out = out * U64(_BASE) + h[k : k + last]
        inside = self.owner[:last] == self.owner[n - 1 :]
        return mix(out[inside]), self.owner[:last][inside]

    def whole(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, owner) of texts with fewer than ``n`` words, but at least one: all their words."""
        short = np.flatnonzero((self.count > 0) & (self.count < n))
        out = np.zeros(len(short), U64)
        for k in range(n - 1):
            more = self.count[short] > k
            at = np.minimum(self.first[short] + k, max(len(self.hashes) - 1, 0))
            out = np.where(more, out * U64(_BASE) + self.hashes[at], out) if len(short) else out
        return mix(out + self.count[short].astype(U64)), short


@functools.cache
def _stops(plain: bool) -> np.ndarray:
    """Which ASCII code points end a word; 128 stands for all others."""
    stop = np.zeros(129, bool)
    for c in range(128):
        stop[c] = c == 32 or 9 <= c <= 13 if plain else not chr(c).isalnum()
    return stop


_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n + 1:
        size = max(n + 1, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps, dtype=U64)
    return _tables["up"][:n], _tables["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def pairs_of_blocks(n_blocks: Column, block: Column) -> Column:
    """All unordered pairs of blocks that ``block`` is part of, as an array of structs (i, j)."""
    return F.transform(
        F.sequence(F.lit(0), n_blocks - 1),
        lambda k: F.struct(F.least(k, block).alias("i"), F.greatest(k, block).alias("j")),
    )
