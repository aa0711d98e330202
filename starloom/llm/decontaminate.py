"""Benchmark decontamination: a BM25 index of test items, asked with every training passage.

Test items are cut into units of at most ``UNIT`` words; Spark counts their terms, and the
inverted index holds, per term, postings in blocks of units with the greatest impact of each
block. A unit's impacts are divided by the score it gives itself, so a score is a share of the
whole unit and one threshold serves all.

A document's words are read in windows of twice ``UNIT`` words that move by ``UNIT``, so a unit
that stands in a text stands whole in some window. Every window is a query. Block-max WAND is
evaluated for many windows at a time: terms whose greatest impacts together stay below half the
threshold cannot carry a result alone and open no block; the other terms' block maxima give a
bound per block, and only blocks whose bound, with the rest of the query, reaches the threshold
are scored. All units at or above it are retrieved.

Retrieved items are verified on five-word shingles: those that end in the item's answer (its
last sentence; the last quarter of a single sentence) and all others (its question) must each
be found in the text around the window to a share of 0.8 or more.

Results for odd rows: null and empty texts and items match nothing. Items of fewer than five
words are one shingle. Repeated items are each reported; repeated documents are each judged.
Ties need no rule, since all units above the threshold are retrieved. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import U64, Words, blocks, mix, signed, small_batches, table, with_row_ids, written

UNIT = 64
K1, B = 1.2, 0.75
THRESHOLD = 0.6
SHINGLE = 5
OVERLAP = 0.8
#: Units of one posting block.
POSTING_BLOCK = 8
#: Units of one index shard; every shard is one pass over the documents. A shard has at most
#: ``UNIT`` postings a unit, so its broadcast stays below about 30 MB.
SHARD_UNITS = 20_000
CELLS = 250_000
#: Bytes of text of one search: its terms, windows and bounds are held together in every Python worker.
SEARCH_BYTES = 400_000

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


# --- test items


def _answer_start(text: str) -> int:
    """How many of the item's words come before its answer."""
    counts = [int(c) for c in Words([s.lower() for s in _SENTENCE.split(text)], plain=False).count if c]
    total = sum(counts)
    return total - counts[-1] if len(counts) > 1 else total - max(1, total // 4)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    last = max(len(h) - n + 1, 0)
    out = np.full(last, n, U64)
    for k in range(n):
        out = out * U64(0x9E3779B97F4A7C15) + h[k : k + last]
    return mix(out)


def units(items: DataFrame) -> DataFrame:
    """(item, item_id, words, answer_start, part): the item's word hashes and its parts of ``UNIT`` words."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text"):
            texts = rows.column("text").to_pylist()
            words = Words([t.lower() for t in texts], plain=False)
            full = np.flatnonzero(words.count)
            own = [signed(words.hashes[words.first[i] : words.first[i + 1]]) for i in full]
            yield pa.record_batch(
                [
                    rows.column("item_id").combine_chunks().take(pa.array(full)),
                    pa.array([x.tolist() for x in own], pa.list_(pa.int64())),
                    pa.array([_answer_start(texts[i]) for i in full], pa.int32()),
                ],
                ["item_id", "words", "answer_start"],
            )

    given = items.where("text is not null").select("item_id", "text")
    split_items = given.mapInArrow(split, "item_id bigint, words array<bigint>, answer_start int")
    # numbered by content: the numbers name rows of written tables only
    numbered = written(split_items, "items").withColumn("item", F.xxhash64("item_id", "words"))
    n_parts = F.ceil(F.size("words") / UNIT).cast("int")
    return numbered.distinct().withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1)))


def postings(parts: DataFrame) -> DataFrame:
    """(unit, item, term, impact): each unit's terms with their share of the unit's score of itself."""
    cut = parts.select(
        "item", "part", F.slice("words", F.col("part") * UNIT + 1, UNIT).alias("w")
    ).withColumn("n", F.size("w"))
    counted = cut.select("item", "part", "n", F.explode("w").alias("term")).groupBy("item", "part", "n", "term").agg(
        F.count(F.lit(1)).alias("tf")
    )
    whole = cut.agg(F.count(F.lit(1)).alias("n_units"), F.avg("n").alias("avg_n")).first()
    n_units, avg_n = whole["n_units"], whole["avg_n"] or 1.0
    df = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((F.lit(n_units) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("n") / F.lit(avg_n))
    weighed = counted.join(df, "term").withColumn("weight", idf * F.col("tf") * (K1 + 1) / norm)
    own = Window.partitionBy("item", "part")  # at most UNIT rows
    return weighed.select("item", "part", "term", (F.col("weight") / F.sum("weight").over(own)).alias("impact"))


@dataclass
class Index:
    """One shard: postings by term, block maxima by term, and the items' words for verification."""

    terms: np.ndarray  # sorted hashes
    greatest: np.ndarray  # by term: greatest impact
    block_at: np.ndarray  # by term: first of its rows in block / bound
    block: np.ndarray
    bound: np.ndarray
    by_block: list[dict[int, list[tuple[int, float]]]]  # per block: term number -> (unit, impact)
    item_of: np.ndarray  # by unit
    items: list[tuple[int | None, np.ndarray, int]]  # item_id, word hashes, answer start

    @property
    def n_blocks(self) -> int:
        return len(self.by_block)


def load_index(rows: pa.Table, items: pa.Table) -> Index:
    number = {k: i for i, k in enumerate(items.column("item").to_pylist())}
    words = [np.array(w, np.int64).view(U64) for w in items.column("words").to_pylist()]
    known = list(zip(items.column("item_id").to_pylist(), words, items.column("answer_start").to_pylist(), strict=True))
    item = np.array([number[k] for k in rows.column("item").to_pylist()], np.int64)
    part = rows.column("part").to_numpy().astype(np.int64)
    places, unit = np.unique(item << 32 | part, return_inverse=True)
    terms, term = np.unique(rows.column("term").to_numpy().view(U64), return_inverse=True)
    impact = rows.column("impact").to_numpy()
    block = unit // POSTING_BLOCK
    order = np.lexsort((block, term))
    keys, first = np.unique((term[order].astype(np.int64) << 32) | block[order], return_index=True)
    bound = np.maximum.reduceat(impact[order], first) if len(first) else np.empty(0)
    greatest = np.zeros(len(terms))
    np.maximum.at(greatest, term, impact)
    by_block: list[dict[int, list[tuple[int, float]]]] = [{} for _ in range(int(block.max()) + 1 if len(block) else 0)]
    for t, u, b, w in zip(term.tolist(), unit.tolist(), block.tolist(), impact.tolist(), strict=True):
        by_block[b].setdefault(t, []).append((u, w))
    return Index(
        terms, greatest, np.searchsorted(keys >> 32, np.arange(len(terms) + 1)), keys & 0xFFFFFFFF, bound, by_block,
        places >> 32, known,
    )


# --- retrieval


def retrieve(index: Index, window: np.ndarray, term: np.ndarray, n: int, threshold: float) -> list[tuple[int, int, float]]:
    """(window, unit, score) of all units that reach the threshold; (window, term) pairs are distinct, sorted by window."""
    out: list[tuple[int, int, float]] = []
    if not len(window):
        return out
    most = index.greatest[term]
    order = np.lexsort((most, window))
    window, term, most = window[order], term[order], most[order]
    first = np.searchsorted(window, np.arange(n + 1))
    upto = np.concatenate([[0.0], np.cumsum(most)])
    before = upto[1:] - upto[first[window]]  # this term's greatest impact and all smaller ones
    opens = before >= threshold / 2
    rest = np.bincount(window, np.where(opens, 0.0, most), n)
    step = max(1, CELLS // max(index.n_blocks, 1))
    for lo in range(0, n, step):
        hi = min(lo + step, n)
        own = slice(first[lo], first[hi])
        w, t = window[own][opens[own]] - lo, term[own][opens[own]]
        size = index.block_at[t + 1] - index.block_at[t]
        at = np.repeat(index.block_at[t] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        bounds = np.bincount(np.repeat(w, size) * index.n_blocks + index.block[at], index.bound[at], (hi - lo) * index.n_blocks)
        reached = bounds + np.repeat(rest[lo:hi], index.n_blocks) >= threshold
        for cell in np.flatnonzero(reached & (bounds > 0)).tolist():
            i, b = divmod(cell, index.n_blocks)
            i += lo
            scores: dict[int, float] = {}
            held = index.by_block[b]
            for x in term[first[i] : first[i + 1]].tolist():
                for u, s in held.get(x, ()):
                    scores[u] = scores.get(u, 0.0) + s
            out += [(i, u, s) for u, s in scores.items() if s >= threshold - 1e-9]
    return out


def overlaps(item: tuple[int | None, np.ndarray, int], around: np.ndarray) -> tuple[float, float]:
    """Shares of the question's and the answer's shingles that ``around`` holds."""
    _, words, answer = item
    n = min(SHINGLE, len(words))
    found = np.isin(windows(words, n), windows(around, n))
    ends = np.arange(len(found)) + n > answer
    share = float(found[ends].mean())
    return (float(found[~ends].mean()) if (~ends).any() else share), share


FOUND = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def _search(batches: Iterator[pa.RecordBatch], index: Index, threshold: float) -> Iterator[pa.RecordBatch]:
    for rows in blocks(batches, "text", SEARCH_BYTES):
        words = Words([t.lower() for t in rows.column("text").to_pylist()], plain=False)
        h = words.hashes
        if not len(h) or not len(index.terms):
            continue
        at = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
        hit = index.terms[at] == h
        # the parts of UNIT words that a window is made of, numbered through all texts
        n_parts = (words.count + UNIT - 1) // UNIT
        first = np.concatenate([[0], np.cumsum(n_parts)])
        part = first[words.owner] + (np.arange(len(h)) - words.first[words.owner]) // UNIT
        n, owner = int(first[-1]), np.repeat(np.arange(len(n_parts)), n_parts)
        more = np.zeros(n + 1, bool)
        more[1:n] = owner[1:] == owner[:-1]
        size = len(index.terms)
        both = np.concatenate([part[hit], part[hit][more[part[hit]]] - 1])  # a part belongs to two windows
        keys = np.unique(both * size + np.concatenate([at[hit], at[hit][more[part[hit]]]]))
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for w, unit, score in retrieve(index, keys // size, keys % size, n, threshold):
            doc, item = int(owner[w]), int(index.item_of[unit])
            length = len(index.items[item][1])
            start = int(words.first[doc]) + (w - int(first[doc])) * UNIT
            around = h[max(start - length, int(words.first[doc])) : min(start + 2 * UNIT + length, int(words.first[doc + 1]))]
            q, a = overlaps(index.items[item], around)
            best[doc, item] = max(best.get((doc, item), (-1.0, 0.0, 0.0, 0.0)), (min(q, a), score, q, a))
        if best:
            ids = rows.column("doc_id").to_pylist()
            found = [(ids[d], index.items[i][0], round(s, 6), q, a) for (d, i), (_, s, q, a) in best.items()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(zip(*found, strict=True), [pa.int64()] * 2 + [pa.float64()] * 3, strict=True)],
                ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
            )


def retrieved(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shard_units: int = SHARD_UNITS
) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of all retrieved items, verified or not."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = written(units(items), "units")
    index = written(postings(parts), "postings")
    n_shards = max(1, -(-parts.count() // shard_units))
    shard = F.pmod(F.col("item"), F.lit(n_shards))
    given = docs.where("text is not null").select("doc_id", "text")
    passes = None
    for k in range(n_shards):
        known = parts.where((shard == k) & (F.col("part") == 0)).select("item", "item_id", "words", "answer_start")
        loaded = load_index(index.where(shard == k).toArrow(), known.toArrow())
        held = spark.sparkContext.broadcast(loaded)
        one = given.mapInArrow(lambda batches, held=held: _search(batches, held.value, threshold), FOUND)
        passes = one if passes is None else passes.union(one)
    return passes


def leaks(docs: DataFrame, items: DataFrame, **options: float) -> DataFrame:
    """The retrieved pairs whose question and answer both stand in the document."""
    return retrieved(docs, items, **options).where(
        (F.col("question_overlap") >= OVERLAP) & (F.col("answer_overlap") >= OVERLAP)
    )


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no test item; each row is judged by its own text, whatever other rows have its doc_id."""
    rows = with_row_ids(docs, "__row")
    found = leaks(rows.select(F.col("__row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    found = written(found.select(F.col("doc_id").alias("__row")).distinct(), "leaks")
    return rows.join(found, "__row", "left_anti").select(*docs.columns)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
