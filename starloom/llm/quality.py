"""Quality rules: base measures of a text and the perplexity of its words under a Kneser-Ney model.

The model is counted by Spark from all words of all texts. It predicts the characters of a
word from up to four characters before them, per language, with interpolated modified
Kneser-Ney discounts. A document's score is the mean surprise of its characters, in nats (the
logarithm of its perplexity). A document is rejected when its score leaves its language's band:
the median, give or take ``WIDTH`` robust deviations, widened for short texts by ``NOISE_WIDTH``
times what chance does to a mean of few characters, and for languages of few texts by what the
median and the deviation of so few may be off.

Results for odd rows: a null or empty text has no words and fails the base rules. A null
language and an empty one are one language. Very long texts are taken whole. Repeated rows are judged each. Ties need no rule: every
document is judged by itself against bands that are exact for the given rows (medians of
histograms with bins of a thousandth of a nat). Other columns are carried through; those named
like a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import (
    BLOCK_CHARS,
    U64,
    Words,
    blocks,
    groups,
    mix,
    parts,
    runs,
    signed,
    small_batches,
    table,
    with_row_ids,
    written,
)

ORDER = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5
WIDTH = 3.0
#: Standard errors of a mean of few characters that the band leaves besides.
NOISE_WIDTH = 2.0
#: Standard errors of a median and of a robust deviation over n normal values, times the root of n.
MEDIAN_ERROR, SPREAD_ERROR = 1.2533, 1.1664
#: N-grams and contexts that one pass over the documents broadcasts (16 bytes each).
SHARD_ROWS = 4_000_000
#: Parts of the model that can be told apart by a place's context.
SLICES = 64
UNKNOWN = -20.0
START, END = 2, 3  # code points that mark a word's ends
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
BASE_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- base measures


def base_measures(words: Words) -> dict[str, np.ndarray]:
    n = len(words.texts)
    lengths = np.bincount(words.owner, words.ends - words.starts, n)[:n]
    symbol = np.isin(words.chars, np.array([ord(c) for c in SYMBOLS], np.uint32))
    upto = np.concatenate([[0], np.cumsum(symbol)])
    ends = np.minimum(words.bounds[1:], len(words.chars))
    return {
        "n_words": words.count.astype(np.int64),
        "word_chars": lengths.astype(np.int64),
        "n_symbols": (upto[ends] - upto[words.bounds[:-1]]).astype(np.int64),
        "n_dup_lines": np.array([_dup_lines(t) for t in words.texts], np.int64),
        "n_repeat_words": _repeat_words(words),
    }


def _dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _repeat_words(words: Words) -> np.ndarray:
    n = len(words.texts)
    hashes, owner = words.shingles(WINDOW)
    if not len(hashes):
        return np.zeros(n, np.int64)
    keys = mix(hashes + owner.astype(U64) * U64(0xD1342543DE82EF95))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    at = _window_starts(words)[twice]
    cover = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return np.bincount(words.owner, covered, n)[:n].astype(np.int64)


def _window_starts(words: Words) -> np.ndarray:
    last = len(words.starts) - WINDOW + 1
    return np.flatnonzero(words.owner[:last] == words.owner[WINDOW - 1 :])


# --- the model


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts, summed inside each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text", 2 * BLOCK_CHARS):
            langs = rows.column("lang").to_pylist()
            words = Words(rows.column("text").to_pylist())
            for lang in sorted(set(langs)):
                mine = np.array([x == lang for x in langs], bool)
                chosen = np.flatnonzero(mine[words.owner])
                if len(chosen):
                    _, at, n = np.unique(words.hashes[chosen], return_index=True, return_counts=True)
                    at = chosen[at]
                    texts = [_slice(words.chars, s, e) for s, e in zip(words.starts[at], words.ends[at], strict=True)]
                    yield pa.record_batch(
                        [pa.array([lang] * len(at), pa.string()), pa.array(texts, pa.string()), pa.array(n, pa.int64())],
                        ["lang", "word", "n"],
                    )

    source = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = source.mapInArrow(count, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _slice(chars: np.ndarray, start: int, end: int) -> str:
    return chars[start:end].tobytes().decode("utf-32-le", "surrogatepass")


def _padded(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words laid out with four start marks and an end mark each; places to predict; their word's number."""
    lengths = ends - starts
    size = lengths + ORDER
    first = np.concatenate([[0], np.cumsum(size)])
    flat = np.full(int(first[-1]), START, np.uint32)
    number = np.repeat(np.arange(len(starts)), lengths)
    offset = np.arange(len(number)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    flat[first[:-1][number] + ORDER - 1 + offset] = chars[starts[number] + offset]
    flat[first[1:] - 1] = END
    target = np.ones(len(flat), bool)
    for k in range(ORDER - 1):
        target[first[:-1] + k] = False
    return flat, np.flatnonzero(target), np.repeat(np.arange(len(starts)), lengths + 1)


def gram_counts(words: DataFrame) -> DataFrame:
    """(lang, gram, raw) of all ``ORDER``-grams of characters inside words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "word", BLOCK_CHARS // 4):
            langs, n = np.array(rows.column("lang").to_pylist(), object), rows.column("n").to_numpy()
            for lang in sorted(set(langs)):
                mine = langs == lang
                own = Words(rows.column("word").filter(pa.array(mine)).to_pylist())
                # a word has no blanks, so words and rows agree
                flat, at, number = _padded(own.chars, own.starts, own.ends)
                keys, first, back = np.unique(gram_hash(flat, at, ORDER), return_index=True, return_inverse=True)
                raw = np.bincount(back, n[mine][number], len(keys)).astype(np.int64)
                grams = [_slice(flat, p - ORDER + 1, p + 1) for p in at[first]]
                yield pa.record_batch(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(grams, pa.string()), pa.array(raw, pa.int64())],
                    ["lang", "gram", "raw"],
                )

    counted = words.mapInArrow(count, "lang string, gram string, raw bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("raw").alias("raw"))


def gram_hash(flat: np.ndarray, at: np.ndarray, order: int, back: int = 0) -> np.ndarray:
    """Hashes of the ``order`` characters ending ``back`` before each place."""
    out = np.full(len(at), order + 1, U64)
    for k in range(order):
        out = out * U64(0x100000001B3) + flat[at - back - k].astype(U64)
    return mix(out)


def discounted(grams: DataFrame) -> DataFrame:
    """Every n-gram and context of the model: (lang, kind, k, gram, a).

    kind 0: an n-gram of ``k`` characters with its discounted share ``a`` in its context.
    kind 1: a context of ``k`` characters with the weight ``a`` of the next lower order.

    The longest n-grams count how often they occur; shorter ones how many characters stand
    before them, save those at a word's start, before which nothing can stand.
    """
    level = grams.select("lang", F.lit(ORDER).alias("k"), "gram", "raw", F.col("raw").alias("adj"))
    levels = level
    for k in range(ORDER - 1, 0, -1):
        left = level.groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(
            F.sum("raw").alias("raw"), F.count(F.lit(1)).alias("kinds")
        )
        adj = F.when(F.substring("gram", 1, 1) == chr(START), F.col("raw")).otherwise(F.col("kinds"))
        level = left.select("lang", F.lit(k).alias("k"), "gram", "raw", adj.alias("adj"))
        levels = levels.union(level)
    levels = written(levels, "grams")

    n = [F.count_if(F.col("adj") == i).alias(f"c{i}") for i in (1, 2, 3, 4)]
    c1, c2, c3, c4 = (F.col(f"c{i}").cast("double") for i in (1, 2, 3, 4))
    y = c1 / (c1 + 2 * c2)
    usable = (F.col("c1") > 0) & (F.col("c2") > 0) & (F.col("c3") > 0) & (F.col("c4") > 0)

    def discount(i: int, value: F.Column) -> F.Column:
        whole = F.when(usable, value)  # with too few counts to tell, half a count per count
        return F.least(F.greatest(F.coalesce(whole, F.lit(i / 2)), F.lit(0.0)), F.lit(float(i))).alias(f"d{i}")

    # five rows a language, written so that their size is known: the join with them is no shuffle on the language
    rates = written(
        levels.groupBy("lang", "k").agg(*n).select(
            "lang",
            "k",
            discount(1, 1 - 2 * y * c2 / F.nullif(c1, F.lit(0.0))),
            discount(2, 2 - 3 * y * c3 / F.nullif(c2, F.lit(0.0))),
            discount(3, 3 - 4 * y * c4 / F.nullif(c3, F.lit(0.0))),
        ),
        "discounts",
    )
    adj = F.col("adj")
    taken = F.when(adj == 1, F.col("d1")).when(adj == 2, F.col("d2")).otherwise(F.col("d3"))
    context = F.expr("substring(gram, 1, k - 1)")
    priced = levels.join(rates, ["lang", "k"]).select("lang", "k", "gram", context.alias("context"), "adj", taken.alias("d"))
    totals = priced.groupBy("lang", "k", "context").agg(
        F.sum("adj").alias("total"),
        # whole millionths: sums of doubles depend on their order
        F.sum(F.round(F.col("d") * 1_000_000).cast("long")).alias("held"),
        F.count(F.lit(1)).alias("kinds"),
    )
    shares = priced.join(totals, ["lang", "k", "context"]).select(
        "lang", F.lit(0).alias("kind"), "k", "gram", ((F.col("adj") - F.col("d")) / F.col("total")).alias("a")
    )
    held = F.col("held") / 1_000_000 / F.col("total")
    # below single characters stands an even chance for each kind of character and one unknown
    weight = F.when(F.col("k") == 1, held / (F.col("kinds") + 1)).otherwise(held)
    weights = totals.select(
        "lang", F.lit(1).alias("kind"), (F.col("k") - 1).alias("k"), F.col("context").alias("gram"), weight.alias("a")
    )
    return shares.union(weights)


def slice_of() -> F.Column:
    """The slice of a model row: by the last two characters of its context; -1 is needed by all."""
    known = F.when(F.col("kind") == 0, F.expr("substring(gram, 1, k - 1)")).otherwise(F.col("gram"))
    tail = F.right(known, F.lit(2))
    code = F.ascii(F.substring(tail, 1, 1)).cast("long") * 31 + F.ascii(F.substring(tail, 2, 1))
    return F.when(F.length(tail) < 2, F.lit(-1)).otherwise(F.pmod(code, F.lit(SLICES))).cast("int")


def interpolated(rows: DataFrame) -> DataFrame:
    """The model as hashes: (slice, kind, hash, value), logarithms of probabilities and weights.

    All that the n-grams of a slice interpolate with lies in the slice or in the few rows of
    short contexts, which every slice gets and slice -1 holds once.
    """
    placed = rows.withColumn("own", slice_of())
    everywhere = F.when(F.col("own") == -1, F.sequence(F.lit(-1), F.lit(SLICES - 1))).otherwise(F.array("own"))
    dealt = placed.withColumn("slice", F.explode(everywhere)).repartition(parts(rows.sparkSession), "slice")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, ["slice"]):
            at = runs(part, ["slice"])
            for s, e in zip(at[:-1], at[1:], strict=True):
                yield from _interpolate(part.slice(s, e - s))

    return dealt.sortWithinPartitions("slice").mapInArrow(work, "slice int, kind int, lang string, hash bigint, value double")


@dataclass
class Shard:
    """Sorted hash arrays of the n-grams and contexts that one set of places needs."""

    number: int
    n_shards: int
    probability: tuple[np.ndarray, np.ndarray]  # hashes, log probabilities
    weight: tuple[np.ndarray, np.ndarray]  # hashes, log weights
    unknown: dict[str, float]  # log probability of a character never seen

    def scores(self, lang: str, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability of the character at each place."""
        salt = language_salt(lang)
        out, open_ = np.zeros(len(at)), np.arange(len(at))
        for k in range(ORDER, 0, -1):
            if not len(open_):
                return out
            p, known = _find(self.probability, gram_hash(flat, at[open_], k) ^ salt)
            out[open_[known]] += p[known]
            open_ = open_[~known]
            w, known = _find(self.weight, gram_hash(flat, at[open_], k - 1, 1) ^ salt)
            if k > 1:
                out[open_[known]] += w[known]
        out[open_] += self.unknown.get(lang, UNKNOWN)
        return out


def language_salt(lang: str) -> np.uint64:
    return mix(np.array([Words([lang or "?"]).hashes.sum(dtype=U64) + U64(len(lang))], U64))[0]


def _find(arrays: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, values = arrays
    if not len(hashes) or not len(keys):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return values[at], hashes[at] == keys


def _interpolate(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Lowest order first: p_k(w | h) = share + weight(h) * p_(k-1)(w | shorter h)."""
    number = int(rows.column("slice")[0].as_py())
    own_slice = rows.column("own").to_numpy() == number
    kind, order = rows.column("kind").to_numpy(), rows.column("k").to_numpy()
    grams, a = rows.column("gram").to_pylist(), rows.column("a").to_numpy()
    langs = np.array(rows.column("lang").to_pylist(), object)
    salts = {x: language_salt(x) for x in sorted(set(langs))}
    salt = np.array([salts[x] for x in langs], U64)

    def hashed(chosen: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        flat = np.frombuffer("".join(grams[i] for i in chosen).encode("utf-32-le", "surrogatepass"), np.uint32)
        return flat, np.arange(len(chosen)) * k + k - 1

    def batch(chosen: np.ndarray, what: int, keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        mine = own_slice[chosen]
        n = int(mine.sum())
        names = pa.array(langs[chosen][mine].tolist(), pa.string())
        cols = [pa.array([number] * n, pa.int32()), pa.array([what] * n, pa.int32()), names]
        cols += [pa.array(signed(keys[mine])), pa.array(values[mine], pa.float64())]
        return pa.record_batch(cols, ["slice", "kind", "lang", "hash", "value"])

    wk, wv = [], []
    unknown: dict[str, float] = {}
    for k in range(ORDER):
        chosen = np.flatnonzero((kind == 1) & (order == k))
        if not len(chosen):
            continue
        values = np.log(np.maximum(a[chosen], 1e-9))
        if k == 0:  # below single characters: an even chance
            unknown = dict(zip(langs[chosen].tolist(), values.tolist(), strict=True))
            yield batch(chosen, 2, salt[chosen], values)
            continue
        flat, at = hashed(chosen, k)
        wk.append(gram_hash(flat, at, k) ^ salt[chosen])
        wv.append(values)
        yield batch(chosen, 1, wk[-1], values)
    weight, lower = _sorted(wk, wv), _sorted([], [])
    for k in range(1, ORDER + 1):
        chosen = np.flatnonzero((kind == 0) & (order == k))
        if not len(chosen):
            continue
        flat, at = hashed(chosen, k)
        if k == 1:
            p = a[chosen] + np.exp([unknown.get(x, UNKNOWN) for x in langs[chosen]])
        else:
            low, there = _find(lower, gram_hash(flat, at, k - 1) ^ salt[chosen])
            w, weighed = _find(weight, gram_hash(flat, at, k - 1, 1) ^ salt[chosen])
            p = a[chosen] + np.where(there & weighed, np.exp(low + w), 0.0)
        keys, values = gram_hash(flat, at, k) ^ salt[chosen], np.log(np.maximum(p, 1e-12))
        yield batch(chosen, 0, keys, values)
        lower = _sorted([keys], [values])


def load_shard(rows: pa.Table, number: int, n_shards: int) -> Shard:
    kind, keys = rows.column("kind").to_numpy(), rows.column("hash").to_numpy().view(U64)
    values = rows.column("value").to_numpy()
    names = rows.filter(pa.array(kind == 2)).column("lang").to_pylist()
    arrays = [_sorted([keys[kind == k]], [values[kind == k]]) for k in (0, 1)]
    return Shard(number, n_shards, *arrays, dict(zip(names, values[kind == 2].tolist(), strict=True)))


def _sorted(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.empty(0, U64), np.empty(0)
    k, v = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(k)
    return k[order], v[order]


def train(docs: DataFrame) -> DataFrame:
    """The model's rows, from all words of all texts of ``docs`` (lang, text)."""
    small_batches(docs.sparkSession)
    return written(interpolated(discounted(written(gram_counts(word_counts(docs)), "counts"))), "model")


# --- scoring

SCORES = (
    "doc_id bigint, lang string, digest binary, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_targets bigint, surprise bigint, squares bigint"
)


def scored(docs: DataFrame, model: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: base measures, predicted places, surprise in millionths of a nat.

    The model is cut into shards of about ``shard_rows`` rows and each pass over the documents
    broadcasts one; a place belongs to exactly one shard, so the passes' sums add up.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = model.count()
    n = min(SLICES, max(1, -(-rows // shard_rows)))
    passes = None
    for number in range(n):
        own = model.where((F.col("slice") == -1) | (F.col("slice") % n == number))
        shard = spark.sparkContext.broadcast(load_shard(own.toArrow(), number, n))
        one = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
        one = one.mapInArrow(lambda batches, shard=shard: _score(batches, shard.value), SCORES)
        passes = one if passes is None else passes.union(one)
    if n == 1:
        return passes.drop("digest")
    # rows that share doc_id, language and the text's digest are equal, and so are their sums in each
    # pass: a group's sums are shared out evenly among its rows, of which each pass has all
    totals = ("n_targets", "surprise", "squares")
    keys = [c for c in passes.columns if c not in totals]
    sums = passes.groupBy(*keys).agg((F.count(F.lit(1)) / n).cast("long").alias("m"), *[F.sum(c).alias(c) for c in totals])
    each = sums.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("m"))))
    return each.select(*[F.expr(f"{c} div m").alias(c) if c in totals else c for c in passes.columns if c != "digest"])


def _score(batches: Iterator[pa.RecordBatch], shard: Shard) -> Iterator[pa.RecordBatch]:
    for rows in blocks(batches, "text"):
        words = Words(rows.column("text").to_pylist())
        n = len(words.texts)
        base = base_measures(words)
        sums = np.zeros((3, n))
        langs = np.array(rows.column("lang").to_pylist(), object)
        for lang in sorted(set(langs)):
            chosen = np.flatnonzero((langs == lang)[words.owner])
            if not len(chosen):
                continue
            # each distinct word of the block is scored once
            _, first, back = np.unique(words.hashes[chosen], return_index=True, return_inverse=True)
            at = chosen[first]
            flat, places, number = _padded(words.chars, words.starts[at], words.ends[at])
            if shard.n_shards > 1:
                code = flat[places - 2].astype(np.int64) * 31 + flat[places - 1]
                mine = code % SLICES % shard.n_shards == shard.number
                places, number = places[mine], number[mine]
            logs = shard.scores(lang, flat, places)
            each = [np.bincount(number, w, len(at)) for w in (np.ones(len(logs)), -logs, logs * logs)]
            for total, value in zip(sums, each, strict=True):
                total += np.bincount(words.owner[chosen], value[back], n)[:n]
        exact = [np.round(sums[0]), np.round(sums[1] * 1e6), np.round(sums[2] * 1e6)]
        yield pa.record_batch(
            [
                rows.column("doc_id").combine_chunks(),
                rows.column("lang").combine_chunks(),
                pa.array(_digests(words.texts) if shard.n_shards > 1 else [None] * n, pa.binary()),
                *[pa.array(base[c]) for c in BASE_MEASURES],
                *[pa.array(x.astype(np.int64)) for x in exact],
            ],
            schema=pa.schema(
                [("doc_id", pa.int64()), ("lang", pa.string()), ("digest", pa.binary())]
                + [(c, pa.int64()) for c in (*BASE_MEASURES, "n_targets", "surprise", "squares")]
            ),
        )


def _digests(texts: list[str]) -> list[bytes]:
    return [hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]


def bands(scores: DataFrame) -> DataFrame:
    """(lang, n_scores, middle, spread, noise) of the scores of texts that pass the base rules.

    ``middle`` and ``spread`` (the median distance from it) come from histograms, so that a
    language with a third of all documents is summed in its tasks and only its bins meet.
    """
    good = scores.where(~base_failed() & (F.col("n_targets") > 0)).select(
        "lang", F.round(score() * 1000).cast("long").alias("bin"), "n_targets", "surprise", "squares"
    )
    counted = written(good.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n")), "scores")
    middle = _middle(counted).withColumnRenamed("mid", "middle")
    away = counted.join(middle, "lang").select("lang", F.abs(F.col("bin") - F.col("middle")).alias("bin"), "n")
    away = away.groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    spread = _middle(away).withColumnRenamed("mid", "spread")
    places, mean = F.sum("n_targets"), F.sum("surprise") / F.sum("n_targets") / 1e6
    noise = good.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_scores"), (F.sum("squares") / places / 1e6 - mean * mean).alias("noise")
    )
    return middle.join(spread, "lang").join(noise, "lang").select(
        "lang",
        "n_scores",
        (F.col("middle") / 1000).alias("middle"),
        (F.col("spread") / 1000).alias("spread"),
        F.greatest("noise", F.lit(0.0)).alias("noise"),
    )


def _middle(histogram: DataFrame) -> DataFrame:
    """The lower median of each language's bins."""
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("bin"))
    whole = F.sum("n").over(Window.partitionBy("lang"))
    reached = histogram.select("lang", "bin", upto.alias("upto"), whole.alias("whole")).where("2 * upto >= whole")
    return reached.groupBy("lang").agg(F.min("bin").alias("mid"))


def score() -> F.Column:
    return F.col("surprise") / F.col("n_targets") / 1e6


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")
    )


def judged(docs: DataFrame, width: float = WIDTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: base measures, ``base_failed``, ``log_perplexity``, its band, ``kept``."""
    scores = written(scored(docs, train(docs), shard_rows), "judged")
    limits = written(bands(scores), "bands")
    # a mean over few characters strays by chance: its variance adds to the language's own
    unsure = 2 / F.sqrt("n_scores")  # two standard errors of what few scores say of a language
    wide = width * (1 + SPREAD_ERROR * unsure) + MEDIAN_ERROR * unsure
    half = F.sqrt(
        F.pow(wide * 1.4826 * F.col("spread"), 2) + NOISE_WIDTH**2 * F.col("noise") / F.greatest("n_targets", F.lit(1))
    )
    failed = base_failed()
    value = F.when(F.col("n_targets") > 0, score())
    inside = (F.col("log_perplexity") >= F.col("lower")) & (F.col("log_perplexity") <= F.col("upper"))
    return (
        scores.join(limits, "lang", "left")
        .withColumns({
            "base_failed": failed, "log_perplexity": value,
            "lower": F.col("middle") - half, "upper": F.col("middle") + half,
        })
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
        .select("doc_id", *BASE_MEASURES, "base_failed", "log_perplexity", "lower", "upper", "kept")
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that every rule keeps, with their columns; each row is judged by its own text and language."""
    rows = with_row_ids(docs, "__row")
    verdicts = judged(rows.select(F.col("__row").alias("doc_id"), "lang", "text"))
    rejected = verdicts.where(~F.col("kept")).select(F.col("doc_id").alias("__row"))
    return rows.join(written(rejected, "rejected"), "__row", "left_anti").select(*docs.columns)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))
