"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Features are rates, not words: how dense the words of a lexicon are, how near they stand to the
second person, capitals, punctuation, and obfuscation (letters mixed with digits or symbols, drawn
out or spelled out). The lexicon is a short list of insults joined by words and word beginnings that
the labelled texts show to be telling: each is counted once per text, and stays if its log odds are
``EVIDENCE`` standard errors above none. Trees (Spark's ``GBTClassifier``) are fitted on the
features, and ``IsotonicRegression`` turns their margins into the share of toxic texts.

Labelled rows are told apart by crc32(doc_id as text) mod 5: remainder 0 is held out and never read
for its label; 1 and 2 give the lexicon, 3 the trees, 4 the calibration, so that each step sees the
features that unseen texts have, not those of texts it learned from. Where the third or fourth part
lacks a class (few labels), all of 1 to 4 stand in; where all do, the score is the share of
toxic rows (0.5 without labels).

Bounds, all of them on the fit, none on what is scored: of the labelled rows to learn from,
``LEARN_ROWS`` in expectation are drawn by a hash of the doc_id, and their labels are broadcast (about
6 MB), so no text is shuffled; the lexicon is the ``LEXICON_SIZE``
entries of most evidence, which is what the driver and every task hold. Every text is scored whole.

Results for odd rows: null texts count as empty; empty texts have zero features and a score like any
other. A null doc_id is neither held out nor learned from. Documents that share a doc_id and
repeated rows are scored each; of several labels of a doc_id the greatest counts, null labels are
none. Other columns, lang and source among them, are never read. An empty table has no scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import small_batches, table, written

FOLDS, HELD_OUT = 5, 0
LEXICON_FOLDS, TREE_FOLDS, CALIBRATION_FOLDS = (1, 2), (3,), (4,)
LEARN_ROWS = 400_000
LEXICON_SIZE = 4096
#: Least texts an entry occurs in, and least standard errors its log odds lie above zero.
SUPPORT, EVIDENCE = 4, 3.0
STEMS = (4, 5, 6)
TREES, DEPTH, STEP = 24, 3, 0.2
#: Entries counted in a task before they go to the shuffle.
HELD_ENTRIES = 300_000
#: Words around a lexicon word in which a second person counts.
REACH = 5

#: Own choice of plain insults and of second-person words in the four languages of the texts.
INSULTS = frozenset(
    "idiot moron clown loser scum trash worthless pathetic disgusting stupid dumb fool jerk liar vermin filth"
    " idiotin trottel dummkopf abschaum versager widerlich erbärmlich wertlos imbécile crétin ordure raté minable"
    " dégoûtant idiota imbécil escoria basura inútil patético asqueroso estúpido".split()
)
SECOND_PERSON = frozenset("you your yours yourself u du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted vosotros".split())

_WORD = re.compile(r"[^\W_]+")
_MIXED = re.compile(r"[^\W\d_][0-9@$*!|#]+[^\W\d_]")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
_SPELLED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-*_]){3,24}[^\W\d_](?!\w)")
_SHOUT = re.compile(r"[!?]{2,}")
_SYMBOL = re.compile(r"[#*$%&|<>@^~]")
#: Two readings, since a one stands for either letter.
_READINGS = (str.maketrans("013457@$!|", "oieastasil"), str.maketrans("013457@$!|", "oleastasll"))

FEATURES = (
    "insults_per_word", "insults", "weight_per_word", "most_weight", "telling_per_word", "telling",
    "near_second_person", "second_person_per_word", "capitals", "capital_words", "shouts_per_word",
    "marks_per_char", "symbols_per_char", "digits_per_char", "mixed_per_word", "masked_insults",
    "drawn_per_word", "spelled_per_word", "words",
)


def fold(doc_id: str = "doc_id") -> Column:
    """The part a document's label belongs to; null for a null doc_id."""
    return (F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS).cast("int")


def entries(word: str) -> list[str]:
    """What a lower-case word counts as: itself (marked) and its beginnings."""
    return [f"={word}", *(word[:k] for k in STEMS if len(word) >= k)]


def entry_counts(labelled: DataFrame) -> DataFrame:
    """(entry, toxic, clean): texts of (text, toxic) that an entry occurs in, by label."""
    small_batches(labelled.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def shown() -> pa.RecordBatch:
            names = list(held[0].keys() | held[1].keys())
            columns = [pa.array(names, pa.string()), *(pa.array([h[x] for x in names], pa.int64()) for h in (held[1], held[0]))]
            return pa.record_batch(columns, ["entry", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = set(_WORD.findall((text or "").lower()))
                held[toxic].update({e for w in words for e in entries(w)})
            if len(held[0]) + len(held[1]) > HELD_ENTRIES:
                yield shown()
                held[0].clear(), held[1].clear()
        yield shown()

    found = labelled.select("text", F.least(F.greatest("toxic", F.lit(0)), F.lit(1)).alias("toxic"))
    found = found.mapInArrow(counted, "entry string, toxic bigint, clean bigint")
    return found.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def lexicon(labelled: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """At most ``size`` entries with the log odds they speak for toxic texts, those of most evidence first."""
    totals = labelled.groupBy((F.col("toxic") > 0).alias("is")).count().collect()
    n = {r["is"]: r["count"] for r in totals}
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(t / (n.get(True, 0) + 1.0)) - F.log(c / (n.get(False, 0) + 1.0))
    found = entry_counts(labelled).where(F.col("toxic") >= SUPPORT).select("entry", odds.alias("odds"), (odds / F.sqrt(1 / t + 1 / c)).alias("z"))
    best = found.where(F.col("z") >= EVIDENCE).orderBy(F.desc("z"), "entry").limit(size)
    return {r["entry"]: r["odds"] for r in best.collect()}


def _insult_in(masked: str) -> bool:
    return any(x in INSULTS for reading in _READINGS for x in _WORD.findall(masked.translate(reading)))


def _measured(text: str, telling: dict[str, float], known: dict[str, float]) -> list[float]:
    size = len(text) or 1
    words = _WORD.findall(text)
    n = len(words) or 1
    lower = [w.lower() for w in words]
    weights = []
    for w in lower:
        weight = known.get(w)
        if weight is None:
            weight = known[w] = max((telling.get(e, 0.0) for e in entries(w)), default=0.0)
        weights.append(weight)
    hits = [i for i, w in enumerate(weights) if w > 0.0]
    insults = [i for i, w in enumerate(lower) if w in INSULTS]
    second = {i for i, w in enumerate(lower) if w in SECOND_PERSON}
    targets = {*hits, *insults}
    near = sum(any(k in second for k in range(i - REACH, i + REACH + 1)) for i in targets) if second else 0
    mixed = _MIXED.findall(text)
    masked = [w for w in text.lower().split() if _MIXED.search(w) and _insult_in(w)] if mixed else []
    weight = sum(weights)
    return [
        len(insults) / n, float(len(insults)), weight / n, max(weights, default=0.0), len(hits) / n, float(len(hits)),
        near / n, len(second) / n, sum(map(str.isupper, text)) / size, sum(w.isupper() and len(w) > 1 for w in words) / n,
        len(_SHOUT.findall(text)) / n, sum(map(text.count, "!?.,;:")) / size, len(_SYMBOL.findall(text)) / size,
        sum(map(str.isdigit, text)) / size, len(mixed) / n, float(len(masked)), len(_DRAWN.findall(text)) / n,
        len(_SPELLED.findall(text)) / n, float(np.log1p(len(words))),
    ]


def features(docs: DataFrame, telling: dict[str, float]) -> DataFrame:
    """(doc_id, features): every row's measures, in the order of ``FEATURES``."""
    small_batches(docs.sparkSession)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            rows = [_measured(t or "", telling, known) for t in batch.column("text").to_pylist()]
            if len(known) > HELD_ENTRIES:
                known.clear()
            yield pa.record_batch([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "features"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(measured, f"doc_id {kind}, features array<double>")


@dataclass
class Model:
    """What was learned; without trees, ``share`` is every text's score."""

    telling: dict[str, float]
    share: float
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None

    def scored(self, measured: DataFrame) -> DataFrame:
        """``measured`` rows with score and predicted."""
        if self.trees is None or self.calibration is None:
            found = measured.withColumn("score", F.lit(self.share))
        else:
            found = self.calibration.transform(margins(self.trees, measured)).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")))
        return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def margins(trees: GBTClassificationModel, measured: DataFrame) -> DataFrame:
    found = trees.transform(measured.withColumn("vector", array_to_vector("features")))
    return found.withColumn("margin", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "trees")


def _both(rows: DataFrame, folds: tuple[int, ...]) -> DataFrame:
    """The rows of ``folds`` if both classes are among them, else all of them."""
    chosen = rows.where(F.col("fold").isin(*folds))
    return chosen if chosen.agg(F.count_distinct("label")).first()[0] == 2 else rows


def learned(docs: DataFrame, labels: DataFrame, learn_rows: int = LEARN_ROWS) -> tuple[Model, DataFrame]:
    """A model of the labelled rows that are not held out, and the stored features of all ``docs``."""
    given = labels.where("toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    given = given.withColumn("fold", fold()).where(F.col("fold") != HELD_OUT)
    size = given.agg(F.count(F.lit(1))).first()[0]
    if size > learn_rows:  # the bound on what the fit reads
        given = given.where(F.pmod(F.xxhash64(F.lit("learn"), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * (learn_rows / size)))
    given = written(given, "labels")
    words = given.where(F.col("fold").isin(*LEXICON_FOLDS))
    telling = lexicon(written(docs.select("doc_id", "text").join(F.broadcast(words), "doc_id").select("text", "toxic"), "labelled"))
    measured = written(features(docs, telling), "features")
    rows = written(measured.join(F.broadcast(given), "doc_id").select("features", "fold", F.col("toxic").cast("double").alias("label")), "examples")
    n, toxic, classes = rows.agg(F.count(F.lit(1)), F.sum("label"), F.count_distinct("label")).first()
    share = (toxic or 0.0) / n if n else 0.5
    if classes < 2:
        return Model(telling, share), measured
    fit = _both(rows, TREE_FOLDS).withColumn("vector", array_to_vector("features"))
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", predictionCol="trees", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=64, seed=7
    ).fit(fit)
    held = margins(trees, _both(rows, CALIBRATION_FOLDS))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(written(held.select("margin", "label"), "margins"))
    return Model(telling, share, trees, calibration), measured


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    model, measured = learned(docs, labels)
    held_out = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return model.scored(measured).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
