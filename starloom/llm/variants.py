"""Spelling variant grouping: words one code point apart, found with PartEnum signatures.

A word's letters are a multiset, read as a binary vector over (letter, occurrence). Two words that
differ by one replaced code point have vectors at Hamming distance two, by an inserted or deleted
one at distance one. Letters are dealt into classes. Of ``REPLACE_CLASSES`` a replacement touches at
most two, so the words agree on all others, and the signatures of a word enumerate every choice of
two classes to leave out (Arasu, Ganti and Kaushik, one first-level part). Of ``INSERT_CLASSES`` an
insertion touches one, so one is left out. A signature also holds what must be equal anyway: the
length, and the half of the word that lies away from the changed place. Words with a signature in
common are joined on it, and what the join finds is verified on the words, so no pair is missed and
none is wrong. The words' own form is the much more frequent near word, its root the end of the
chain of forms.

Words are counted in the tasks before they shuffle, so a frequent word is a row per task. Signatures
meet in sort-merge joins, which split a large signature's rows. All of it is column expressions.

Results for odd rows: null and empty texts have no words; a null doc_id is written as nothing in the
hash that picks places; documents that share a doc_id and repeated rows are counted each. Texts are
taken whole, whatever their length, and so are long words. Ties among near words go to the smallest
in code-point order. Other columns are ignored. An empty table has no words.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import table, written

RUN = "([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many loses a code point.
SLIP = 199
MIN_LENGTH, MIN_COUNT = 6, 5
#: A form has at least so many times the word's occurrences.
RATIO = 5
REPLACE_CLASSES, INSERT_CLASSES = 5, 3


def counted_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points that occur ``min_count`` times or more."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(1))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    run, size = F.col("run"), F.length("run")
    # a run never grows, so shorter ones need no hash
    found = docs.select(name.alias("name"), F.explode(runs).alias("run")).where(size >= min_length)
    h = F.crc32(F.concat("name", "run").cast("binary"))
    found = found.select("run", h.alias("h"))
    at = (F.col("h") % size).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, size))
    words = found.select(F.when(F.col("h") % slip == 0, shorter).otherwise(run).alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def class_letters(word: Column, n: int) -> list[Column]:
    """The letters of a word in each of ``n`` classes, sorted: the vector cut into parts."""
    letters = F.array_sort(F.split(word, ""))

    def of_class(j: int) -> Column:
        return F.array_join(F.filter(letters, lambda x: F.ascii(x) % n == j), "")

    return [of_class(j) for j in range(n)]


def signatures(classes: list[Column], left_out: int, length: Column, halves: tuple[Column, Column]) -> Column:
    """Every choice of ``left_out`` classes to leave out, with either half, as one array of hashes."""
    found = []
    for out in combinations(range(len(classes)), left_out):
        kept = [F.lit(None).cast("string") if j in out else c for j, c in enumerate(classes)]
        for side, half in enumerate(halves):
            found.append(F.xxhash64(F.lit(side), length, half, *[F.coalesce(k, F.lit("-")) for k in kept], F.lit(repr(out))))
    return F.array(*found)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, an, b, bn): unordered pairs of words of (word, n) one code point apart, each once."""
    word, size = F.col("word"), F.length("word")
    letters = words.select(
        "word", "n", F.struct(*class_letters(word, REPLACE_CLASSES)).alias("r"), F.struct(*class_letters(word, INSERT_CLASSES)).alias("i")
    )
    letters = written(letters, "letters")
    by_replace = [F.col(f"r.col{j + 1}") for j in range(REPLACE_CLASSES)]
    by_insert = [F.col(f"i.col{j + 1}") for j in range(INSERT_CLASSES)]
    left = lambda upto: F.substring(word, F.lit(1), upto)
    right = lambda after: F.substring(word, after + 1, size)
    half = F.floor(size / 2).cast("int")
    of_less = F.floor((size - 1) / 2).cast("int")
    equal = letters.select("word", "n", F.explode(signatures(by_replace, 2, size, (left(half), right(half)))).alias("s"))
    short = letters.select("word", "n", F.explode(signatures(by_insert, 1, size, (left(half), right(half)))).alias("s"))
    long = letters.select(
        "word", "n", F.explode(signatures(by_insert, 1, size - 1, (left(of_less), right(of_less + 1)))).alias("s")
    )

    def met(xs: DataFrame, ys: DataFrame, ordered: bool) -> DataFrame:
        xs, ys = xs.alias("x"), ys.alias("y")
        close = F.levenshtein(F.col("x.word"), F.col("y.word"), 1) == 1
        on = (F.col("x.s") == F.col("y.s")) & close
        on = on & (F.col("x.word") < F.col("y.word")) if ordered else on
        least = F.col("x.word") < F.col("y.word")
        one, two = F.struct("x.word", "x.n"), F.struct("y.word", "y.n")
        pair = F.struct(F.when(least, one).otherwise(two).alias("a"), F.when(least, two).otherwise(one).alias("b"))
        return xs.join(ys.hint("merge"), on).select(pair.alias("p"))

    pairs = met(equal, equal, True).union(met(short, long, False)).distinct()
    return pairs.select(
        F.col("p.a.word").alias("a"), F.col("p.a.n").alias("an"), F.col("p.b.word").alias("b"), F.col("p.b.n").alias("bn")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of (word, form): the end of each chain, every round twice as far along it."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        moved = written(moved, "roots")
        if moved.where("further is not null").isEmpty():
            return moved.select("word", "root")
        now = moved.drop("further")


def grouped(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n); the words must be a stored table."""
    pairs = written(near_pairs(words), "near")
    ways = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("bn").alias("on"))
    ways = ways.union(pairs.select("b", "a", "an"))
    best = F.min(F.struct((-F.col("on")).alias("less"), "other")).alias("best")
    near = ways.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    known = words.join(near.hint("merge"), "word", "left")
    often = -F.col("best.less") >= ratio * F.col("n")
    known = known.select(
        "word", F.when(often, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(often, -F.col("best.less")).alias("form_n"),
    )
    known = written(known, "forms")
    ends = roots(known.where("form is not null"))
    return known.join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(written(counted_words(table(spark, sf_dir, "documents").select("doc_id", "text")), "words"))
